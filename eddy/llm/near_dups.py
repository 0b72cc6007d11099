"""Operator 7: near duplicates by a chosen-path set similarity join.

1. Each text becomes its set of distinct 5-word shingles (64-bit hashes) and
   a sketch of ``COORDS`` minwise tokens.  Texts with equal sets form a
   class, known by a key ``rep``, a hash of its set, from then on; the
   smallest ``doc_id`` of a component is taken at the end.
2. Tree: a node's members are branched by the minwise token at a coordinate
   that the node chooses by its path; a node chooses 1 / threshold
   coordinates on average, so a pair at the threshold shares one child on
   average at any depth.  Every level branches twice.  Nodes of one member, or
   whose members are already connected, are left.  Nodes of at most ``LEAF``
   members are compared exhaustively, larger ones are branched again.
   Independent trees raise the recall.
3. Members of a leaf that have a partner whose size allows the threshold and
   whose sketch agrees in ``agree`` of the coordinates form groups, connected
   by such pairs.  A group is known by its members, so what many trees or both
   phases find is compared once: its texts are sent to the group and compared
   on the full sets; it returns a spanning forest of its links, never its pairs.
4. Phase one takes ``TREES[0]`` trees.  The components it finds spare phase
   two, with ``TREES[1]`` further trees, all nodes and members that are
   connected anyway, so a group of copies costs about as much as its members,
   not its pairs.
5. What ``LEVELS`` levels can't split are many texts that share nearly all
   tokens.  Phase one compares them, in groups of about ``LEAF``, with the
   one nearest to their centre, which connects the near copies of one text.
   After phase two all of them meet by rare shingles: an exact prefix join by bands of
   set sizes, in which only groups of several components count.  Groups that
   are too large meet their own centre, and what then is outside the most
   frequent component is compared in blocks with the rest.  Phase two leaves
   nodes of only texts that will so meet; a node of its second level or below
   that is too large and holds some of them is not branched again: its members
   meet by rare shingles too.

No step gathers a group: leaves are bounded, and larger nodes are only
counted, joined and branched.

The threshold is an argument of :func:`find`: 0.85 for the query, 0.8 for the
stage of the pipeline.  Recall of a pair at exactly the threshold (higher
above): its sketches fall short of :func:`agree` with a probability of at
most 0.0003.  The trees share one sketch, so :func:`miss` adds up over its
agreement how often trees miss the pair.  By phase two's trees alone (phase
one compares the nodes that stay too large with their head only), a pair at
0.85 is missed by 16 trees with 0.0003 after 4 branchings and 0.0005 after 6,
the deepest; at 0.8 by 20 trees with 0.0001 and 0.0004.

Defined cases: null and empty texts, and texts of white space, have no
shingles and are linked with nothing; fewer than five words are one shingle;
a row with a null id stands alone (its component is null, it is kept);
repeated rows get equal answers; rows of one id with different texts are
answered each by its own text; other columns are ignored.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce
from itertools import accumulate
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, each_text, for_texts, runs_of, text_key
from .components import components, merged

SHINGLE = 5
THRESHOLD = 0.85
COORDS = 64
SHORT = 0.0003  # of the pairs at the threshold, by their sketches
LEAF = 256
#: Trees of the phases at thresholds of 0.85 and 0.8 (by :func:`miss`).
TREES = (3, 16)
TREES_80 = (3, 20)
LEVELS = 3
#: Bands of set sizes, and bits of the cells in which shingles are counted.
BAND = 1.02
FREQ_BITS = 20

_rng = np.random.default_rng(20240607)
_MULT = _rng.integers(1, 2**63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _rng.integers(1, 2**63, COORDS, dtype=np.uint64)
_POWERS = [pow(0x9E3779B97F4A7C15, i, 2**64) for i in range(SHINGLE)]

# A-Z to a-z in UTF-8 bytes.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word 5-grams."""
    ws = (text or "").encode().translate(LOWER).split()
    if not ws:
        return np.zeros(0, np.uint64)
    one = xxhash.xxh3_64_intdigest
    h = np.array([one(w) for w in ws], np.uint64)
    k = min(SHINGLE, len(h))
    n = len(h) - k + 1
    a = np.full(n, k, np.uint64)
    for i in range(k):
        a += h[i:i + n] * np.uint64(_POWERS[i])
    a ^= a >> np.uint64(31)
    a *= np.uint64(0xBF58476D1CE4E5B9)
    a ^= a >> np.uint64(29)
    return np.unique(a)


def sketch(s: np.ndarray) -> bytes:
    """The minwise token (32 bits) of each coordinate."""
    if not len(s):
        return b""
    low = np.full(COORDS, 2**64 - 1, np.uint64)
    for i in range(0, len(s), 4096):
        v = (s[None, i:i + 4096] ^ _FLIP[:, None]) * _MULT[:, None]
        low = np.minimum(low, v.min(axis=1))
    return (low >> np.uint64(32)).astype("<u4").tobytes()


def sketches(docs: DataFrame) -> DataFrame:
    """``(doc_id, tk, n, h1, h2, sketch)``; h1 and h2 hash the whole set."""
    for_texts(docs.sparkSession)
    rows = docs.select("doc_id", text_key(F.col("text")).alias("tk"), "text")

    def run(batches):
        for b in batches:
            n, h1, h2, sk = [], [], [], []
            for t in each_text(b.column(2)):
                s = shingles(t)
                n.append(len(s))
                both = xxhash.xxh3_128_digest(s.tobytes())
                h1.append(int.from_bytes(both[:8], "little", signed=True))
                h2.append(int.from_bytes(both[8:], "little", signed=True))
                sk.append(sketch(s))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                 pa.array(sk, pa.binary())], names=["doc_id", "tk", "n", "h1", "h2", "sketch"])

    return rows.mapInArrow(run, "doc_id bigint, tk bigint, n bigint, h1 bigint, h2 bigint, sketch binary")


def ratio(threshold: float) -> tuple[int, int]:
    """The threshold as a fraction, for exact comparisons of counts."""
    f = Fraction(threshold).limit_denominator(1000)
    return f.numerator, f.denominator


def _agreeing(similarity: float) -> list[float]:
    """Probabilities that 0, 1, .. coordinates of a pair agree."""
    return [comb(COORDS, x) * similarity**x * (1 - similarity)**(COORDS - x) for x in range(COORDS + 1)]


def agree(threshold: float) -> int:
    """Coordinates in which two sketches must agree: as many as a pair at the
    threshold falls short of with a probability of at most ``SHORT``."""
    return sum(p <= SHORT for p in accumulate(_agreeing(threshold)[:int(threshold * COORDS)]))


def miss(threshold: float, trees: int, depth: int) -> float:
    """Probability that ``trees`` trees miss a pair at the threshold in nodes
    that were branched ``depth`` times."""
    two, out = 1 / threshold - 1, 0.0
    for x, p in enumerate(_agreeing(threshold)):
        together = 1.0
        for _ in range(depth):
            one = together * x / COORDS
            together = (1 - two) * one + two * (1 - (1 - one)**2)
        out += p * ((1 - together)**trees if x >= agree(threshold) else 1.0)
    return out


def _child(path: Column, coord: Column, sk: Column) -> Column:
    return F.xxhash64(path, coord, F.substring(sk, coord * 4 + 1, F.lit(4)))


def _coords(path: Column, threshold: float) -> Column:
    """The coordinates that a node chooses: one, or two as often as makes
    1 / threshold on average."""
    pick = lambda i: F.pmod(F.xxhash64(path, F.lit(i)), F.lit(COORDS)).cast("int")
    more = F.pmod(F.xxhash64(path, F.lit(0)), F.lit(1000)) < int(1000 * (1 / threshold - 1))
    return F.array_distinct(F.when(more, F.array(pick(1), pick(2))).otherwise(F.array(pick(1))))


def _branch(rows: DataFrame, threshold: float) -> DataFrame:
    coord = F.explode(_coords(F.col("path"), threshold)).alias("coord")
    own = ["rep", "comp", "met", "n", "sketch"]
    return rows.select("path", *own, coord).select(_child(F.col("path"), F.col("coord"), F.col("sketch")).alias("path"), *own)


def _labelled(rows: DataFrame, comp: DataFrame | None) -> DataFrame:
    """``rows`` of ``rep`` with the component ``comp`` of each."""
    if comp is None:
        return rows.withColumn("comp", F.col("rep"))
    return (rows.join(comp.select(F.col("node").alias("rep"), "label"), "rep", "left")
            .withColumn("comp", F.coalesce("label", "rep")).drop("label"))


def _met(rows: DataFrame, met: DataFrame | None) -> DataFrame:
    """``rows`` with the flag ``met``, whether ``rep`` is among the classes ``met``."""
    if met is None:
        return rows.withColumn("met", F.lit(False))
    return rows.join(met.select("rep", F.lit(True).alias("met")), "rep", "left").withColumn(
        "met", F.coalesce("met", F.lit(False)))


def grow(classes: DataFrame, comp: DataFrame | None, met: DataFrame | None, trees: range, scratch: Scratch,
         leaf: int = LEAF, levels: int = LEVELS, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame | None]:
    """The leaves ``(path, rep, comp, n)`` of the trees, and the members of the
    large nodes that are not branched again, with ``cnt``.  Classes ``met``
    are compared with each other elsewhere: nodes of only such ones are left, and
    from the second level on large nodes that hold some are not branched."""
    base = scratch.save(_met(_labelled(classes.select("rep", "n", "sketch"), comp), met), "base")
    roots = F.array(*[F.xxhash64(F.lit("tree"), F.lit(t)) for t in trees])
    rows = base.withColumn("path", F.explode(roots))
    done = ended = None
    for level in range(levels):
        rows = _branch(_branch(rows, threshold), threshold).drop("sketch")
        if level:  # read twice
            rows = scratch.save(rows, f"rows{level}")
        live = scratch.save(_mixed(rows, ~F.min("met"), F.max("met")), f"level{level}")
        small, large = live.where(F.col("cnt") <= leaf), live.where(F.col("cnt") > leaf)
        small = small.select("path", "rep", "comp", "n")
        done = small if done is None else done.union(small)
        if large.isEmpty():
            break
        if level:
            over = large if level == levels - 1 else large.where("some")
            ended = over if ended is None else ended.union(over)
            large = large.where("NOT some")
        elif levels == 1:
            ended = large
        rows = large.select("path", "rep", "comp", "met", "n").join(base.select("rep", "sketch"), "rep")
    return done, None if ended is None or ended.isEmpty() else ended


def sized(leaves: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The members of leaves ``(path, rep, comp, n)`` that have a partner of a
    size that the threshold allows, in leaves of several components.  The
    nearest sizes are a member's neighbours by ``n``; leaves are bounded."""
    part, whole = ratio(threshold)
    group, by_size = Window.partitionBy("path"), Window.partitionBy("path").orderBy("n")
    rows = leaves.withColumn("less", F.lag("n").over(by_size)).withColumn("more", F.lead("n").over(by_size))
    rows = rows.where((whole * F.col("less") >= part * F.col("n")) | (whole * F.col("n") >= part * F.col("more")))
    rows = rows.withColumn("lo", F.min("comp").over(group)).withColumn("hi", F.max("comp").over(group))
    return rows.where("lo < hi").select("path", "rep", "comp")


def distinct_groups(rows: DataFrame) -> DataFrame:
    """One of all groups ``path`` that have the same members: trees and tokens
    often find a group again."""
    sig = (rows.groupBy("path").agg(F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("rep")).alias("x"),
                                    F.bit_xor(F.xxhash64(F.lit(1), "rep")).alias("y"))
           .groupBy("c", "x", "y").agg(F.min("path").alias("path")))
    return rows.join(sig.select("path"), "path", "left_semi")


def _mixed(rows: DataFrame, also: Column | None = None, some: Column | None = None) -> DataFrame:
    """The rows of groups with members of several components that fulfil
    ``also`` (an aggregate), with ``cnt`` and the aggregate ``some``."""
    groups = (rows.groupBy("path").agg(F.count(F.lit(1)).alias("cnt"), F.min("comp").alias("lo"),
                                       F.max("comp").alias("hi"), (F.lit(True) if also is None else also).alias("also"),
                                       *([] if some is None else [some.alias("some")]))
              .where("lo < hi AND also"))
    return rows.join(groups.drop("lo", "hi", "also"), "path")


def centre_groups(large: DataFrame, classes: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Groups of about ``leaf`` members of each large node together with the
    node's centre: of the members whose sketches agree most with those of a
    group, the best.  Near copies of one text meet the copy nearest to it."""
    salt = F.xxhash64("path", F.pmod(F.xxhash64("rep"), F.ceil(F.col("cnt") / leaf))).alias("group")
    rows = large.select("path", "rep", "comp", "cnt", salt)
    held = (rows.join(classes.select("rep", "sketch"), "rep").select("group", "path", "rep", "sketch")
            .repartition("group").sortWithinPartitions("group", "rep"))

    def run(batches):
        for t in runs_of(batches, "group"):
            m = np.frombuffer(b"".join(t["sketch"].to_pylist()), "<u4").reshape(t.num_rows, COORDS)
            score = np.zeros(len(m), np.int64)
            for c in range(COORDS):
                _, at, times = np.unique(m[:, c], return_inverse=True, return_counts=True)
                score += times[at]
            best = int(score.argmax())
            yield pa.RecordBatch.from_arrays(
                [t["path"].combine_chunks().slice(best, 1), t["rep"].combine_chunks().slice(best, 1),
                 pa.array([float(score[best]) / len(m)])], names=["path", "rep", "score"])

    centre = (held.mapInArrow(run, "path bigint, rep bigint, score double")
              .groupBy("path").agg(F.max(F.struct("score", "rep")).alias("m"))
              .join(rows.select("path", F.col("rep").alias("of"), "comp"), "path").where("of = m.rep")
              .select("path", "of", "comp"))
    of = rows.select("path", "group").distinct().join(centre, "path").select(
        F.col("group").alias("path"), F.col("of").alias("rep"), "comp")
    return rows.select(F.col("group").alias("path"), "rep", "comp").union(of)


def texts_of(reps: DataFrame, docs: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """``(rep, text)`` of classes; the keys are narrow, so no text is shuffled
    while their table is small."""
    wanted = scratch.save(reps.select("rep").distinct().join(classes.select("rep", "doc_id", "tk"), "rep"), "wanted")
    text = docs.select("doc_id", text_key(F.col("text")).alias("tk"), "text")
    on = (F.col("d.doc_id") == F.col("w.doc_id")) & (F.col("d.tk") == F.col("w.tk"))
    small = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return (text.alias("d").join((F.broadcast(wanted) if small else wanted).alias("w"), on)
            .select("w.rep", "d.text").dropDuplicates(["rep"]))


def _band(n: int) -> int:
    """Number of the band of set sizes, 2 % wide, that holds ``n``."""
    b = max(0, int(np.log(n) / np.log(BAND)))
    while BAND ** (b + 1) <= n:
        b += 1
    while BAND ** b > n:
        b -= 1
    return b


def rare_keys(tokens: np.ndarray, freq: np.ndarray, part: int, whole: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set for a prefix join, any two sets at the threshold share
    one, and the key's side: 1 or 2 for the smaller or larger band, else 0.

    A pair of sizes n and m at the threshold has at least
    ``part * (n + m) / (part + whole)`` common tokens, so if each side takes
    its tokens, rarest first, up to that many from the end, both have taken
    the rarest common one.  A set does so for each band of sizes its partner
    may have; a key is a token and the two bands.  Tokens counted once are in
    no other set and need no key."""
    n = len(tokens)
    counts = freq[(tokens >> np.uint64(64 - FREQ_BITS)).astype(np.int64)]
    order = np.lexsort((tokens, counts))
    tokens, shared = tokens[order], counts[order] > 1
    own, out, sides = _band(n), [], []
    for q in range(_band(max(1, -(-part * n // whole))), _band(whole * n // part) + 1):
        low = max(int(np.ceil(BAND ** q)), -(-part * n // whole))
        if low > min(int(BAND ** (q + 1)), whole * n // part):
            continue
        need = -(-part * (n + low) // (part + whole))
        head = tokens[:max(0, n - need + 1)][shared[:max(0, n - need + 1)]]
        bands = np.uint64((min(own, q) * 100_003 + max(own, q) + 1) * 0x9E3779B97F4A7C15 % 2**64)
        out.append((head ^ bands) * np.uint64(0xD6E8FEB86659FD93))
        sides.append(np.full(len(head), (own < q) + 2 * (own > q), np.int32))
    return np.concatenate([np.zeros(0, np.uint64), *out]).view(np.int64), np.concatenate([np.zeros(0, np.int32), *sides])


def rare_groups(crowd: DataFrame, docs: DataFrame, classes: DataFrame, scratch: Scratch,
                threshold: float = THRESHOLD) -> DataFrame:
    """``(path, rep, comp, cnt)``: the members ``(rep, comp)`` of nodes that
    trees can't split, grouped by rare shingles that every pair at the
    threshold shares (an exact prefix join); groups of one component are
    left out.  ``freq`` counts shingles in 2**20 cells, so it is bounded."""
    part, whole = ratio(threshold)
    rows = crowd.join(texts_of(crowd, docs, classes, scratch), "rep").select("rep", "comp", "text")

    def to_sets(batches):
        for b in batches:
            sets = [shingles(t).tobytes() for t in each_text(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sets, pa.binary())],
                                             names=["rep", "comp", "set"])

    sets = scratch.save(rows.mapInArrow(to_sets, "rep bigint, comp bigint, set binary"), "sets")

    def count(batches):
        cells = np.zeros(1 << FREQ_BITS, np.int64)
        for b in batches:
            for s in each_text(b.column(0)):
                at, times = np.unique(np.frombuffer(s, np.uint64) >> np.uint64(64 - FREQ_BITS), return_counts=True)
                cells[at.astype(np.int64)] += times
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(cells[at], pa.int64())], names=["cell", "n"])

    counted = sets.select("set").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    freq = np.zeros(1 << FREQ_BITS, np.int32)
    got = counted.where("n > 1").toArrow()
    freq[got["cell"].to_numpy()] = np.minimum(got["n"].to_numpy(), 2**31 - 1)

    def keys(batches):
        for b in batches:
            each = [rare_keys(np.frombuffer(s, np.uint64), freq, part, whole) for s in each_text(b.column(2))]
            of = np.repeat(np.arange(len(each)), [len(k) for k, _ in each])
            if len(of):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([k for k, _ in each])), b.column(0).take(pa.array(of)),
                     b.column(1).take(pa.array(of)), pa.array(np.concatenate([x for _, x in each]))],
                    names=["path", "rep", "comp", "side"])

    found = scratch.save(sets.mapInArrow(keys, "path bigint, rep bigint, comp bigint, side int"), "keys")
    # A key of two bands needs members of both, any key those of two components.
    live = found.groupBy("path").agg(F.bit_or("side").alias("sides"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    live = live.where("lo < hi AND sides IN (0, 3)").select("path")
    found = scratch.save(found.drop("side").join(live, "path", "left_semi"), "shared")
    return scratch.save(_mixed(distinct_groups(found)), "rare")


def blocks(large: DataFrame, size: int = LEAF // 2) -> DataFrame:
    """Groups of at most about ``2 * size`` members in which every member of
    a large group outside its most frequent component meets every other."""
    by_comp = large.groupBy("path", "comp").agg(F.count(F.lit(1)).alias("k"))
    most = by_comp.groupBy("path").agg(F.max(F.struct("k", "comp")).alias("head"))
    rows = large.join(most, "path").withColumn("out", F.col("comp") != F.col("head.comp"))
    rows = rows.withColumn("m", F.col("cnt") - F.col("head.k"))
    n_out, n_all = F.ceil(F.col("m") / size), F.ceil(F.col("cnt") / size)
    block = lambda n, seed: F.pmod(F.xxhash64("rep", F.lit(seed)), n)
    as_out = rows.where("out").select("path", "rep", "comp", block(n_out, 1).alias("i"),
                                      F.explode(F.sequence(F.lit(0).cast("long"), n_all - 1)).alias("j"))
    as_any = rows.select("path", "rep", "comp", block(n_all, 2).alias("j"),
                         F.explode(F.sequence(F.lit(0).cast("long"), n_out - 1)).alias("i"))
    return (as_out.unionByName(as_any).select(F.xxhash64("path", "i", "j").alias("path"), "rep", "comp").distinct())


def _connected(ok: np.ndarray) -> np.ndarray:
    """The smallest member that each member of a symmetric relation reaches."""
    label = np.arange(len(ok))
    while True:
        low = np.minimum(label, np.where(ok, label[None, :], len(ok)).min(axis=1))
        low = low[low]
        if (low == label).all():
            return label
        label = low


def candidates(leaves: DataFrame, classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(path, rep, comp)``: the members of each leaf that have a partner of
    another component whose size and sketch allow the threshold, in groups
    connected by such pairs.  ``path`` is a hash of the group's members, so a
    group is the same from whichever leaf."""
    rows = (leaves.join(classes.select("rep", "n", "sketch"), "rep").select("path", "rep", "comp", "n", "sketch")
            .repartition("path").sortWithinPartitions("path", "rep"))
    least, (part, whole) = agree(threshold), ratio(threshold)

    def run(batches):
        held: list[tuple] = []

        def out():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], names=["path", "rep", "comp"])

        for t in runs_of(batches, "path"):
            rep, comp, n = t["rep"].to_numpy(), t["comp"].to_numpy(), t["n"].to_numpy()
            m = np.frombuffer(b"".join(t["sketch"].to_pylist()), "<u4").reshape(len(n), COORDS)
            same = np.zeros((len(n), len(n)), np.int32)
            for c in range(COORDS):
                same += m[:, c, None] == m[None, :, c]
            ok = (same >= least) & (comp[:, None] != comp[None, :])
            ok &= whole * np.minimum(n[:, None], n[None, :]) >= part * np.maximum(n[:, None], n[None, :])
            keep = np.flatnonzero(ok.any(axis=1))
            if len(keep):
                label = _connected(ok[np.ix_(keep, keep)])
                for x in np.unique(label):
                    at = keep[label == x]
                    path = np.frombuffer(xxhash.xxh3_64_digest(rep[at].tobytes()), np.int64)
                    held.append((np.repeat(path, len(at)), rep[at], comp[at]))
            if len(held) >= 2_000:
                yield out()
                held = []
        if held:
            yield out()

    return rows.mapInArrow(run, "path bigint, rep bigint, comp bigint")


def common_counts(sets: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of all intersections of a few sets."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    out = np.zeros((len(sets), len(sets)), np.int64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(shared.sum()), width):
        i, j = np.searchsorted(column, [low, low + width])
        m = np.zeros((len(sets), width), np.float32)
        m[owner[i:j], column[i:j] - low] = 1
        out += (m @ m.T).astype(np.int64)
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _find(up: list[int], i: int) -> int:
    while up[i] != i:
        up[i] = up[up[i]]
        i = up[i]
    return i


def leaf_links(sets: list[np.ndarray], comp: list[int], threshold: float = THRESHOLD) -> list[tuple[int, int]]:
    """Links of a leaf on the full sets that connect its components: a
    spanning forest, as pairs of member numbers."""
    both, n = common_counts(sets), np.array([len(s) for s in sets])
    part, whole = ratio(threshold)
    i, j = np.nonzero(np.triu(whole * both >= part * (n[:, None] + n[None, :] - both), 1))
    number = {c: k for k, c in enumerate(dict.fromkeys(comp))}
    of, up, out = [number[c] for c in comp], list(range(len(number))), []
    for a, b in zip(i.tolist(), j.tolist()):
        x, y = _find(up, of[a]), _find(up, of[b])
        if x != y:
            up[x] = y
            out.append((a, b))
    return out


def confirm(members: DataFrame, docs: DataFrame, classes: DataFrame, scratch: Scratch,
            threshold: float = THRESHOLD) -> DataFrame:
    """``(a, b)``: links on the full sets within the stored groups ``(path,
    rep, comp)``, each of at most about ``LEAF`` members."""
    text = texts_of(members, docs, classes, scratch)
    rows = (members.join(text, "rep").select("path", "rep", "comp", "text")
            .repartition("path").sortWithinPartitions("path", "rep"))

    def run(batches):
        for t in runs_of(batches, "path"):
            rep = t["rep"].to_pylist()
            if len(rep) < 2:
                continue
            got = leaf_links([shingles(x) for x in each_text(t["text"])], t["comp"].to_pylist(), threshold)
            if got:
                yield pa.RecordBatch.from_arrays([pa.array([rep[x] for x, _ in got], pa.int64()),
                                                  pa.array([rep[y] for _, y in got], pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a bigint, b bigint")


def find(docs: DataFrame, leaf: int = LEAF, levels: int = LEVELS, trees: tuple[int, int] = TREES,
         threshold: float = THRESHOLD) -> DataFrame:
    """For each row of ``docs``: ``doc_id, tk, n_shingles, component_id,
    kept``; texts are linked at a similarity of ``threshold`` or more."""
    scratch = Scratch(docs.sparkSession, "near-dups")
    rows = scratch.save(sketches(docs), "sketches")
    grouped = (rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "h1", "h2")
               .agg(F.min(F.struct("doc_id", "tk", "sketch")).alias("m")))
    classes = scratch.save(grouped.select("n", "h1", "h2", F.xxhash64("n", "h1", "h2").alias("rep"), "m.doc_id", "m.tk",
                                          "m.sketch"), "classes")

    compared: list[DataFrame] = []

    def linked(members: DataFrame, comp: DataFrame | None) -> DataFrame | None:
        """The components ``comp`` with the links within the groups ``members``
        that have not been compared before."""
        if compared:
            members = members.join(reduce(DataFrame.union, compared), "path", "left_anti")
        members = members.distinct()
        members = scratch.save(members, "members")
        compared.append(members.select("path"))
        return merged(comp, scratch.save(confirm(members, docs, classes, scratch, threshold), "links"), scratch)

    comp = crowd = None
    for some in (range(trees[0]), range(trees[0], sum(trees))):
        leaves, large = grow(classes, comp, crowd, some, scratch, leaf, levels, threshold)
        members = candidates(distinct_groups(sized(leaves, threshold)), classes, threshold)
        if large is not None and not some.start:
            members = members.union(centre_groups(large, classes, leaf))
        comp = linked(members, comp)
        if large is not None:
            more = large.select("rep") if crowd is None else large.select("rep").union(crowd)
            crowd = scratch.save(more.distinct(), "crowd")
    if crowd is not None:
        rare = rare_groups(_labelled(crowd, comp), docs, classes, scratch, threshold)
        few, many = rare.where(F.col("cnt") <= leaf), rare.where(F.col("cnt") > leaf)
        members = candidates(few.select("path", "rep", "comp"), classes, threshold)
        if many.isEmpty():
            comp = linked(members, comp)
        else:
            comp = linked(members.union(centre_groups(many, classes, leaf)), comp)
            still = scratch.save(_mixed(_labelled(many.select("path", "rep"), comp)), "still")
            comp = linked(candidates(blocks(still, max(1, leaf // 2)), classes, threshold), comp)

    of = classes.select("n", "h1", "h2", "rep", "doc_id")
    if comp is not None:
        of = of.join(comp.select(F.col("node").alias("rep"), "label"), "rep", "left")
        first_ids = of.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("first_id"))
        of = of.join(first_ids, "label", "left").withColumn("doc_id", F.coalesce("first_id", "doc_id"))
    of = of.select("n", "h1", "h2", F.col("doc_id").alias("first_id"))
    out = rows.drop("sketch").join(of, ["n", "h1", "h2"], "left")
    component = F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("first_id"))).otherwise(F.col("doc_id"))
    return out.select("doc_id", "tk", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
