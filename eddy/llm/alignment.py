"""Operator 13: alignment of two tokenizers' tokens by their bytes.

Each text is encoded by a byte-level BPE (A) and a sentencepiece model (B).
The tokenizers' own spans are the coarse cuts: A's character offsets, moved to
bytes, and B's spans in the sentencepiece proto.  Where a span does not fit
the bytes that the token stands for (a character that several tokens share,
byte-fallback pieces, the space before the text), the cut is refined with the
decoded bytes.  Offsets at which tokens of both end cut them into groups;
tokens whose byte ranges overlap are linked.

Neither tokenizer joins characters over a space that stands between two that
are not white space, so a text is worked on in such chunks, and a chunk's
alignment is kept for the next time (a bounded memo in each Python worker).
If the sentencepiece model has pieces with an inner space, or normalises, a
text is one chunk.

Counts of id pairs: each document sends its distinct linked pairs, added up
before the shuffle; the counts come back by a join on the pair, broadcast if
they are few and by shuffle otherwise (where Spark splits hot pairs).

Defined cases: null and empty texts, and texts whose bytes one of the
tokenizers does not keep, have no tokens: zeros and an empty string; repeated
rows, rows of one id and rows without id are documents of their own; other
columns are ignored.
"""

from __future__ import annotations

import gc
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, each_text, for_texts, join_counted

FOLDER = "/opt/tokenizers"
A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
#: Chunks after which a worker lets go of those not met since as many others,
#: and the longest one kept.
MEMO = 200_000
MEMO_CHARS = 64


def byte_chars() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable ones themselves, the others moved up to 256 and beyond."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, loaded once in a worker."""

    def __init__(self, a_path: str, b_path: str, ends: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        at = byte_chars()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values(), default=-1) + 1)
        for s, i in vocab.items():
            self.a_bytes[i] = bytes(at[c] for c in s) if all(c in at for c in s) else s.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        # Each id as text with what follows it: A's within and at the end of a
        # group, then B's.
        self.marked = [f"{i}{mark}" for n, marks in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;"))
                       for mark in marks for i in range(n)]
        self.cut = all("▁" not in p.lstrip("▁") for p in pieces) and not self._normalises()
        self.memo: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}
        self.ends = ends

    def _normalises(self) -> bool:
        from sentencepiece import sentencepiece_model_pb2 as model

        m = model.ModelProto()
        m.ParseFromString(self.b.serialized_model_proto())
        s = m.normalizer_spec
        return bool(s.precompiled_charsmap) or s.remove_extra_whitespaces or not s.add_dummy_prefix

    def chunks(self, text: str) -> list[str]:
        """The text in chunks, each after a space that no token goes over."""
        if not self.cut:
            return [text]
        if not _blank(text[0]) and not _blank(text[-1]) and not _BLANKS.search(text):
            return text.split(" ")
        out, held, open_ = [], [], False
        for p in text.split(" "):
            if held and not open_ and p and not _blank(p[0]):
                out.append(" ".join(held) if len(held) > 1 else held[0])
                held = []
            held.append(p)
            open_ = not p or _blank(p[-1])
        out.append(" ".join(held))
        return out

    def a_cuts(self, raw: bytes, text: str) -> tuple[np.ndarray, np.ndarray | None]:
        e = self.a.encode(text, add_special_tokens=False)
        ids = e.ids
        spans = np.fromiter(chain.from_iterable(e.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)
        if len(raw) != len(text):
            spans = byte_offsets(text)[spans]
        of, at = self.a_bytes, np.array(ids, np.int64)
        return at, cuts(raw, spans, [of[i] for i in ids], self.a_size[at])

    def b_cuts(self, raw: bytes, text: str) -> tuple[np.ndarray, np.ndarray | None]:
        pieces = list(self.b.encode(text, return_type="proto").pieces)
        ids = [p.id for p in pieces]
        # Spans are in the bytes of ``text``, before which ``raw`` has a space.
        spans = np.array([[p.begin for p in pieces], [p.end for p in pieces]], np.int64).T + 1
        spans[:1, 0] = 0
        of, at = self.b_bytes, np.array(ids, np.int64)
        return at, cuts(raw, spans, [of[i] for i in ids], self.b_size[at])

    def align(self, chunks: list[str]) -> list[tuple | None]:
        """For each chunk, with the space before it: ``(n_a, n_b, n_groups,
        groups, keys, a_ends, b_ends)``, the ends in bytes of the chunk; None
        if bytes are lost.  The chunks are encoded as one text, as no token
        goes over their borders."""
        text = " ".join(chunks)
        raw = (" " + text).encode()
        a, a_ends = self.a_cuts(raw, " " + text)
        b, b_ends = self.b_cuts(raw, text)
        if a_ends is None or b_ends is None:
            half = len(chunks) // 2
            return self.align(chunks[:half]) + self.align(chunks[half:]) if half else [None]
        # Between two neighbouring ends of either side lies one link.
        ends = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
        ends = ends[np.append(ends[1:] != ends[:-1], True)]
        in_a, in_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        keys = (a[in_a] << 32 | b[in_b]).tolist()
        both = ends[(a_ends[in_a] == ends) & (b_ends[in_b] == ends)]
        at_a, at_b = (np.searchsorted(e, both, "right") for e in (a_ends, b_ends))
        marked = self.marked
        parts = [marked[i] for i in self.in_groups(a, b, at_a, at_b).tolist()]
        border = np.cumsum([len(c.encode()) + 1 for c in chunks])
        cut = [np.searchsorted(e, border, "right").tolist() for e in (a_ends, b_ends, both, ends)]
        out, a0, b0, g0, k0, start = [], 0, 0, 0, 0, 0
        for k, (a1, b1, g1, k1) in enumerate(zip(*cut)):
            spans = [tuple((e[i:j] - start).tolist()) for e, i, j in ((a_ends, a0, a1), (b_ends, b0, b1))] if self.ends else ()
            out.append((a1 - a0, b1 - b0, g1 - g0, "".join(parts[a0 + b0:a1 + b1])[:-1], keys[k0:k1], *spans))
            a0, b0, g0, k0, start = a1, b1, g1, k1, int(border[k])
        return out

    def in_groups(self, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> np.ndarray:
        """Where ``marked`` has the tokens of both sides, group by group and A's
        first; a group ends at ``at_a`` tokens of A and ``at_b`` of B."""
        out = np.empty(len(a) + len(b), np.int64)
        n_a, n_b = np.diff(at_a, prepend=0), np.diff(at_b, prepend=0)
        in_a = np.arange(len(a)) + np.repeat(at_b - n_b, n_a)
        in_b = np.arange(len(b)) + np.repeat(at_a, n_b)
        out[in_a], out[in_b] = a, b + 2 * len(self.a_bytes)
        out[in_a[at_a - 1]] += len(self.a_bytes)
        out[in_b[at_b - 1]] += len(self.b_bytes)
        return out

    def documents(self, texts: list[str | None]) -> list[list[tuple] | None]:
        """The aligned chunks of each text; None for texts without tokens."""
        split = [self.chunks(t) if t else [] for t in texts]
        memo, old, got, joined, alone = self.memo, self.old, {}, [], []
        for c in {c for cs in split for c in cs}:
            hit = memo.get(c, 0)
            if hit == 0:
                hit = old.get(c, 0)
                if hit == 0:
                    (alone if not self.cut or not c or _blank(c[0]) or _blank(c[-1]) else joined).append(c)
                    continue
                memo[c] = hit
            got[c] = hit
        for i in range(0, len(joined), 500):
            got.update(zip(joined[i:i + 500], self.align(joined[i:i + 500])))
        for c in alone:
            got[c], = self.align([c])
        for c in [*joined, *alone]:
            if len(c) <= MEMO_CHARS:
                memo[c] = got[c]
        if len(memo) > MEMO:  # what was not asked for since the last time goes
            self.memo, self.old = {}, memo
        out = []
        for cs in split:
            found = [got[c] for c in cs]
            out.append(None if not found or None in found else found)
        return out


#: Characters that a tokenizer might take for white space.
_BLANK = "\u180e\u200b\ufeff"
_BLANKS = re.compile(rf"[\s{_BLANK}]{{2}}")


def _blank(c: str) -> bool:
    return c.isspace() or c in _BLANK


def byte_offsets(text: str) -> np.ndarray:
    """The UTF-8 byte at which each character starts, and the end."""
    at = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return np.concatenate([[0], np.cumsum(1 + (at >= 0x80) + (at >= 0x800) + (at >= 0x10000))])


def cuts(raw: bytes, spans: np.ndarray, tokens: list[bytes], size: np.ndarray | None = None) -> np.ndarray | None:
    """The byte at which each token ends: the span's end where the span is as
    long as the token's bytes, else as many bytes on as the tokens stand for.
    None if the tokens' bytes are not ``raw``."""
    if b"".join(tokens) != raw:
        return None
    if size is None:
        size = np.array([len(t) for t in tokens], np.int64)
    fine = np.cumsum(size)
    whole = (spans[:, 0] == fine - size) & (spans[:, 1] - spans[:, 0] == size)
    return np.where(whole, spans[:, 1], fine)


def _portions(texts, most: int = 1_000_000):
    """Lists of texts of about ``most`` characters together."""
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t or "")
        if n >= most:
            yield held
            held, n = [], 0
    if held:
        yield held


_pairs: dict[tuple, Pair] = {}


def _pair(*key) -> Pair:
    if key not in _pairs:
        _pairs[key] = Pair(*key)
    return _pairs[key]


SCHEMA = ("rid bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
          "keys array<bigint>, times array<int>")


def groups(docs: DataFrame, folder: str = FOLDER, a_file: str = A_FILE, b_file: str = B_FILE,
           ends: bool = False) -> DataFrame:
    """One row for each document: counts, the groups as text
    (``a1,a2|b1;a3|b2,b3``), and the distinct linked pairs ``keys`` (A's id
    shifted by 32 bits, plus B's) with how often each is linked.  With
    ``ends``, also the bytes of space and text at which A's and B's tokens
    end.  ``rid`` tells rows apart once the result is stored."""
    for_texts(docs.sparkSession)
    a_path, b_path = os.path.join(folder, a_file), os.path.join(folder, b_file)
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")

    def aligned(batches):
        pair = _pair(a_path, b_path, ends)
        for b in batches:
            n, text, keys, times, at = [], [], [], [], [[], []]
            for portion in _portions(each_text(b.column(2))):
                for got in pair.documents(portion):
                    n_a, n_b, n_groups, strings, linked, *spans = zip(*got) if got else ((),) * (7 if ends else 5)
                    links = np.fromiter(chain.from_iterable(linked), np.int64)
                    k, m = np.unique(links, return_counts=True)
                    n.append([sum(n_a), sum(n_b), sum(n_groups), len(links)])
                    text.append(";".join(strings))
                    keys.append(k)
                    times.append(m.astype(np.int32))
                    for side, out in zip(spans, at):
                        first = np.cumsum([0, *[x[-1] for x in side]])
                        out.append([x + int(f) for xs, f in zip(side, first) for x in xs])
            n = np.array(n, np.int64).reshape(len(n), 4)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *[pa.array(n[:, i]) for i in range(4)], pa.array(text, pa.string()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int32())),
                 *[pa.array(x, pa.list_(pa.int32())) for x in at if ends]],
                names=["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "keys", "times",
                       *["a_ends", "b_ends"] * ends][:9 + 2 * ends])

    def run(batches):
        # Many small objects are held, none in cycles: looking for cycles among
        # them takes a tenth of the time.
        was = gc.isenabled()
        gc.disable()
        try:
            yield from aligned(batches)
        finally:
            if was:
                gc.enable()

    return rows.mapInArrow(run, SCHEMA + ", a_ends array<int>, b_ends array<int>" * ends)


def align(docs: DataFrame, folder: str = FOLDER, a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """One row for each document: counts of tokens, groups and links, the hash
    of the groups, ``n_best`` (links whose pair is in as many documents as any
    pair of its A id) and ``count_sum`` (over links, documents of the pair)."""
    scratch = Scratch(docs.sparkSession, "alignment")
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    rows = scratch.save(groups(docs, folder, a_file, b_file).select(
        "rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "keys", "times"), "groups")
    counts = scratch.save(rows.select(F.explode("keys").alias("key")).groupBy("key").agg(
        F.count(F.lit(1)).alias("docs")), "counts")
    a_id = F.shiftright("key", 32)
    # One row for each id of A's vocabulary at most.
    most = counts.groupBy(a_id.alias("a")).agg(F.max("docs").alias("most"))
    pairs = scratch.save(counts.withColumn("a", a_id).join(F.broadcast(most), "a").select(
        "key", "docs", (F.col("docs") == F.col("most")).alias("best")), "pairs")
    links = rows.select("rid", F.explode(F.arrays_zip("keys", "times")).alias("l")).select(
        "rid", F.col("l.keys").alias("key"), F.col("l.times").cast("long").alias("times"))
    sums = join_counted(links, pairs, "key").groupBy("rid").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.drop("keys", "times").join(sums, "rid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
