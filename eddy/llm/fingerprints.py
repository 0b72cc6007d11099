"""Operator 6: I-Match fingerprints over several randomised lexicons.

1. Document frequency of every term over all documents.
2. The lexicon keeps the terms whose inverse document frequency lies in a
   band.  The band's lower edge on frequency (``min_share`` of all documents)
   bounds the lexicon: the shares add up to the mean number of distinct terms
   of a document, so at most that mean / ``min_share`` terms can lie above it,
   however large the corpus is.
3. Each of ``SUBSETS`` randomised lexicons keeps a term by a hash of the term
   and the lexicon's number; the lexicons differ in how many terms they keep.
   A term that none of them keeps is put in one lexicon, chosen by its hash,
   so every term of the band counts.
4. The component of a lexicon is a hash of the document's distinct terms in
   it.  It is the XOR of the terms' hashes, which gives the same as hashing
   the sorted list (one value for each set, whatever the order) and can be
   added up term by term, so no list is gathered.

The fingerprint joins all components (16 bits each, in hex).  The likeness of
two fingerprints is the share of equal components among the lexicons in which
at least one of the two has a term.

Defined cases: a text without a lexicon term (empty, null, or all terms
outside the band), or whose terms' hashes cancel out in all lexicons, gets the hash of its text as fingerprint, marked ``-``;
its likeness to another fingerprint is 1 if equal, else 0.  Rows of one
``doc_id`` with different texts are kept apart; repeated rows get equal
answers.  One row alone is its own next document.  Other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, words

SUBSETS = 64
PACKED = SUBSETS // 4  # components are packed four to a long

#: Band: terms in more documents than this share are too common, ...
MAX_SHARE = 0.2
#: ... those in fewer are too rare.
MIN_SHARE = 0.0005

#: One in so many lexicon terms is kept, by the lexicon's number modulo four.
ONE_IN = (32, 64, 128, 256)

ROWS_A_RUN = 4096
MAX_RUNS = 10_000


def terms(text: Column) -> Column:
    """Hashes of the distinct words of a text."""
    return F.array_distinct(F.transform(words(text), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, scratch: Scratch, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> DataFrame:
    """``(term, c0 .. c15)``: hash of each term in the band, and its 16-bit
    hashes in the lexicons that keep it (0 elsewhere), packed."""
    total = docs.count()
    band = (docs.select(F.explode(terms(F.col("text"))).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("df"))
            .where((F.col("df") >= min_share * total) & (F.col("df") <= max_share * total)))

    def component(j: int) -> Column:
        h = F.xxhash64("term", F.lit(j))
        bits = F.greatest(F.shiftrightunsigned(h, 48), F.lit(1).cast("long"))
        return F.when(F.pmod(h, F.lit(ONE_IN[j % 4])) == 0, F.shiftleft(bits, 16 * (j % 4))).otherwise(
            F.lit(0).cast("long"))

    def packed(i: int) -> Column:
        c = component(4 * i)
        for j in range(4 * i + 1, 4 * i + 4):
            c = c.bitwiseOR(component(j))
        return c.alias(f"c{i}")

    # A term that no lexicon keeps has a home in one.
    home = F.pmod(F.xxhash64("term", F.lit("home")), F.lit(SUBSETS)).cast("int")
    bits = F.greatest(F.shiftrightunsigned(F.xxhash64("term", home), 48), F.lit(1).cast("long"))
    kept = band.select("term", *[packed(i) for i in range(PACKED)])
    kept = kept.withColumns({"home": F.when(_filled() == 0, home), "bits": bits})

    def housed(i: int) -> Column:
        shifted = F.call_function("shiftleft", F.col("bits"), 16 * (F.col("home") % 4))
        return F.when(F.floor(F.col("home") / 4) == i, shifted).otherwise(F.col(f"c{i}")).alias(f"c{i}")

    return scratch.save(kept.select("term", *[housed(i) for i in range(PACKED)]), "lexicon")


def _filled() -> Column:
    """Zero if all components are."""
    return reduce(Column.bitwiseOR, [F.col(f"c{i}") for i in range(PACKED)])


def components(texts: DataFrame, key: list[str], lex: DataFrame) -> DataFrame:
    """``(*key, c0 .. c15)`` of every row of ``texts`` (unique by ``key``) that
    has lexicon terms.  All terms of a text are in one task, so they are added
    up before the shuffle, which moves one row for each text."""
    return (texts.select(*key, F.explode(terms(F.col("text"))).alias("term"))
            .join(F.broadcast(lex), "term")  # bounded, see above
            .groupBy(*key).agg(*[F.bit_xor(f"c{i}").alias(f"c{i}") for i in range(PACKED)]))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal components of two fingerprints."""
    numbers = F.sequence(F.lit(0), F.lit(SUBSETS - 1))
    one = lambda c, j: F.substring(c, F.lit(1) + j * 4, F.lit(4))
    zero = F.lit("0000")
    filled = F.size(F.filter(numbers, lambda j: (one(a, j) != zero) | (one(b, j) != zero)))
    equal = F.size(F.filter(numbers, lambda j: (one(a, j) == one(b, j)) & (one(a, j) != zero)))
    return F.when(a == b, 1.0).when(a.startswith("-") | b.startswith("-"), 0.0).otherwise(
        F.when(filled > 0, equal / filled).otherwise(0.0))


def with_next(docs: DataFrame) -> DataFrame:
    """``(run, rn, doc_id, text, next_run, next_rn, next_text)``: each row,
    numbered by ``(run, rn)``, beside the next one in descending ``doc_id``
    (equal ids by a hash of the text), after the last the first.

    The ids are cut at quantiles into runs of about ``ROWS_A_RUN`` rows, at
    most ``MAX_RUNS`` of them.  A run looks within itself; its last row gets
    the first row of the run after it (one row for each run is broadcast)."""
    n = docs.count()
    runs = max(1, min(MAX_RUNS, -(-n // ROWS_A_RUN)))
    shares = [i / runs for i in range(1, runs)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 20 * runs).alias("c")).first().c if shares else []
    above = F.array(*[F.lit(c) for c in sorted(set(cuts or []), reverse=True)])
    run = F.when(F.col("doc_id").isNull(), MAX_RUNS) if not cuts else F.when(
        F.col("doc_id").isNull(), MAX_RUNS).otherwise(F.size(F.filter(above, lambda c: c > F.col("doc_id"))))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", F.coalesce(run, F.lit(0)).alias("run"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    w = Window.partitionBy("run").orderBy(*order)
    numbered = rows.select("*", F.row_number().over(w).alias("rn"), F.lead("text").over(w).alias("after"))
    firsts = numbered.where("rn = 1").select("run", F.col("text").alias("first_text"))
    # one row for each run: at most MAX_RUNS
    around = Window.orderBy("run")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = firsts.select("run",
                          F.coalesce(F.lead("run").over(around), F.first("run").over(whole)).alias("head_run"),
                          F.coalesce(F.lead("first_text").over(around),
                                     F.first("first_text").over(whole)).alias("head"))
    at_end = F.col("after").isNull()
    return (numbered.join(F.broadcast(heads), "run")
            .select("run", "rn", "doc_id", "text",
                    F.when(at_end, F.col("head_run")).otherwise(F.col("run")).alias("next_run"),
                    F.when(at_end, 1).otherwise(F.col("rn") + 1).alias("next_rn"),
                    F.when(at_end, F.col("head")).otherwise(F.col("after")).alias("next_text")))


def fingerprint(docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> DataFrame:
    """For each row: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edited text has the last floor(n_chars / 2) characters replaced by as
    many (or all) first ones of the next row's text."""
    scratch = Scratch(docs.sparkSession, "fingerprints")
    lex = lexicon(docs, scratch, min_share, max_share)
    pairs = with_next(docs)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    key = ["run", "rn"]
    rows = pairs.select(*key, "doc_id", "next_run", "next_rn", n.cast("long").alias("n_chars"),
                        F.sha2("text", 256).alias("sha"), F.sha2(edited, 256).alias("edited_sha256"))
    sides = pairs.select(*key, F.posexplode(F.array(F.col("text"), edited)).alias("side", "text"))
    parts = components(sides, [*key, "side"], lex)
    packed = lambda sha: F.when(_filled() != 0, F.concat(
        *[F.lpad(F.lower(F.hex(f"c{i}")), 16, "0") for i in range(PACKED)])).otherwise(F.concat(F.lit("-"), F.col(sha)))
    own = (rows.join(parts.where("side = 0").drop("side"), key, "left")
           .select(*rows.columns, packed("sha").alias("fingerprint"))
           .join(parts.where("side = 1").drop("side"), key, "left")
           .select(*rows.columns, "fingerprint", packed("edited_sha256").alias("edited_fingerprint")))
    own = scratch.save(own.drop("sha"), "own")
    after = own.select(F.col("run").alias("next_run"), F.col("rn").alias("next_rn"),
                       F.col("fingerprint").alias("next_fingerprint"))
    return own.join(after, ["next_run", "next_rn"]).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
