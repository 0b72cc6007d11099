"""Text operators: lines of a text column (T3/T4), line counts (A1),
word counts (A4/A5), frequent-word report (A6), wrapped number lines
(F-g), indentation by index (F-e/F-f)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddy.functions import strings
from eddy.plans import prefix


def lines(df: DataFrame, text: str, keep: Sequence[str] = (), name: str = "line",
          pos: str = "line_no", trim: bool = True, drop_empty: bool = True,
          max_line_bytes: int | None = None) -> DataFrame:
    """T3/T4 + F-b: one row per ``\\n``-separated line with its position
    (``flatMapConcat`` order is ``(keys, line_no)``).  ``max_line_bytes``
    fails the query on an over-long line, as framing does."""
    out = df.select(*keep, F.posexplode(F.split(F.col(text), "\n")).alias(pos, name))
    if max_line_bytes is not None:
        out = out.withColumn(name, F.when(F.octet_length(name) > max_line_bytes,
                                          F.raise_error(F.lit("frame too long"))).otherwise(F.col(name)))
    if trim:
        out = out.withColumn(name, strings.jvm_trim(F.col(name)))
    if drop_empty:
        out = out.filter(F.length(name) > 0)
    return out


def word_counts(df: DataFrame, text: str, rules: Sequence[tuple[str, str]] = (),
                name: str = "word", count: str = "n") -> DataFrame:
    """A4/A5: words of trimmed non-empty lines after the rewrite rules,
    counted.  Spark's partial + final hash aggregate is the two-phase
    count of A5, so a frequent word never gathers in one task."""
    ls = lines(df, text)
    if rules:
        ls = ls.withColumn("line", strings.rewrite(F.col("line"), rules)).filter(F.length("line") > 0)
    w = ls.select(F.explode(F.split(F.col("line"), strings.WHITESPACE)).alias(name))
    return w.filter(F.length(name) > 0).groupBy(name).agg(F.count(F.lit(1)).alias(count))


def word_counts_two_phase(df: DataFrame, text: str, split: Column, parts: int = 8,
                          name: str = "word", count: str = "n") -> DataFrame:
    """A5 + A9: the rows split ``parts`` ways by ``split`` (a hash of the
    row id), words counted per (part, word), then the part counts merged
    per word.  One scan; the explicit split is a salt, so even a word
    that makes up a third of the text is counted by many tasks before the
    merge."""
    ls = lines(df.withColumn("__part", F.pmod(split, F.lit(parts))), text, keep=["__part"])
    w = ls.select("__part", F.explode(F.split(F.col("line"), strings.WHITESPACE)).alias(name))
    local = w.filter(F.length(name) > 0).groupBy("__part", name).agg(F.count(F.lit(1)).alias(count))
    return local.groupBy(name).agg(F.sum(count).cast("long").alias(count))


def frequent_words(counts: DataFrame, min_count: int, name: str = "word",
                   count: str = "n") -> DataFrame:
    """A6 + O1: words longer than 3, or upper-case words of exactly 3, seen
    more than ``min_count`` times, most frequent first (ties by word)."""
    w, n = F.col(name), F.col(count)
    keep = ((F.length(w) > 3) | (strings.is_upper(w) & (F.length(w) == 3))) & (n > min_count)
    return counts.filter(keep).orderBy(F.desc(count), F.asc(name))


def wrapped_lines(df: DataFrame, order_by: Sequence[str], number: Column,
                  line: int = 1000, first: int = 11) -> DataFrame:
    """F-g: numbers written one after another, separated by the F-g
    rule; a line ends before each newline separator.  Returns one row per
    line: ``line_id, first_number, numbers (count), text``.  The line id
    is a running sum of newline flags (prefix scan)."""
    sep = strings.wrap_separator(number, line, first)
    tagged = df.withColumn("__n", number).withColumn("__nl", (sep == "\n").cast("long"))
    run = prefix.running(tagged, order_by, {"line_id": ("sum", F.col("__nl"))})
    parts = F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in order_by], F.col("__n").alias("__v"))))
    return (run.groupBy("line_id")
               .agg(F.min_by("__n", F.struct(*[F.col(c) for c in order_by])).alias("first_number"),
                    F.count(F.lit(1)).alias("numbers"),
                    F.array_join(F.transform(parts, lambda s: s["__v"].cast("string")), " ").alias("text")))


def indent(df: DataFrame, value: Column, index: Column, name: str = "indented") -> DataFrame:
    """F-e: value as text padded to ``index + 1`` characters, reversed."""
    return df.withColumn(name, strings.pad_reverse(value.cast("string"), index))


def to_chars(df: DataFrame, text: Column, keep: Sequence[str] = (), pos: str = "pos",
             name: str = "ch") -> DataFrame:
    """F-f: one row per character, with its (0-based, bigint) position."""
    out = df.select(*keep, F.posexplode(strings.chars(text)).alias(pos, name))
    return out.withColumn(pos, F.col(pos).cast("long"))
