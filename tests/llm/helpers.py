"""Small inputs and plain word functions for the operators' tests."""

import re

from eddy.llm.common import table

SF = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, tk string, score string, n string"

LONG = " ".join(f"word{i % 977} x{i}" for i in range(20_000))


def odd_documents(spark, extra=()):
    """Nulls in every column, empty and long texts, repeated rows, ids shared
    by different texts, and columns whose names clash with the operators'."""
    rows = [
        (1, None, None, None, None, "a", "b", "c"),
        (2, "", "en", "s", 0, None, None, None),
        (3, " \n\t ", "en", "s", 4, "t", "s", "n"),
        (4, "One two three", "en", "s", 13, "t", "s", "n"),
        (5, LONG, "en", "s", len(LONG), "t", "s", "n"),
        (6, "The same row, twice over and over again for good measure.", "en", "s", 57, "t", "s", "n"),
        (6, "The same row, twice over and over again for good measure.", "en", "s", 57, "t", "s", "n"),
        (7, "one text of an id that has two of them in the table", "en", "s", 51, "t", "s", "n"),
        (7, "another text of the id, quite unlike the first one there", "de", "s", 56, "t", "s", "n"),
        (None, "a row whose id is null but whose text is there all right", "en", None, 56, "t", "s", "n"),
        (8, "ÀÉ Ünïcode ßtraße 中文 字 ʼn 𝒳𝒴 İstanbul", "xx", "s", 30, "t", "s", "n"),
        *extra,
    ]
    return spark.createDataFrame(rows, DOCS)


def documents(spark):
    return table(spark, SF, "documents")


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)
