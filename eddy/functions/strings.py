"""Scalar text functions (F-a .. F-g, F-n) as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that JVM ``String.trim`` strips: code points 0x00..0x20.
_TRIM_CHARS = "".join(chr(c) for c in range(0x21))
# Java's ``\s``: space, tab, newline, vertical tab, form feed, return.
WHITESPACE = "[\\t\\n\\x0B\\f\\r ]"


def jvm_trim(c: Column) -> Column:
    """F-b: trim as the JVM does (all control characters and space); a
    character-set trim, no regex."""
    return F.btrim(c, F.lit(_TRIM_CHARS))


def rewrite(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """F-a: ordered regex rewrite rules, each applied to the previous
    result.  Rules are a parameter: ``[(pattern, replacement), ...]``."""
    for pattern, repl in rules:
        c = F.regexp_replace(c, pattern, repl)
    return c


def chain(c: Column, funcs) -> Column:
    """Apply same-type column functions in order."""
    for f in funcs:
        c = f(c)
    return c


def words(c: Column) -> Column:
    """F-c: split on each whitespace character; empty words are dropped
    (the JVM split drops trailing ones, and empty words never pass A6)."""
    return F.filter(F.split(c, WHITESPACE), lambda w: F.length(w) > 0)


def is_upper(c: Column) -> Column:
    """F-d: upper-case equality test."""
    return F.upper(c) == c


def pad_reverse(s: Column, i: Column) -> Column:
    """F-e: pad ``s`` with spaces to ``i + 1`` characters (never cut) and
    reverse it: indentation by index."""
    width = F.greatest(i + F.lit(1), F.length(s)).cast("int")
    return F.reverse(F.rpad(s, width, " "))


def chars(s: Column) -> Column:
    """F-f: a string as an array of 1-character strings."""
    return F.split(s, "")


# Fixed values of the number-series wrapping (F-g): a new line where
# n % 1000 < 11 and n > 11.
WRAP_LINE, WRAP_FIRST = 1000, 11


def wrap_separator(n: Column, line: int = WRAP_LINE, first: int = WRAP_FIRST) -> Column:
    """F-g: the text emitted before number ``n`` of a series: a newline if
    ``n % line < first and n > first``, a space if ``n > first``, else
    nothing."""
    return (F.when((F.pmod(n, F.lit(line)) < first) & (n > first), F.lit("\n"))
             .when(n > first, F.lit(" ")).otherwise(F.lit("")))
