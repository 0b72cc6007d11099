"""Operator 11: personal data by weak supervision, in DataFrame functions only.

1. Patterns give candidate spans: the strict forms (``base``), strict forms
   that fail their check, and loose forms (addresses written with "(at)",
   phone numbers without a country code, IPv6).
2. Labelers vote on each candidate, for, against or not at all: its pattern
   and check, a gazetteer (top-level domains, calling codes, card issuers,
   reserved networks), words in its context, its shape, its neighbours.
3. Expectation-maximisation over the counts of vote patterns of the whole
   table estimates how reliable each labeler is for each kind, and the
   probability of every vote pattern.
4. A logistic span classifier, trained on these probabilities over votes and
   further features of a span, is compiled into a column expression.  It adds
   the candidates it scores at ``LEAST`` or more; base spans always stay.

A document is read once, without a shuffle; its candidates are stored as
positions and two small numbers.  Only counts of vote and feature patterns
(at most ``PATTERNS`` rows, whatever the input) come to the driver.

Offsets are code points, ends exclusive.  Matches are leftmost and do not
overlap within a kind; a match that fails its check is dropped as a base span
and not tried again.  The expressions are written so that no run of
characters is tried from each of its places and no group repeats without
bound, which keeps very long texts linear.

Defined cases: null texts are empty and have no spans; rows are independent,
so repeated rows, ids and null ids each get their own answer; an empty table
gives an empty result; other columns are ignored.  An added span that
overlaps a base span or an earlier added one is left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, once

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "gazetteer", "context", "shape", "neighbours")
FEATURES = ("line_start", "line_end", "labelled", "long")
LEAST = 0.5
#: Most rows of pattern counts: votes and features of each kind.
PATTERNS = len(KINDS) * 3 ** len(LABELERS) * 2 ** len(FEATURES)

# The strict forms.  Each takes a run of its characters whole.
# In EMAIL's text, dots that do not stand between two domain characters have
# been replaced by another character of the local part.
LONE_DOT = r"\.(?![A-Za-z0-9-])|(?<![A-Za-z0-9-])\."
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Loose forms.
AT_WORD = r"(?i)[(\[{] ?at ?[)\]}]"
LOOSE_EMAIL = (r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[(\[{] ?at ?[)\]}] ?[A-Za-z0-9-]{1,63}+"
               r"(?: ?[(\[{] ?dot ?[)\]}] ?[A-Za-z0-9-]{1,63}+|\.[A-Za-z0-9-]{1,63}+){1,5}+")
LOOSE_PHONE = r"(?<![0-9+().-])(?<![0-9+] )(?:\([0-9]{3}\) ?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])(?![\x20.-][0-9])"
LOOSE_IP = r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"

# Gazetteers and context words.
DOMAINS = ("com org net edu gov mil info biz io co us uk de fr es it nl eu ch at be se no fi dk pl pt ie ru jp cn in br "
           "mx ca au nz za").split()
CALLING_CODES = ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 "
                 "66 81 82 84 86 90 91 92 93 94 95 98").split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6(?:011|5)|35)"
RESERVED = r"^0*(?:0|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
FOR = {"email": r"mail|contact|write to|kontakt|correo|courriel", "ip": r"\bip\b|address|host|server|client|adresse",
       "card": r"card|visa|master|amex|credit|debit|kreditkarte|tarjeta|carte",
       "phone": r"phone|\btel\b|call|mobile|cell|fax|telefon|llame|appel"}
AGAINST = {"email": r"noreply|example only", "ip": r"version|\bv$|release|section|chapter",
           "card": r"order|isbn|invoice|serial|tracking|token|hash|\bid\b", "phone": r"isbn|invoice|serial|order|version"}


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    value = lambda i: F.substring(digits, -i, F.lit(1)).cast("int")
    twice = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0),
                        lambda acc, i: acc + F.when(i % 2 == 0, twice(value(i))).otherwise(value(i)))
    return (F.length(digits) > 0) & (total % 10 == 0)


def matches(text: Column, pattern: str) -> Column:
    """``array<struct<s, e, m, before, after>>`` of the pattern's matches:
    what stands between matches gives their places and surroundings."""
    kind = "array<struct<s:int,e:int,m:string,before:string,after:string>>"
    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                     F.split(text, pattern, -1).alias("p"))

    def walk(x: Column) -> Column:
        row = lambda acc, i: F.struct(
            (acc["at"] + F.length(x["p"][i])).alias("s"), (acc["at"] + F.length(x["p"][i]) + F.length(x["m"][i])).alias("e"),
            x["m"][i].alias("m"), F.right(x["p"][i], F.lit(30)).alias("before"), F.left(x["p"][i + 1], F.lit(12)).alias("after"))
        step = lambda acc, i: F.struct(
            (acc["at"] + F.length(x["p"][i]) + F.length(x["m"][i])).alias("at"),
            F.concat(acc["out"], F.array(row(acc, i))).alias("out"))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
        found = F.aggregate(F.sequence(F.lit(0), F.size(x["m"]) - 1), start, step, lambda acc: acc["out"])
        return F.when(F.size(x["m"]) > 0, found).otherwise(F.array().cast(kind))

    return once(parts, walk)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def _base(kind: str, m: Column) -> Column:
    """Whether a match of a strict form passes its kind's check."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(f"^{OCTET}(?:\\.{OCTET}){{3}}$")
    if kind == "card":
        return luhn(_digits(m))
    return F.length(_digits(m)).between(9, 15)


def _votes(kind: str, x: Column, strict: bool, base: Column) -> Column:
    """The labelers' votes, each plus one, as digits to the base of three."""
    m, before, digits = x["m"], F.lower(x["before"]), _digits(x["m"])
    known = {
        "email": _vote(F.array_contains(F.array(*map(F.lit, DOMAINS)), F.lower(F.regexp_extract(m, r"([A-Za-z0-9-]+)$", 1))),
                       F.lit(False)),
        "ip": _vote(F.lit(False), m.rlike(RESERVED)),
        "card": _vote(digits.rlike(ISSUERS), F.lit(False)),
        "phone": _vote(F.array_contains(F.array(*map(F.lit, CALLING_CODES)), F.regexp_extract(m, r"^\+([0-9]+)", 1)),
                       m.rlike(r"^\+0"))}[kind]
    shape = {
        "email": _vote(m.rlike("^[A-Za-z][A-Za-z0-9._+-]*[A-Za-z0-9]"), m.rlike(r"^[._%+-]|\.\.")),
        "ip": _vote(~m.rlike(r"(?:^|\.)0[0-9]"), m.rlike(r"(?:^|\.)0[0-9]")),
        "card": _vote(m.rlike(r"^(?:[0-9]{15,16}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4})$"),
                      digits.rlike(r"^([0-9])\1+$")),
        "phone": _vote(m.rlike(r"[()\x20-][0-9]{3,4}[\x20.-]?[0-9]{2,4}$"), digits.rlike(r"^([0-9])\1+$"))}[kind]
    word = lambda c: c.rlike(r"[A-Za-z0-9_]")
    left, right = F.right(x["before"], F.lit(1)), F.left(x["after"], F.lit(1))
    votes = (F.when(base, 1).otherwise(-1 if strict else 0), known, _vote(before.rlike(FOR[kind]), before.rlike(AGAINST[kind])),
             shape, _vote(~word(left) & ~word(right) & (left != "") & (right != ""), word(left) | word(right)))
    code = F.lit(0)
    for v in votes:
        code = code * 3 + v + 1
    return code


def _features(x: Column) -> Column:
    bits = (x["before"].rlike(r"(?:^|\n)[\x20\t]*$"), x["after"].rlike(r"^[\x20\t]*(?:\n|$)"),
            x["before"].rlike(r"[:=][\x20\t]*$"), F.length(x["m"]) >= 20)
    code = F.lit(0)
    for b in bits:
        code = code * 2 + b.cast("int")
    return code


def _of_kind(kind: str, found: Column, strict: bool) -> Column:
    number = KINDS.index(kind)

    def row(x: Column) -> Column:
        base = _base(kind, x["m"]) if strict else F.lit(False)
        return once(base, lambda b: F.struct(F.lit(number).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), b.alias("base"),
                                             _votes(kind, x, strict, b).alias("votes"), _features(x).alias("features")))

    return F.transform(found, row)


def candidates(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``(doc_id, c)``: each document's candidates ``(kind, s, e, base, votes,
    features)``, strict forms and loose ones."""
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<s:int,e:int,m:string,before:string,after:string>>")
    only = lambda test, found: F.when(test, found).otherwise(none)
    found = [("email", only(F.contains(text, F.lit("@")), matches(F.regexp_replace(text, LONE_DOT, "%"), EMAIL)), True),
             ("ip", matches(text, IP), True), ("card", matches(text, CARD), True),
             ("phone", only(F.contains(text, F.lit("+")), matches(text, PHONE)), True),
             ("email", only(text.rlike(AT_WORD), matches(text, LOOSE_EMAIL)), False),
             ("phone", matches(text, LOOSE_PHONE), False), ("ip", only(F.contains(text, F.lit(":")), matches(text, LOOSE_IP)), False)]
    rows = docs.select("doc_id", F.concat(*[_of_kind(k, f, strict) for k, f, strict in found]).alias("c"))
    return scratch.save(rows, "candidates")


def reliabilities(votes: np.ndarray, start: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation for one kind.  ``votes`` (patterns x labelers,
    -1, 0 or 1), ``start`` (first probabilities) and ``n`` (counts); returns
    each pattern's probability and ``table[label, labeler, vote + 1]``."""
    p = start.astype(float)
    for _ in range(rounds):
        table = np.ones((2, votes.shape[1], 3))
        for v in (-1, 0, 1):
            hit = (votes == v) * n[:, None]
            table[1, :, v + 1] += (hit * p[:, None]).sum(axis=0)
            table[0, :, v + 1] += (hit * (1 - p)[:, None]).sum(axis=0)
        table /= table.sum(axis=2, keepdims=True)
        share = ((n * p).sum() + 1) / (n.sum() + 2)
        odds = np.log(share / (1 - share)) + sum(
            np.log(table[1, j, votes[:, j] + 1] / table[0, j, votes[:, j] + 1]) for j in range(votes.shape[1]))
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return p, table


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic model on soft labels ``y`` of rows that stand for
    ``n`` spans each (Newton's method, L2 penalty, first column free)."""
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + penalty * w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return w


def inputs(votes: np.ndarray, features: np.ndarray) -> np.ndarray:
    """The classifier's columns: one, votes for, votes against, features."""
    return np.column_stack([np.ones(len(votes)), votes == 1, votes == -1, features]).astype(float)


def unpack(code: int, base: int, places: int) -> list[int]:
    out = []
    for _ in range(places):
        out.append(code % base)
        code //= base
    return out[::-1]


def fit(found: DataFrame) -> dict[str, list[float]]:
    """The weights of each kind, from the counts of patterns in all rows."""
    rows = (found.select(F.explode("c").alias("c")).groupBy("c.kind", "c.base", "c.votes", "c.features")
            .agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "base", "votes", "features").collect())
    model = {}
    for number, kind in enumerate(KINDS):
        own = [r for r in rows if r.kind == number]
        if not own:
            continue
        votes = np.array([[v - 1 for v in unpack(r.votes, 3, len(LABELERS))] for r in own])
        features = np.array([unpack(r.features, 2, len(FEATURES)) for r in own])
        n = np.array([r.n for r in own], float)
        first = 1 / (1 + np.exp(-votes.sum(axis=1).astype(float)))
        p, _ = reliabilities(votes, first, n)
        model[kind] = logistic(inputs(votes, features), p, n).tolist()
    return model


def _score(c: Column, model: dict[str, list[float]]) -> Column:
    """The classifier as an expression on a candidate."""
    out = F.lit(0.0)
    for kind, w in model.items():
        s, k = F.lit(w[0]), len(LABELERS)
        for j in range(k):
            vote = F.floor(c["votes"] / 3 ** (k - 1 - j)) % 3
            s = s + F.when(vote == 2, w[1 + j]).when(vote == 0, w[1 + k + j]).otherwise(0.0)
        for j in range(len(FEATURES)):
            bit = F.floor(c["features"] / 2 ** (len(FEATURES) - 1 - j)) % 2
            s = s + F.when(bit == 1, w[1 + 2 * k + j]).otherwise(0.0)
        out = F.when(c["kind"] == KINDS.index(kind), 1 / (1 + F.exp(-s))).otherwise(out)
    return out


def find(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``(doc_id, base, spans)``: arrays of ``(s, kind, e, score)`` by start,
    then kind; ``spans`` are the base ones and those that the model adds."""
    scratch = Scratch(docs.sparkSession, "pii")
    found = candidates(docs, scratch)
    model = fit(found)
    scored = found.select("doc_id", F.array_sort(F.transform("c", lambda c: F.struct(
        c["s"].alias("s"), c["kind"].alias("kind"), c["e"].alias("e"), c["base"].alias("base"),
        _score(c, model).alias("score")))).alias("c"))
    base = F.filter("c", lambda c: c["base"])
    clear = lambda out, c: ~F.exists(out, lambda o: (o["s"] < c["e"]) & (c["s"] < o["e"]))
    added = F.filter("c", lambda c: ~c["base"] & (c["score"] >= least))
    spans = F.aggregate(added, F.col("base"), lambda out, c: F.when(
        clear(out, c), F.concat(out, F.array(c))).otherwise(out))
    return scored.select("doc_id", "c", base.alias("base")).select(
        "doc_id", "base", F.array_sort(F.when(F.size(added) > 0, spans).otherwise(F.col("base"))).alias("spans"))


def _text(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", names[c["kind"]], c["s"], c["e"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of base spans, the hash of their list, and all spans."""
    count = lambda k: F.size(F.filter("base", lambda c: c["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
                        F.sha2(_text("base"), 256).alias("base_sha256"), _text("spans").alias("spans"))
