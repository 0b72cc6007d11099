"""Operator 2: mixing sources to target weights by iterative proportional
fitting.

1. Each document gets a category in every dimension (source, language,
   topic); categories without a target are put together as ``*``.
2. Tokens are added up by cell, a combination of categories.  Targets are
   parameters, so the number of cells is bounded by them.
3. Raking: in turn, each dimension's factors are multiplied by target share /
   present share, until all marginals agree with the targets; ``weight`` is
   their product.
4. No document can be kept more than once, so probabilities are raked with
   that bound: ``prob`` is ``min(1, product of factors)``, and in turn each
   category's factor is set such that its expected tokens, clipped cells at 1
   among them, are its target share of ``keep`` of all tokens.  A document is
   kept if a hash of its id and text falls below its cell's probability.

Targets of categories that have no tokens are dropped; ``*`` keeps its
natural share of tokens unless it has a target; what remains is shared out in
proportion.  ``keep`` holds: a category with fewer tokens than its target
share of them is kept whole, and what it lacks is shared out over the other
categories of its dimension in proportion to their targets.  If targets
contradict each other (through empty cells, or cells that have too few tokens
together) the factors of the last round are taken, which meet the targets of
the last dimension and ``keep``.

Defined cases: null categories are ``*``; null and empty texts have no tokens
and are sampled like their cell; repeated rows share one draw; other columns
(also any named like the operator's) are kept by :func:`sample` as they are;
without any tokens every probability is 0.
"""

from __future__ import annotations

from math import prod

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_BREAKS, Scratch, once, text_key

OTHER = "*"
ROUNDS = 60
CLOSE = 1e-6
SEED = 2024

#: Production targets of the query: shares of tokens.
TARGETS = {
    "source": {f"src{i}": 0.05 for i in range(20)},
    "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15},
    "topic": {"prose": 0.85, "table": 0.05, "symbols": 0.04, "shouting": 0.04, "short": 0.02},
}
KEEP = 0.5


def n_tokens(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_BREAKS), "")).cast("long")


def topic(text: Column, tokens: Column) -> Column:
    """A rough topic by the form of the text."""
    count = lambda p: F.regexp_count(text, F.lit(p))
    return (F.when(tokens < 20, "short").when(count(r"\|") * 5 >= tokens, "table")
            .when(count(r"[#$%&*]{3}") * 5 >= tokens, "symbols")
            .when(count(r"\b[A-Z]{2,}\b") * 2 >= tokens, "shouting").otherwise("prose"))


def described(docs: DataFrame) -> DataFrame:
    """``docs`` with struct ``_mix``: its tokens and categories (in place of
    a column of that name)."""
    return docs.withColumn("_mix", once(n_tokens(F.col("text")), lambda t: F.struct(
        t.alias("tokens"), F.col("source").alias("source"), F.col("lang").alias("lang"),
        topic(F.col("text"), t).alias("topic"), text_key(F.col("text")).alias("tk"))))


def _category(c: Column, target: dict[str, float]) -> Column:
    return F.when(c.isin(*target), c).otherwise(OTHER) if target else F.lit(OTHER)


def _lookup(values: dict[str, float], c: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[c]


def cells(rows: DataFrame, targets: dict[str, dict[str, float]]) -> DataFrame:
    """Tokens by cell; at most the product of (targets + 1) rows."""
    return rows.groupBy(*[_category(F.col(f"_mix.{d}"), t).alias(d) for d, t in targets.items()]).agg(
        F.sum("_mix.tokens").cast("double").alias("tokens")).where("tokens > 0")


def goal_shares(target: dict[str, float], have: dict[str, float]) -> dict[str, float]:
    """Shares of the categories that have tokens."""
    total = sum(have.values())
    goal = {c: target[c] for c in have if c in target}
    if not goal:
        return {c: v / total for c, v in have.items()} if total else {}
    other = have.get(OTHER, 0.0) / total if total and OTHER not in target else 0.0
    scale = (1 - other) / (sum(goal.values()) or 1)
    return {c: g * scale for c, g in goal.items()} | ({OTHER: other} if other else {})


def rake(table: DataFrame, targets: dict[str, dict[str, float]], rounds: int = ROUNDS,
         close: float = CLOSE) -> dict[str, dict[str, float]]:
    """The factors of each dimension's categories.  Every step is one small
    aggregation, whose result has a row for each category."""
    factors: dict[str, dict[str, float]] = {}
    goals: dict[str, dict[str, float]] = {}

    def marginal(d: str) -> dict[str, float]:
        w = F.col("tokens")
        for e, f in factors.items():
            w = w * _lookup(f, F.col(e))
        return {r[0]: r[1] for r in table.groupBy(d).agg(F.sum(w)).collect()}

    for d, t in targets.items():
        have = marginal(d)
        goals[d] = goal_shares(t, have)
    if not all(goals.values()):
        return {d: {OTHER: 0.0} for d in targets}
    for d in targets:
        factors[d] = dict.fromkeys(goals[d], 1.0)
    for _ in range(rounds):
        off = 0.0
        for d, goal in goals.items():
            have = marginal(d)
            total = sum(have.values())
            for c, g in goal.items():
                share = have.get(c, 0.0) / total if total else 0.0
                if share > 0:
                    off = max(off, abs(share - g))
                    factors[d][c] *= g / share
        if off < close:
            break
    return factors


def within(goal: dict[str, float], have: dict[str, float], amount: float) -> dict[str, float]:
    """Tokens of each category: ``amount`` in all by the shares ``goal``, but
    from none more than it has."""
    full: dict[str, float] = {}
    while True:
        rest = {c: g for c, g in goal.items() if c not in full}
        scale = max(0.0, amount - sum(full.values())) / (sum(rest.values()) or 1)
        short = {c: have[c] for c, g in rest.items() if g * scale >= have[c]}
        if not short:
            return full | {c: g * scale for c, g in rest.items()}
        full |= short


def _factor(tokens: np.ndarray, others: np.ndarray, goal: float) -> float:
    """``f`` for which the sum of ``tokens * min(1, f * others)`` is ``goal``."""
    order = np.argsort(-others)
    t, r = tokens[order], others[order]
    clipped = np.concatenate([[0.0], np.cumsum(t)[:-1]])
    free = np.cumsum((t * r)[::-1])[::-1]
    f = (goal - clipped) / free  # if the first 0, 1, .. cells are clipped
    fits = np.flatnonzero(f * r <= 1)
    return float(f[fits[0]]) if len(fits) else float(1 / r[-1])


def bounded(table: DataFrame, targets: dict[str, dict[str, float]], factors: dict[str, dict[str, float]], keep: float,
            rounds: int = 1000, close: float = CLOSE) -> dict[str, dict[str, float]]:
    """Factors whose product, clipped at 1, is the probability of a cell.
    ``factors`` are the raked ones; the cells, as many as the targets'
    combinations at most, are raked here on the driver."""
    rows = table.collect()
    total = sum(x.tokens for x in rows)
    weight = np.array([prod(factors[d].get(x[d], 0.0) for d in targets) for x in rows])
    rows, weight = [x for x, w in zip(rows, weight) if w > 0], weight[weight > 0]
    out = {d: dict.fromkeys(factors[d], 0.0) for d in targets}
    if not rows or keep <= 0:
        return out
    tokens = np.array([x.tokens for x in rows])
    amount = min(keep * total, tokens.sum())
    at = {d: {c: np.flatnonzero([x[d] == c for x in rows]) for c in {x[d] for x in rows}} for d in targets}
    goals = {}
    for d, places in at.items():
        have = {c: float(tokens[i].sum()) for c, i in places.items()}
        out[d] |= {c: factors[d][c] for c in places}
        goals[d] = within(goal_shares(targets[d], have), have, amount)
    prob = weight.copy()
    for _ in range(rounds):
        off = 0.0
        for d, goal in goals.items():
            for c, i in at[d].items():
                off = max(off, abs(tokens[i] @ np.minimum(1, prob[i]) - goal[c]) / amount)
                others = prob[i] / out[d][c]
                out[d][c] = min(max(_factor(tokens[i], others, goal[c]), 1e-90), 1e90)
                prob[i] = others * out[d][c]
        if off < close:
            break
    return out


def _plan(rows: DataFrame, targets, keep: float) -> tuple[dict, dict, dict]:
    """Targets, raked factors, and factors raked within [0, 1]."""
    targets = TARGETS if targets is None else targets
    table = Scratch(rows.sparkSession, "mixing").save(cells(rows, targets).coalesce(1), "cells")
    factors = rake(table, targets)
    return targets, factors, bounded(table, targets, factors, keep)


def _product(factors: dict[str, dict[str, float]], targets, of) -> Column:
    """The product of the factors of the categories ``of(dimension)``."""
    out = F.lit(1.0)
    for d, t in targets.items():
        out = out * F.coalesce(_lookup(factors[d], _category(of(d), t)), F.lit(0.0))
    return out


def _drawn(doc_id: Column, tk: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), doc_id, tk), 11) / F.lit(float(1 << 53))


def probabilities(docs: DataFrame, targets=None, keep: float = KEEP) -> DataFrame:
    """``docs`` with struct ``_mix`` extended by ``weight`` (the raked factor)
    and ``prob`` (raked within [0, 1]), and ``_draw`` in [0, 1); columns of
    these two names are replaced."""
    rows = described(docs)
    targets, factors, limited = _plan(rows, targets, keep)
    of = lambda d: F.col(f"_mix.{d}")
    return (rows.withColumn("_mix", F.col("_mix").withField("weight", _product(factors, targets, of)))
            .withColumn("_mix", F.col("_mix").withField("prob", F.least(F.lit(1.0), _product(limited, targets, of))))
            .withColumn("_draw", _drawn(F.col("doc_id"), F.col("_mix.tk"))))


def sample(docs: DataFrame, targets=None, keep: float = KEEP) -> DataFrame:
    """The kept rows of ``docs``, with its columns, whatever their names."""
    targets, _, limited = _plan(described(docs.select("doc_id", "source", "lang", "text")), targets, keep)
    # The row travels as one struct; its words and topic are worked out once.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row.text")
    parts = once(n_tokens(text), lambda t: F.struct(topic(text, t).alias("topic"), F.col("row.source").alias("source"),
                                                    F.col("row.lang").alias("lang")))
    prob = once(parts, lambda p: F.least(F.lit(1.0), _product(limited, targets, lambda d: p[d])))
    return rows.where(_drawn(F.col("row.doc_id"), text_key(text)) < prob).select("row.*")
