"""Connected components of a stored table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame | None:
    """``(node, label)`` for every node of the links ``(a, b)``; ``label`` is
    the smallest node of its component.  None if there are no links.

    Each round points every node to its smallest neighbour, follows the
    pointers once more, and puts the pointers' targets in place of the ends
    of the links; rounds are few, as every component shrinks by half at least.
    Every step is a join or a grouped minimum, so no component is gathered."""
    edges = scratch.save(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                         .where("a < b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        up = both.groupBy("node").agg(F.min("other").alias("other")).select(
            "node", F.least("node", "other").alias("label"))
        up = scratch.save(up, "up")
        twice = up.select("node", F.col("label").alias("mid")).join(
            up.select(F.col("node").alias("mid"), "label"), "mid").select("node", "label")
        twice = scratch.save(twice, "twice")
        if labels is None:
            labels = twice
        else:
            step = twice.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = scratch.save(labels.join(step, "label", "left").select(
                "node", F.coalesce("next", "label").alias("label")), "labels")
        ends = lambda n: twice.select(F.col("node").alias(n), F.col("label").alias(f"to_{n}"))  # noqa: B023, E731
        edges = scratch.save(edges.join(ends("a"), "a").join(ends("b"), "b")
                             .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
                             .where("a < b").distinct(), "edges")
    return labels


def merged(comp: DataFrame | None, links: DataFrame, scratch: Scratch) -> DataFrame | None:
    """The components ``comp`` (None if there are none yet) after further
    stored ``links``, which are contracted to them first."""
    if comp is None:
        return components(links, scratch)
    label = lambda n: comp.select(F.col("node").alias(n), F.col("label").alias(f"to_{n}"))
    ends = links.join(label("a"), "a", "left").join(label("b"), "b", "left")
    more = components(ends.select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b")), scratch)
    if more is None:
        return comp
    old = comp.join(more.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select(
        "node", F.coalesce("to", "label").alias("label"))
    return scratch.save(old.union(more.join(comp.select("node"), "node", "left_anti").select("node", "label")), "merged")
