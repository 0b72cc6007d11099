"""Row maps (T1-T5, T16, T17): column maps, filters, flat maps, and
batch-parallel maps with or without order."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep(df: DataFrame, cond: Column) -> DataFrame:
    """``filter``."""
    return df.filter(cond)


def drop_matching(df: DataFrame, cond: Column) -> DataFrame:
    """``filterNot``; a null condition counts as not matching."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def flat_map(df: DataFrame, items: Column, name: str = "item", pos: str | None = "pos",
             keep_cols: Sequence[str] | None = None) -> DataFrame:
    """One row per element of an array column.  With ``pos`` the
    element position is kept, so ``(outer order, pos)`` is the
    concatenated order (``flatMapConcat``); without it the sub-streams are
    merged in no order (``flatMapMerge``)."""
    cols = list(keep_cols) if keep_cols is not None else df.columns
    if pos:
        return df.select(*cols, F.posexplode(items).alias(pos, name))
    return df.select(*cols, F.explode(items).alias(name))


def parallel_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
                 width: int | None = None, order_by: Sequence[str] | None = None) -> DataFrame:
    """An arbitrary pandas function applied to Arrow batches in the
    input's own partitions; ``width``, if given, spreads few large partitions
    over that many tasks (``repartition``).  Order is a column, not a
    schedule: with ``order_by`` the result is sorted back by it (T16,
    ``mapAsync``); without, rows come in any order (T17,
    ``mapAsyncUnordered``).  Prefer column expressions when they can say
    the same."""
    src = df.repartition(width) if width else df

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)

    out = src.mapInPandas(run, schema)
    return out.orderBy(*order_by) if order_by else out
