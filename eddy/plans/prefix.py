"""Chunked prefix scan: running folds over a global (or per-key) order
without pulling all rows into one task.

A window with ``orderBy`` but no ``partitionBy`` moves the whole table into
one partition.  Here the order is cut into chunks by a monotone,
deterministic function of the leading order column:

1. Chunks are cut at quantiles of the leading order column (taken in one
   pass, collected as at most ``MAX_CELLS`` numbers and fixed), so outliers,
   bursts and hashed keys give even chunks too.  A chunk has at most about
   ``chunk_rows`` rows and ``CHUNK_BYTES`` of text.  Where that many cells are
   too few, each is cut again at quantiles of its own, level by level (a
   table of cuts, never collected), so chunks do not grow with the table.
   A chunk that a repeated leading value still fills is cut again by
   quantiles of the second order column.
2. Per (keys, chunk): the chunk totals (small: one row per chunk).
3. The carry of each chunk is the exclusive prefix of the chunk totals, a
   window over the chunk table only: inside each first cell, plus the carry
   of the cells before it.
4. Inside each chunk a window ``partitionBy(keys, chunk).orderBy(order)``
   computes the local running value, and the carry is joined back on
   (keys, chunk).  The join reuses the window's hash partitioning.

The input is read once more for the quantiles, and twice for the scan (rows
for the window, a map-side partial aggregate for the totals).  An input that is itself derived (a window,
join, aggregate or Python stage; for example the output of another scan)
is checkpointed first, so chained scans never recompute their inputs.

With ``partition_by`` keys of at most ``chunk_rows`` rows run as a plain
keyed window (one bounded group each); a hot key (say a third of all
rows) is spread over many chunks, so no task sees more than one chunk of
it.  Give a unique tie-break column last in ``order_by``.  Order columns may
be numbers, dates, timestamps, strings or binary; keys may be null.

Supported folds are associative: ``count``, ``sum``, ``max``, ``min``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddy.plans.joins import join_small

DEFAULT_CHUNK_ROWS = 1 << 20
# Bytes of text in a chunk: chunks of long texts have fewer rows.
CHUNK_BYTES = 1 << 27
# Cells of the first level (numbers that the driver holds) and of one cell
# on the levels below it (an array in the table of cuts).
MAX_CELLS = 4096
FAN_OUT = 256

_FOLDS = ("count", "sum", "max", "min")


def order_number(df: DataFrame, name: str) -> Column:
    """The leading order column as a number that keeps its order."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.TimestampNTZType):
        # Cast under the session zone; monotone (ties possible on DST folds).
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return c.cast("double")
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        # The first 7 bytes as a number; longer common beginnings are ties.
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("long")
    if isinstance(dtype, T.BooleanType):
        return c.cast("long")
    raise TypeError(f"cannot chunk on order column {name!r} of type {dtype}")


def _cell(k: Column, cuts: list, step: int = 64) -> Column:
    """The number of ``cuts`` (sorted) up to ``k``; null counts none."""
    at_most = lambda c: F.size(F.filter(c, lambda x: x <= k))
    everything = F.array(*[F.lit(c) for c in cuts])
    if len(cuts) <= step:
        return F.when(k.isNull(), 0).otherwise(at_most(everything))
    block = at_most(F.array(*[F.lit(c) for c in cuts[::step]]))
    inner = at_most(F.slice(everything, F.greatest((block - 1) * step + 1, F.lit(1)), step))
    return F.when(k.isNull() | (block == 0), 0).otherwise((block - 1) * step + inner)


def _text_bytes(df: DataFrame) -> Column:
    """The bytes of all texts of ``df`` (an aggregate)."""
    wide = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")).cast("long"), F.lit(0)) for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return F.coalesce(F.sum(sum(wide, F.lit(0).cast("long"))), F.lit(0)) if wide else F.lit(0).cast("long")


def _fitting_rows(df: DataFrame, chunk_rows: int) -> tuple[int, int]:
    """The rows of ``df``, and how many make a chunk: at most ``chunk_rows``,
    fewer if their texts are long."""
    n, size = df.agg(F.count(F.lit(1)), _text_bytes(df)).first()
    return n, min(chunk_rows, max(1, n * CHUNK_BYTES // size)) if size else chunk_rows


def quantile_cuts(df: DataFrame, k: Column, chunk_rows: int, n: int | None = None) -> list:
    """Quantiles of ``k`` that cut the (``n``) rows into chunks of about half
    of ``chunk_rows``: at most ``MAX_CELLS`` numbers, none for few rows."""
    n = df.count() if n is None else n
    cells = min(MAX_CELLS, math.ceil(2 * n / chunk_rows))
    if n <= chunk_rows or cells < 2:
        return []
    got = df.agg(F.percentile_approx(k, [i / cells for i in range(1, cells)], max(10_000, 20 * cells)).alias("c")).first()
    return sorted(set(got["c"] or []))


def _refine(src: DataFrame, groups: list[str], k: Column, chunk_rows: int, reverse: bool,
            prefix_: str) -> tuple[DataFrame, list[str]]:
    """Cut the cells (``groups``) that hold more than two chunks again, at
    quantiles of ``k`` of their own, as many levels deep as the largest
    needs.  Cells that one value fills stay as they are.  The table of cuts
    has a row for each such cell; it is broadcast only if it is small."""
    from eddy.session import cut_lineage
    added: list[str] = []
    src = src.withColumn("__rk", k)
    fan = max(2, min(MAX_CELLS, FAN_OUT))
    levels = None
    while levels is None or len(added) < levels:
        large = src.groupBy(*groups, *added).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 2 * chunk_rows)
        most = large.agg(F.max("__n")).first()[0]
        if not most:
            break
        levels = levels or math.ceil(math.log(2 * most / chunk_rows) / math.log(fan) - 1e-9)
        parts = min(fan, math.ceil(2 * most / chunk_rows))
        at = [*groups, *added]
        cuts = F.percentile_approx("__rk", [i / parts for i in range(1, parts)], max(10_000, 20 * parts))
        table = (join_small(src, large.select(*at), on=at, how="left_semi", max_rows=MAX_HEAVY_BROADCAST_ROWS)
                 .groupBy(*at).agg(F.array_sort(F.array_distinct(cuts)).alias("__cuts")))
        # Every 16th cut leads to the 16 that are looked through.
        table = cut_lineage(table.withColumn("__heads", F.filter("__cuts", lambda _, i: i % 16 == 0)))
        src = join_small(src, table, on=at, how="left", max_rows=MAX_HEAVY_BROADCAST_ROWS)
        block = F.size(F.filter("__heads", lambda c: c <= F.col("__rk")))
        inner = F.size(F.filter(F.slice("__cuts", F.greatest((block - 1) * 16 + 1, F.lit(1)), 16),
                                lambda c: c <= F.col("__rk")))
        cell = F.when(F.col("__rk").isNull() | (block == 0), 0).otherwise((block - 1) * 16 + inner)
        cell = F.size("__cuts") - cell if reverse else cell
        name = f"{prefix_}{len(added) + 1}"
        src = src.withColumn(name, F.when(F.col("__cuts").isNull(), 0).otherwise(cell).cast("long")) \
                 .drop("__cuts", "__heads")
        added.append(name)
    return src.drop("__rk"), added


def _chunk_plan(df: DataFrame, lead: str, chunk_rows: int, reverse: bool, chunk_width: float | None = None,
                n: int | None = None):
    """Chunk column for ``df`` and the number of chunks (of the first
    level).  Chunks are cut at quantiles, or every ``chunk_width`` if the
    caller asks for that."""
    k = order_number(df, lead)
    if chunk_width is not None:
        lo, hi = df.agg(F.min(k), F.max(k)).first()
        cuts = [0] if lo is None else [lo + i * chunk_width
                                       for i in range(min(MAX_CELLS, math.ceil((hi - lo + 1) / chunk_width)))]
    else:
        # A cut at 0 where none is needed keeps the plan the same at any size.
        cuts = quantile_cuts(df, k, chunk_rows, n) or [0]
    cell = _cell(k, cuts).cast("long")
    return (F.lit(len(cuts)).cast("long") - cell if reverse else cell), len(cuts) + 1


# Bucket of more than this many chunk sizes counts as heavy (tied values).
HEAVY_FACTOR = 2
MAX_HEAVY_BROADCAST_ROWS = 2_000_000


def _split_ties(src: DataFrame, order_by: list[str], keys: list[str], chunk_rows: int,
                reverse: bool, cells: Sequence[str] = ("__c1",)) -> tuple[DataFrame, list[str]]:
    """Split chunks that hold many rows of one leading value.

    For such chunks (of ``cells``) the chunk gets two more parts: ``__c2`` orders the rows
    around the heavy values of the chunk (2 x the number of heavy values
    before the row's value, +1 on a heavy value) and ``__c3`` cuts the rows
    of one heavy value at quantiles of the second order column.  The
    heavy-value tables hold at most rows / chunk_rows entries (each heavy
    value has more than chunk_rows rows); they are broadcast after a check
    of rows and bytes.
    """
    limit = HEAVY_FACTOR * chunk_rows
    cells = list(cells)
    at = [*keys, *cells]
    heavy_b = src.groupBy(*at).count().filter(F.col("count") > limit).select(*at)
    if heavy_b.isEmpty():
        return src, cells
    lead, second = order_by[0], order_by[1]
    tagged = src.withColumn("__k", order_number(src, lead)).withColumn("__k2", order_number(src, second))
    in_heavy = join_small(tagged, heavy_b, on=at, how="left_semi", max_rows=MAX_HEAVY_BROADCAST_ROWS)
    counts = (in_heavy.groupBy(*at, "__k").agg(F.count(F.lit(1)).alias("__n"))
                      .filter(F.col("__n") > chunk_rows))
    most = counts.agg(F.max("__n")).first()[0]
    if not most:
        return src, cells
    parts = max(2, min(MAX_CELLS, math.ceil(2 * most / chunk_rows)))
    cuts = F.percentile_approx("__k2", [i / parts for i in range(1, parts)], max(10_000, 20 * parts))
    stats = join_small(in_heavy, counts.select(*at, "__k"), on=[*at, "__k"], how="left_semi",
                       max_rows=MAX_HEAVY_BROADCAST_ROWS)
    stats = stats.groupBy(*at, "__k").agg(F.array_sort(F.array_distinct(cuts)).alias("__cuts"))
    from eddy.session import cut_lineage
    stats = cut_lineage(stats)
    per_bucket = stats.groupBy(*at).agg(F.sort_array(F.collect_list("__k")).alias("__hv"))
    out = join_small(tagged, per_bucket, on=at, how="left", max_rows=MAX_HEAVY_BROADCAST_ROWS)
    out = join_small(out, stats, on=[*at, "__k"], how="left", max_rows=MAX_HEAVY_BROADCAST_ROWS)
    before = (lambda v: v > F.col("__k")) if reverse else (lambda v: v < F.col("__k"))
    c2 = F.when(F.col("__hv").isNull(), F.lit(0)).otherwise(
        F.size(F.filter("__hv", before)) * 2 + F.array_contains("__hv", F.col("__k")).cast("int"))
    piece = F.size(F.filter("__cuts", lambda c: c <= F.col("__k2")))
    c3 = F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(F.size("__cuts") - piece if reverse else piece)
    out = out.withColumn("__c2", F.coalesce(c2, F.lit(0)).cast("long")).withColumn("__c3", c3.cast("long"))
    refined = len(cells) > 1
    cells = [*cells, "__c2", "__c3"]
    out = out.drop("__hv", "__cuts")
    if refined or 2 * most / chunk_rows > parts:
        # Rows of one heavy value are ordered by the second column, the rows
        # between heavy values by the leading one.
        rank = F.when(F.col("__c2") % 2 == 1, F.col("__k2")).otherwise(F.col("__k"))
        out, more = _refine(out, [*keys, *cells], rank, chunk_rows, reverse, "__t")
        cells += more
    return out.drop("__k", "__k2"), cells


# Plan nodes that cost nothing to run twice.
_CHEAP = {"Project", "Filter", "LogicalRelation", "LogicalRDD", "LocalRelation", "Range", "SubqueryAlias"}


def materialize_if_derived(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` (to the shared checkpoint folder) when its plan is
    more than a scan with projections and filters, so a consumer that reads
    it twice does not compute it twice; a plain scan is returned as is."""
    stack = [df._jdf.queryExecution().optimizedPlan()]
    while stack:
        node = stack.pop()
        if node.getClass().getSimpleName() not in _CHEAP:
            from eddy.session import cut_lineage
            return cut_lineage(df)
        kids = node.children()
        stack.extend(kids.apply(i) for i in range(kids.size()))
    return df


def _keyed_window(df: DataFrame, order_by: list[str], folds, keys: list[str], exclusive: bool,
                  reverse: bool) -> DataFrame:
    """The running folds as one keyed window (every key is small)."""
    ordering = [F.col(c).desc() if reverse else F.col(c).asc() for c in order_by]
    w = Window.partitionBy(*keys).orderBy(*ordering).rowsBetween(
        Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
    out = df
    for name, (fold, col) in folds.items():
        v = F.lit(1).cast("long") if fold == "count" else col
        agg = (F.sum if fold in ("count", "sum") else (F.max if fold == "max" else F.min))(v).over(w)
        if fold == "count":
            agg = F.coalesce(agg, F.lit(0)).cast("long")
        out = out.withColumn(name, agg)
    return out


def _merged(fold: str, a: Column, b: Column) -> Column:
    """The fold of two parts; a part that is null has no values."""
    if fold in ("count", "sum"):
        return F.when(a.isNotNull() & b.isNotNull(), a + b).otherwise(F.coalesce(a, b))
    return F.greatest(a, b) if fold == "max" else F.least(a, b)


def running(df: DataFrame, order_by: Sequence[str], folds: dict[str, tuple[str, Column | None]],
            partition_by: Sequence[str] = (), exclusive: bool = False, reverse: bool = False,
            chunk_rows: int = DEFAULT_CHUNK_ROWS, chunk_width: float | None = None,
            split_ties: bool = True) -> DataFrame:
    """Add running folds over ``order_by`` (optionally per ``partition_by``).

    ``folds`` maps an output name to ``(fold, column)``; fold is one of
    count/sum/max/min (``count`` ignores the column).  ``exclusive`` leaves
    the current row out; ``reverse`` runs from the last row backwards.
    With ``split_ties`` a leading value shared by very many rows (a hot
    timestamp) is split further by the second order column, so no chunk
    grows past a few ``chunk_rows``.
    """
    order_by, keys = list(order_by), list(partition_by)
    for name, (fold, _) in folds.items():
        if fold not in _FOLDS:
            raise ValueError(f"fold {fold!r} for {name!r} is not associative/supported")
    df = materialize_if_derived(df)
    names = keys
    if keys:
        # Keys up to chunk_rows rows and CHUNK_BYTES are one chunk each: a plain keyed
        # window.  Only hot keys (at most rows / chunk_rows of them, so
        # the list is broadcast after a size check) are cut into chunks.
        # Joins need keys that are never null.
        df = df.withColumn("__pkey", F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)])))
        keys = ["__pkey"]
        hot = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), _text_bytes(df.drop(*keys)).alias("__size"))
                 .filter((F.col("__n") > chunk_rows) | (F.col("__size") > CHUNK_BYTES)).select(*keys))
        if hot.isEmpty():
            return _keyed_window(df.drop("__pkey"), order_by, folds, names, exclusive, reverse)
        tagged = join_small(df, hot.withColumn("__hot", F.lit(True)), on=keys, how="left",
                            max_rows=MAX_HEAVY_BROADCAST_ROWS)
        rows = tagged.filter(F.col("__hot"))
        n, chunk_rows = _fitting_rows(rows.drop(*keys), chunk_rows) if chunk_width is None else (None, chunk_rows)
        chunk, n_chunks = _chunk_plan(rows, order_by[0], chunk_rows, reverse, chunk_width, n)
        src = tagged.withColumn("__c1", F.when(F.col("__hot"), chunk).otherwise(F.lit(-1).cast("long"))) \
                    .drop("__hot")
    else:
        n, chunk_rows = _fitting_rows(df, chunk_rows) if chunk_width is None else (None, chunk_rows)
        chunk, n_chunks = _chunk_plan(df, order_by[0], chunk_rows, reverse, chunk_width, n)
        src = df.withColumn("__c1", chunk)
    cks = ["__c1"]
    if chunk_width is None and n_chunks > MAX_CELLS // 2:
        # Perhaps as many cells as there can be: the large ones are cut again.
        src, more = _refine(src, [*keys, "__c1"], order_number(src, order_by[0]), chunk_rows, reverse, "__r")
        cks += more
    if split_ties and len(order_by) > 1 and n_chunks > 2:
        src, cks = _split_ties(src, order_by, keys, chunk_rows, reverse, cks)
    for name, (fold, col) in folds.items():
        src = src.withColumn(f"__v_{name}", F.lit(1).cast("long") if fold == "count" else col)

    ordering = [F.col(c).desc() if reverse else F.col(c).asc() for c in order_by]
    upto = -1 if exclusive else Window.currentRow
    local_w = Window.partitionBy(*keys, *cks).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, upto)

    def fold_fn(fold):
        return F.sum if fold in ("count", "sum") else (F.max if fold == "max" else F.min)

    local = src
    for name, (fold, _) in folds.items():
        local = local.withColumn(f"__l_{name}", fold_fn(fold)(F.col(f"__v_{name}")).over(local_w))

    totals = src.groupBy(*keys, *cks).agg(
        *[fold_fn(fold)(F.col(f"__v_{name}")).alias(f"__t_{name}") for name, (fold, _) in folds.items()])

    def before(table: DataFrame, groups: list[str], order: list[str], out: str) -> DataFrame:
        """The fold of the totals before each row of ``table``."""
        w = Window.partitionBy(*groups).orderBy(*[F.col(c) for c in order]) \
            .rowsBetween(Window.unboundedPreceding, -1)
        return table.select(*keys, *cks[:1 if table is coarse else None], *[
            fold_fn(fold)(F.col(f"__t_{name}")).over(w).alias(f"__{out}_{name}") for name, (fold, _) in folds.items()])

    coarse = None
    if len(cks) == 1 or cks[1] == "__c2":
        carry = before(totals, keys, cks, "c")
    else:
        # Many chunks: the carry inside each first cell, and that of the cells.
        coarse = totals.groupBy(*keys, "__c1").agg(
            *[fold_fn(fold)(F.col(f"__t_{name}")).alias(f"__t_{name}") for name, (fold, _) in folds.items()])
        inner = before(totals, [*keys, "__c1"], cks[1:], "i")
        outer = before(coarse, keys, ["__c1"], "o")
        carry = join_small(inner, outer, on=[*keys, "__c1"], how="left").select(*keys, *cks, *[
            _merged(fold, F.col(f"__o_{name}"), F.col(f"__i_{name}")).alias(f"__c_{name}")
            for name, (fold, _) in folds.items()])
    if not keys and len(cks) == 1:
        # One row per chunk: at most MAX_CELLS.
        carry = F.broadcast(carry)
    joined = local.join(carry, on=[*keys, *cks], how="left")

    out = joined
    for name, (fold, _) in folds.items():
        val = _merged(fold, F.col(f"__c_{name}"), F.col(f"__l_{name}"))
        # Only a sum without any value stays null.
        out = out.withColumn(name, F.coalesce(val, F.lit(0)) if fold == "count" else val)
    drop = ["__pkey", *cks, *[f"__{p}_{n}" for n in folds for p in ("v", "l", "c")]]
    return out.drop(*drop)


def with_index(df: DataFrame, order_by: Sequence[str], name: str = "idx",
               partition_by: Sequence[str] = (), **kw) -> DataFrame:
    """0-based position of each row in ``order_by`` (zipWithIndex)."""
    out = running(df, order_by, {name: ("count", None)}, partition_by=partition_by, **kw)
    return out.withColumn(name, (F.col(name) - 1).cast("long"))
