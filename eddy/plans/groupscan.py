"""Sequential scans over bounded groups, many groups per Python call.

``groupBy(...).applyInArrow`` makes one round trip per group, which
dominates when groups are small.  Here the rows are hash-partitioned on
the group columns, sorted inside each partition, and one ``mapInArrow``
call walks a whole partition, handing each group (whole and in order) to
the function.  Rows stay Arrow all the way, so columns that the function
does not touch keep their values exactly (nulls, large integers).  Callers
only pass groups of a bounded size (a key below a row threshold, or one
chunk of a hot key), so no task ever holds an unbounded group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def _starts(t: pa.Table, names: list[str]) -> list[int]:
    """Row numbers at which a new group starts (null equals null)."""
    if t.num_rows < 2:
        return [0]
    fresh = None
    for n in names:
        c = t[n].combine_chunks()
        a, b = c.slice(1), c.slice(0, len(c) - 1)
        differs = pc.or_kleene(pc.fill_null(pc.not_equal(a, b), False),
                               pc.not_equal(pc.is_null(a), pc.is_null(b)))
        fresh = differs if fresh is None else pc.or_(fresh, differs)
    return [0, *(pc.indices_nonzero(fresh).to_numpy() + 1).tolist()]


def sorted_group_map(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                     fn: Callable[[pa.Table], pa.Table], schema,
                     partitions: int | None = None) -> DataFrame:
    """``fn`` gets each group as one Arrow table in order and returns a table
    with the columns of ``schema``."""
    group_cols, order_cols = list(group_cols), list(order_cols)
    # Without a fixed count the shuffle takes spark.sql.shuffle.partitions
    # and AQE may coalesce small partitions; rows stream through Arrow
    # batches, so a partition may hold any number of (bounded) groups.
    parts = df.repartition(partitions, *group_cols) if partitions else df.repartition(*group_cols)
    parts = parts.sortWithinPartitions(*group_cols, *order_cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.Table] = []
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            if pending:
                # Only the group at the border is looked at again.
                edge = pa.concat_tables([pending[-1].slice(pending[-1].num_rows - 1), t.slice(0, 1)])
                if len(_starts(edge, group_cols)) == 2:
                    yield from fn(pa.concat_tables(pending)).to_batches()
                    pending = []
            starts = _starts(t, group_cols)
            done = []
            for i, j in zip(starts, starts[1:]):
                done.append(fn(pa.concat_tables([*pending, t.slice(i, j - i)])))
                pending = []
            if done:
                yield from pa.concat_tables(done).combine_chunks().to_batches()
            pending.append(t.slice(starts[-1]))
        if pending:
            yield from fn(pa.concat_tables(pending)).to_batches()

    return parts.mapInArrow(run, schema)
