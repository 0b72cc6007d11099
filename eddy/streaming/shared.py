"""One set of ids shared by several live streams."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shared_ids(streams: Sequence[DataFrame], key: str | Sequence[str], ts: str, within: str) -> DataFrame:
    """The ids of all ``streams``, each once: whichever stream brings an id
    first adds it to the set, and the others find it there.

    The set is the state of Spark's own deduplication, partitioned by id; a
    hot id is one entry.  An id is forgotten once every stream's watermark
    is ``within`` past its first time, so the set holds the ids of about
    that span and not all that ever came.  An id that comes again later
    than that is new again.  Rows older than the watermark (the slowest
    stream's largest time less ``within``) are dropped.  A null id is an id.
    """
    keys = [key] if isinstance(key, str) else list(key)
    timed = [s.select(*keys, F.col(ts).cast("timestamp").alias("__time")).withWatermark("__time", within)
             for s in streams]
    return reduce(DataFrame.unionByName, timed).dropDuplicatesWithinWatermark(keys).select(*keys)
