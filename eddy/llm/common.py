"""Helpers shared by the training-data operators: words, row keys, scratch
tables in the shared folder, and joins whose broadcast side is counted first.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.session import ensure_checkpoint_dir, ship_package

# The ASCII bytes that separate words once A-Z are lower-cased
# (all but digits and letters), and white space.
WORD_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE_BREAKS = r"[\x20\x09-\x0D]+"

#: Most rows that a broadcast side may have; checked by a count every time.
BROADCAST_ROWS = 1_000_000


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character left as it is."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column, breaks: str = WORD_BREAKS) -> Column:
    """The lower-cased words of a text; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), breaks), "")


def once(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed a single time, however often ``f``
    uses it; Spark would otherwise compute a nested array expression anew at
    each use inside a higher-order function."""
    return F.transform(F.array(value), f)[0]


def text_key(text: Column) -> Column:
    """Tells rows of one id but different texts apart; equal for repeated rows."""
    return F.xxhash64(text)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of an Arrow batch that operators on texts take at a time.
BATCH_ROWS = "1000"


def for_texts(spark: SparkSession) -> SparkSession:
    """Prepares the session for Arrow stages on texts: ships the package, and
    lets batches be shorter than Spark's default of 10,000 rows, which long
    texts make large (a length that the user has set is kept)."""
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, BATCH_ROWS)
    return spark


def each_text(column):
    """The values of an Arrow column, one Python object at a time."""
    return (x.as_py() for x in column)


class Scratch:
    """Tables of one operator call, written below the shared checkpoint
    folder.  A written table cuts the lineage and survives the loss of any
    executor.  :meth:`drop` removes those that later steps no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        for f in frames:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(f._scratch_path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def join_counted(big: DataFrame, small: DataFrame, on, how: str = "inner",
                 rows: int = BROADCAST_ROWS) -> DataFrame:
    """``big`` joined with ``small`` (a stored table of narrow rows): broadcast
    when it has at most ``rows`` rows, by shuffle beyond."""
    if small.limit(rows + 1).count() <= rows:
        small = F.broadcast(small)
    return big.join(small, on, how)


def bucket(key: Column, modulus: int) -> Column:
    """crc32 of an id written as text, modulo ``modulus``."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % modulus


def bounded_sample(rows: DataFrame, key: str, most: int, seed: int = 7) -> DataFrame:
    """About ``most`` rows of ``rows`` at most, chosen by a hash of ``key``
    (all of them if there are fewer), alike on every run and layout."""
    n = rows.count()
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) < int((1 << 30) * most / n))


def labelled(docs: DataFrame, labels: DataFrame, name: str, keep: Column, most: int) -> DataFrame:
    """``(doc_id, text, y)`` of at most about ``most`` documents that have the
    label ``name`` and whose id fulfils ``keep``; the largest of several
    labels of one id counts.  The sampled labels are bounded, so they are
    broadcast and no text is shuffled."""
    y = labels.select("doc_id", F.col(name).alias("y")).where("doc_id IS NOT NULL AND y IS NOT NULL").where(keep)
    few = bounded_sample(y, "doc_id", most).groupBy("doc_id").agg(F.max("y").alias("y"))
    return docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")


def runs_of(batches, name: str):
    """From Arrow batches sorted by the column ``name``, one table for each
    run of equal values (a run may spread over batches)."""
    import numpy as np
    import pyarrow as pa

    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t])
        if not t.num_rows:
            continue
        k = t[name].to_numpy()
        cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist()]
        for i, j in zip(cuts, cuts[1:]):
            yield t.slice(i, j - i)
        held = t.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held
