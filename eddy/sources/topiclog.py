"""A file-backed, append-only topic log with offsets (S11-S14, K9-K13,
K20, J2, A13).

The log is a parquet table partitioned by ``topic`` and ``partition``
with the Kafka-source columns ``offset, timestamp, key, value`` plus the
``batch_id`` that wrote each row.  Reads by topic, partition and start
offset are filters that Spark prunes to the partition folders and pushes
into the parquet scan.  A Kafka cluster is the same schema:
:func:`kafka_options` builds the options for ``format("kafka")`` when the
connector is on the class path.

Offsets need one writer per topic-partition: an append computes
``next_offset + position`` per (topic, partition), positions coming from
the chunked prefix scan, so a hot partition is indexed by many tasks.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddy.plans import prefix
from eddy.plans.joins import join_small

# Fixed values (result texts of the producer): one record's place is
# "topic/partition offset: value"; a single publish is "single " and its place,
# a publish to several topics "multi " and all places joined by ", ", and a
# message that is published nowhere "passed through".
REPORT_FORMAT = "%s/%d %d: %s"
SINGLE, MULTI, PLACES_BETWEEN = "single ", "multi ", ", "
PASSED_THROUGH = "passed through"

LOG_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("batch_id", T.LongType()),
])


def records(df: DataFrame, topic: Column | str, partition: Column, key: Column | None,
            value: Column, timestamp: Column | None = None) -> DataFrame:
    """Shape rows as log records (``ProducerRecord``): topic, partition,
    key and value as bytes, timestamp."""
    t = F.lit(topic) if isinstance(topic, str) else topic
    return df.select(
        "*",
        t.cast("string").alias("topic"),
        partition.cast("int").alias("partition"),
        (key.cast("binary") if key is not None else F.lit(None).cast("binary")).alias("key"),
        value.cast("binary").alias("value"),
        (timestamp if timestamp is not None else F.current_timestamp()).cast("timestamp").alias("timestamp"))


def assign_offsets(recs: DataFrame, order_by: Sequence[str], positions: DataFrame | None = None) -> DataFrame:
    """K9: offsets for records about to be appended: the partition's next
    offset (0 for a new partition) plus the record's position in
    ``order_by`` within its (topic, partition)."""
    out = prefix.with_index(recs, order_by, "__pos", partition_by=["topic", "partition"])
    if positions is not None:
        out = join_small(out, positions.select("topic", "partition", "next_offset"),
                         on=["topic", "partition"], how="left")
        base = F.coalesce(F.col("next_offset"), F.lit(0))
        out = out.withColumn("offset", (base + F.col("__pos")).cast("long")).drop("next_offset")
    else:
        out = out.withColumn("offset", F.col("__pos").cast("long"))
    return out.drop("__pos")


def report(df: DataFrame, name: str = "report") -> DataFrame:
    """``topic/partition offset: value`` for each appended record."""
    return df.withColumn(name, F.format_string(REPORT_FORMAT, F.col("topic"), F.col("partition"),
                                               F.col("offset"), F.col("value").cast("string")))


def fan_out(df: DataFrame, targets: Column, passed: str = PASSED_THROUGH) -> DataFrame:
    """One row published to each topic of ``targets`` (an array of
    topic names); an empty array publishes nothing but still yields a
    result row with a null topic."""
    out = df.withColumn("topic", F.explode_outer(targets))
    return out.withColumn("result", F.when(F.col("topic").isNull(), F.lit(passed))
                          .otherwise(F.concat(F.lit("published to "), F.col("topic"))))


def publish_results(appended: DataFrame, messages: DataFrame, key: str) -> DataFrame:
    """The result of each message (``key``): ``single`` and its
    record's place, ``multi`` and the places of all its records (by topic
    and partition), or the pass-through text for a message without record.
    A message has as many records as it names topics."""
    places = F.sort_array(F.collect_list(F.struct("topic", "partition", F.col(REPORT).alias("place"))))
    per = (report(appended, REPORT).groupBy(key).agg(places.alias("__p"))
           .select(F.col(key).alias("__key"), F.size("__p").alias("__n"),
                   F.array_join(F.col("__p.place"), PLACES_BETWEEN).alias("__text")))
    text = (F.when(F.col("__n").isNull(), F.lit(PASSED_THROUGH))
             .when(F.col("__n") == 1, F.concat(F.lit(SINGLE), F.col("__text")))
             .otherwise(F.concat(F.lit(MULTI), F.col("__text"))))
    # As many rows as messages: never broadcast.
    return messages.join(per.hint("merge"), F.col(key).eqNullSafe(F.col("__key")), "left").select(
        *[messages[c] for c in messages.columns], text.alias("result"))


REPORT = "__report"


def commit_positions(consumed: DataFrame, batch: str | None = "batch") -> DataFrame:
    """The offset to commit per (batch, topic, partition): the highest
    offset consumed plus one.  Map-side combined."""
    keys = ([batch] if batch else []) + ["topic", "partition"]
    return consumed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                       (F.max("offset") + 1).alias("commit_offset"))


def commit_pairs(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """A13 with two inputs: one commit for each pair of batches of two logs:
    the positions of both (``left_``, ``right_``), joined on ``on``."""
    named = lambda df, side: df.select(*on, *[F.col(c).alias(f"{side}_{c}") for c in df.columns if c not in on])
    return named(left, "left").join(named(right, "right"), list(on))


def offset_batches(consumed: DataFrame, size: int, name: str = "batch") -> DataFrame:
    """A11 on a log: batches of ``size`` records per partition in offset
    order.  Offsets of a partition are dense from its start offset, so the
    batch is arithmetic on the offset: no sort, no shuffle."""
    start = consumed.groupBy("topic", "partition").agg(F.min("offset").alias("__start"))
    out = join_small(consumed, start, on=["topic", "partition"], how="left")
    return out.withColumn(name, F.floor((F.col("offset") - F.col("__start")) / size).cast("long")).drop("__start")


def zip_partitions(left: DataFrame, right: DataFrame) -> DataFrame:
    """Partition p of the left log with partition p of the right,
    position by position (the i-th record of each)."""
    lp = prefix.with_index(left, ["offset"], "pos", partition_by=["partition"])
    rp = prefix.with_index(right, ["offset"], "pos", partition_by=["partition"])
    lcols = [F.col(c).alias(f"left_{c}") for c in lp.columns if c not in ("partition", "pos")]
    rcols = [F.col(c).alias(f"right_{c}") for c in rp.columns if c not in ("partition", "pos")]
    return lp.select("partition", "pos", *lcols).join(rp.select("partition", "pos", *rcols),
                                                     on=["partition", "pos"], how="inner")


class TopicLog:
    """An append-only log in a folder.

    Records live under ``topic=/partition=/batch_id=`` folders.  A batch is
    written to a hidden staging folder first; then
    ``_positions/batch_id=<b>`` records the next offset of every (topic,
    partition), one small row each, which is the batch's commit mark; then
    its folders are moved into place.  Files of a batch without its mark
    are therefore never in place, for batch or stream readers, and a crash
    between mark and move is finished by whoever opens the log next.  Only
    the last mark is kept.  Batch ids rise; no append scans the log.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def last_batch(self) -> int | None:
        """The last committed batch id, after finishing its move."""
        _, fs = self._fs()
        pos = self._path("_positions")
        if not fs.exists(pos):
            return None
        marks = [int(st.getPath().getName()[9:]) for st in fs.listStatus(pos)
                 if st.getPath().getName().startswith("batch_id=")
                 and fs.exists(self._path("_positions", st.getPath().getName(), "_SUCCESS"))]
        if not marks:
            return None
        last = max(marks)
        self._publish(last)
        for b in marks:
            if b < last:
                fs.delete(self._path("_positions", f"batch_id={b}"), True)
        return last

    def _publish(self, batch_id: int) -> None:
        """Move a committed batch's staged folders into place."""
        _, fs = self._fs()
        staged = self._path(f"_staging-{batch_id}")
        if not fs.exists(staged):
            return
        for st in fs.globStatus(self._path(f"_staging-{batch_id}", "topic=*", "partition=*")) or []:
            part = st.getPath()
            leaf = (part.getParent().getName(), part.getName())
            target = self._path(*leaf, f"batch_id={batch_id}")
            if not fs.exists(target):
                fs.mkdirs(self._path(*leaf))
                fs.rename(part, target)
        fs.delete(staged, True)

    def has_batch(self, batch_id: int) -> bool:
        last = self.last_batch()
        if last is None or batch_id > last:
            return False
        _, fs = self._fs()
        return batch_id == last or bool(fs.globStatus(self._path("topic=*", "partition=*", f"batch_id={batch_id}")))

    def read(self, topics: Sequence[str] | None = None,
             assignment: Mapping[tuple[str, int], int | None] | None = None) -> DataFrame:
        """Records of ``topics`` (subscribe, from earliest) or
        of an assignment ``{(topic, partition): start_offset or None}``
        (a None start reads the whole partition).  Only committed batches;
        topic and partition filters prune folders, the offset filter is
        pushed into the parquet scan."""
        _, fs = self._fs()
        if self.last_batch() is None or not fs.globStatus(self._path("topic=*")):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        df = self.spark.read.schema(LOG_SCHEMA).parquet(self.path)
        if topics is not None:
            df = df.filter(F.col("topic").isin(list(topics)))
        if assignment is not None:
            cond = F.lit(False)
            for (t, p), off in assignment.items():
                c = (F.col("topic") == t) & (F.col("partition") == p)
                if off is not None:
                    c = c & (F.col("offset") >= off)
                cond = cond | c
            df = df.filter(cond)
        return df

    def positions(self) -> DataFrame:
        """Next offset per (topic, partition) after the last committed batch."""
        last = self.last_batch()
        if last is None:
            return self.spark.createDataFrame([], "topic string, partition int, next_offset long")
        return self.spark.read.parquet(f"{self.path}/_positions/batch_id={last}")

    def append(self, recs: DataFrame, order_by: Sequence[str], batch_id: int | None = None) -> DataFrame:
        """K9: append records with offsets as batch ``batch_id`` (the next id
        when None); returns the appended rows (the K10 result).  A batch id
        already committed is skipped, so a replayed micro-batch does not
        write twice."""
        last = self.last_batch()
        if batch_id is None:
            batch_id = 0 if last is None else last + 1
        mine = F.col("batch_id") == batch_id
        if last is not None and batch_id <= last:
            if self.has_batch(batch_id):
                return self.read().filter(mine)
            raise ValueError(f"batch {batch_id} comes after committed batch {last}")
        base = self.positions()
        out = assign_offsets(recs, order_by, base)
        staged = f"{self.path}/_staging-{batch_id}"
        names = [f.name for f in LOG_SCHEMA.fields if f.name != "batch_id"]
        out.select(*names).write.mode("overwrite").partitionBy("topic", "partition").parquet(staged)
        schema = T.StructType([f for f in LOG_SCHEMA.fields if f.name != "batch_id"])
        now = (self.spark.read.schema(schema).parquet(staged)
               .groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset")))
        merged = now.unionByName(base).groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))
        self._commit(batch_id, merged)
        self._publish(batch_id)
        return self.read().filter(mine)

    def _commit(self, batch_id: int, positions: DataFrame) -> None:
        """Write the batch's positions: the batch is committed."""
        positions.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_positions/batch_id={batch_id}")

    def read_stream(self, max_files_per_trigger: int | None = None, topics: Sequence[str] | None = None) -> DataFrame:
        """The log as a stream (files moved into place are new records)."""
        self.last_batch()
        r = self.spark.readStream.schema(LOG_SCHEMA)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        df = r.parquet(self.path)
        return df.filter(F.col("topic").isin(list(topics))) if topics else df


def kafka_options(servers: str, topics: Sequence[str] | None = None,
                  assignment: Mapping[tuple[str, int], int | None] | None = None,
                  max_offsets_per_trigger: int | None = None, group: str | None = None) -> dict:
    """S11-S13/L5/L8 for a real Kafka cluster: options for
    ``spark.read(Stream).format("kafka")``.  Assignments with offsets map
    to ``assign`` + ``startingOffsets`` JSON (-2 is earliest)."""
    opts = {"kafka.bootstrap.servers": servers}
    if topics:
        opts["subscribe"] = ",".join(topics)
        opts["startingOffsets"] = "earliest"
    if assignment:
        parts: dict[str, list[int]] = {}
        starts: dict[str, dict[str, int]] = {}
        for (t, p), off in assignment.items():
            parts.setdefault(t, []).append(p)
            starts.setdefault(t, {})[str(p)] = -2 if off is None else off
        opts["assign"] = json.dumps(parts)
        opts["startingOffsets"] = json.dumps(starts)
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if group:
        opts["kafka.group.id"] = group
    return opts


def read_kafka(spark: SparkSession, servers: str, topics: Sequence[str] | None = None,
               assignment: Mapping[tuple[str, int], int | None] | None = None,
               stream: bool = False, **extra) -> DataFrame:
    """S11-S13 against a Kafka cluster (needs the Kafka connector on the
    class path; not available in this build's tests).  Same columns as the
    file-backed log, without ``batch_id``."""
    opts = kafka_options(servers, topics, assignment, **extra)
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**opts).load()


def write_kafka(recs: DataFrame, servers: str, checkpoint: str | None = None):
    """K9/K11 against a Kafka cluster: rows with ``topic``, ``key``,
    ``value`` (and optionally ``partition``) are produced; the broker
    assigns offsets.  A stream needs a ``checkpoint`` folder."""
    cols = [c for c in ("topic", "partition", "key", "value") if c in recs.columns]
    out = recs.select(*cols)
    if recs.isStreaming:
        return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
                   .option("checkpointLocation", checkpoint).start())
    out.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    return None
