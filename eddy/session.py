"""Session helpers: building a session for tests and local runs, reading
tables, and finding the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "eddy", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; cluster jobs get theirs
    from spark-submit and only call :func:`ensure_checkpoint_dir`."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Broadcast only on measured sizes: no broadcast from plan estimates,
        # AQE turns a join into a broadcast once a side's real size is known.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that folder must be set by the deployment (a shared file
    system or object store).  Only a local-mode session without it gets a
    fresh temporary folder, so tests can run.  (``spark.checkpoint.dir`` is
    a static setting, so the local folder is set on the context only.)
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared folder for it")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="eddy-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder, for written
    intermediate tables and streaming checkpoints."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return the
    checkpointed frame (lineage cut).  An eager reliable checkpoint writes
    the rows in one job, computing them once."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Make ``eddy`` importable in the Python workers (Arrow stages
    unpickle functions from it): zip the package once per context and add
    it with ``addPyFile``, as ``--py-files`` would on a cluster."""
    sc = spark.sparkContext
    if getattr(sc, "_eddy_shipped", False):
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="eddy-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as zf:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    sc._eddy_shipped = True
