"""Session set-up and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gaugeflow")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a
    machine-local folder would be lost with its machine, so that is an error.
    """
    sc = spark.sparkContext
    active = sc._jsc.sc().getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None) or (active.get() if active.isDefined() else None)
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="gaugeflow-")
    if not active.isDefined():
        sc.setCheckpointDir(configured)
    return qualified(spark, configured)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, so that Spark and the clients inside tasks mean the same place."""
    sc = spark.sparkContext
    named = sc._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(named).toString().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several jobs read to the shared folder, as Parquet.

    Unlike a cache it survives the loss of executors, and unlike a checkpoint
    its readers load only the columns they use.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
