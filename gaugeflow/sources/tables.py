"""Typed reads and writes of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gaugeflow.functions.columns import col

BOM = "\ufeff"


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first path that exists; none is an error."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for p in paths:
        hadoop_path = jvm.org.apache.hadoop.fs.Path(p)
        if hadoop_path.getFileSystem(conf).exists(hadoop_path):
            return p
    raise FileNotFoundError(f"none of these exist: {list(paths)}")


def read_table(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None, fmt: str | None = None, path_glob: str | None = None
) -> DataFrame:
    """Parquet or CSV with a stated schema.

    ``path`` may be a list of alternatives. CSV is UTF-8 with or without a byte
    order mark; its schema is never inferred (no extra pass over the data), and
    without one every column is text.
    """
    if not isinstance(path, str):
        path = first_existing(spark, path)
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    reader = spark.read
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob).option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "parquet":
        return reader.parquet(path)
    df = reader.option("header", "true").option("encoding", "UTF-8").csv(path)
    return df.toDF(*[c.removeprefix(BOM) for c in df.columns])


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", mode: str = "overwrite"
) -> None:
    """Parquet for the hand-over between jobs, CSV (UTF-8 with a byte order
    mark, header) for people.

    Partitioned output is rebalanced on the partition columns: adaptive
    execution merges small pieces into few files and cuts a hot partition value
    into several.
    """
    if partition_by:
        df = df.hint("rebalance", *[col(c) for c in partition_by])
    if fmt == "csv" and df.columns:
        # A mark in front of the first heading is the mark at the start of each file.
        first = next(c for c in df.columns if c not in partition_by)
        df = df.withColumnRenamed(first, BOM + first)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", "true").option("encoding", "UTF-8").csv(path)
    else:
        writer.parquet(path)
