"""Tables, split directories and shard exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_namespace(spark: SparkSession, name: str, use: bool = True) -> None:
    """Create a database when absent and make it the default of the session."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    if use:
        spark.sql(f"USE `{name}`")


def write_table(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Replace a table and its schema, and return it."""
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)
    return df.sparkSession.table(name)


def export_splits(df: DataFrame, path: str, column: str = "group") -> None:
    """One directory per split under ``path``; a reader of one split prunes the others.

    A split stays spread over the tasks that hold its rows: nothing is gathered per split.
    """
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def read_split(spark: SparkSession, path: str, split: str, column: str = "group") -> DataFrame:
    return spark.read.parquet(path).where(F.col(column) == split).drop(column)


def export_shards(
    df: DataFrame, path: str, shards: int, max_rows: int = 1_000_000, checksum: bool = True
) -> DataFrame:
    """Write zstd Parquet shards and return their manifest: file, rows, bytes, sha1.

    ``max_rows`` bounds a shard file, and with it what one task holds when it is hashed.
    """
    spark = df.sparkSession
    (
        df.repartition(shards)
        .write.mode("overwrite")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", max_rows)
        .parquet(path)
    )
    rows = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.count("*").alias("rows"))
    )
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    described = files.select(
        name, F.col("length").alias("bytes"), *([F.sha1("content").alias("sha1")] if checksum else [])
    )
    return rows.join(described, "file")
