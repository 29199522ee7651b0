"""Incremental jobs over growing file tables, each run to the end of its input and stopped.

A stream has a name that is kept with its checkpoint. Positives and stored indexes are tables in numbered
states that name the last batch of each stream, so a replayed batch changes nothing. The plain index log has
one ``stream=S/batch=N`` directory per micro-batch: a replayed batch overwrites its own directory, a stream
with another checkpoint never touches what is stored, and readers merge by key.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.operators import index_store
from affinity.operators.retrieval import assign_cells, prepared_vectors
from affinity.sources import bucketed


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _read(reader, path: str):
    """What is stored at ``path``, or None when nothing is; any other failure is raised."""
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream that a checkpoint belongs to, given when it is first used."""
    path = f"{checkpoint}/stream-name"
    known = _read(spark.read, path)
    if known is None:
        spark.createDataFrame([(uuid.uuid4().hex,)], "name string").coalesce(1).write.parquet(path)
        known = spark.read.parquet(path)
    return known.first()["name"]


def _write_batch(df: DataFrame, path: str, stream: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/stream={stream}/batch={batch}")


def _stored(spark: SparkSession, path: str, schema: T.StructType, other_than=None):
    """Rows of the batches written so far, or of those other than one (stream, batch)."""
    place = [T.StructField("stream", T.StringType()), T.StructField("batch", T.LongType())]
    full = T.StructType([*schema.fields, *place])
    rows = _read(spark.read.schema(full), path)
    if rows is None:
        return spark.createDataFrame([], full)
    if other_than is None:
        return rows
    return rows.where((F.col("stream") != other_than[0]) | (F.col("batch") != other_than[1]))


def _run(stream: DataFrame, each, checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


PAIRS = T.StructType(
    [T.StructField("user_id", T.LongType()), T.StructField("product_id", T.LongType())]
)


def sync_positives(pairs: DataFrame, path: str, checkpoint: str, buckets: int = bucketed.BUCKETS) -> None:
    """Append the (user, item) pairs of a stream that are not stored yet.

    The stored table is the state, so nothing is kept in the memory of the query. It is held in
    hash buckets of the users, and a trigger reads the buckets of its own users only. Its state
    names the last batch of each stream, so a batch that is replayed is left out.
    """

    name = _stream_name(pairs.sparkSession, checkpoint)

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        table = bucketed.open_table(spark, f"{path}/table")
        if table is None:
            before = _batches_of_pairs(spark, path).distinct()
            table = bucketed.create(before, f"{path}/table", PAIRS.names, by=["user_id"], buckets=buckets)
        table.append_new(batch.select(*PAIRS.names), (name, number))

    _run(pairs, each, checkpoint)


def _batches_of_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Pairs that were stored as one folder for each batch, before the table had buckets."""
    rows = _read(spark.read.schema(PAIRS).option("basePath", path), f"{path}/stream=*")
    return spark.createDataFrame([], PAIRS) if rows is None else rows.select(*PAIRS.names)


def read_positives(spark: SparkSession, path: str) -> DataFrame:
    table = bucketed.open_table(spark, f"{path}/table")
    rows = _batches_of_pairs(spark, path) if table is None else table.read()
    return rows.select(*PAIRS.names).withColumn("label", F.lit(1))


ENTRIES = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("cell", T.IntegerType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("deleted", T.BooleanType()),
        T.StructField("seq", T.LongType()),
    ]
)


def sync_index(
    changes: DataFrame, centres: np.ndarray, path: str, checkpoint: str, metric: str = "dot"
) -> None:
    """Append index entries for a stream of row changes.

    ``changes`` has item_id, embedding, change_type and ``seq``, the order of the changes of
    one id. Only changed ids are assigned to cells; vectors are prepared as ``metric`` asks.
    """
    name = _stream_name(changes.sparkSession, checkpoint)

    def each(batch: DataFrame, number: int) -> None:
        last = (
            batch.where(F.col("change_type") != "update_preimage")
            .groupBy("item_id")
            .agg(F.max(F.struct("seq", "change_type", "embedding")).alias("_c"))
            .select(F.col("item_id").alias("_id"), "_c.*")
        )
        live = last.where("change_type <> 'delete'")
        cells = assign_cells(prepared_vectors(live, "_id", "embedding", metric), centres)
        upserts = cells.join(live.select("_id", "seq"), "_id").select(
            F.col("_id").alias("item_id"), F.col("_cell").alias("cell"),
            F.col("_vec").alias("embedding"), F.lit(False).alias("deleted"), "seq",
        )
        deletes = last.where("change_type = 'delete'").select(
            F.col("_id").alias("item_id"), F.lit(None).cast("int").alias("cell"),
            F.lit(None).cast("array<double>").alias("embedding"),
            F.lit(True).alias("deleted"), "seq",
        )
        _write_batch(upserts.unionByName(deletes), path, name, number)

    _run(changes, each, checkpoint)


def sync_stored_index(changes: DataFrame, path: str, checkpoint: str) -> None:
    """Bring a stored index (``index_store``) up to date with a stream of row changes.

    ``changes`` is as for ``sync_index``. A trigger writes one segment and the ids it replaces; a
    search after it sees the whole batch.
    """
    name = _stream_name(changes.sparkSession, checkpoint)
    _run(changes, lambda batch, number: index_store.sync(batch.sparkSession, path, batch, (name, number)), checkpoint)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Current index entries: the last one of each id, unless it is a delete."""
    rows = _stored(spark, path, ENTRIES)
    entry = F.struct("seq", "batch", "stream", "cell", "embedding", "deleted")
    return (
        rows.groupBy("item_id").agg(F.max(entry).alias("_e"))
        .where(~F.col("_e.deleted"))
        .select("item_id", "_e.cell", "_e.embedding")
    )


def append_scores(scored: DataFrame, path: str, checkpoint: str) -> None:
    """Log scored requests to a Parquet folder; the sink's own log makes it exactly once."""
    query = (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
