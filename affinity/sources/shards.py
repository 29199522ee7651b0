"""Training shards: Parquet files with declared types and a stored index over all of them.

A write has two phases. Shards are written to a folder of their own; then tasks read each file's footer and
hash its bytes in chunks, and one index table (a row for each row group, with its place in the file and the
position of its first row among all rows) is written beside them. The state that names both folders is
published last (``versions``), so a reader never sees shards without their index. Any range of rows is read
through the index: only its row groups are opened.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.operators.ranking import running_sums
from affinity.session import materialize, parallelism
from affinity.sources import versions

CHUNK = 8 << 20
ROW_GROUP_BYTES = 16 << 20
GROUPS = "file string, bytes long, sha256 string, row_group int, rows long, offset long, group_bytes long"


def _open(uri: str):
    """The file system of a path and its path there, for Arrow."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "file://", 1))


def _digest(uri: str) -> str:
    system, place = _open(uri)
    out = hashlib.sha256()
    with system.open_input_stream(place) as stream:
        while chunk := stream.read(CHUNK):
            out.update(chunk)
    return out.hexdigest()


def _described(folder: str):
    """Rows of ``GROUPS`` for the named files of a folder."""
    import pyarrow.parquet as pq

    def run(batches):
        for batch in batches:
            for name in batch.column("file").to_pylist():
                system, place = _open(f"{folder}/{name}")
                with system.open_input_file(place) as source:
                    size, meta = source.size(), pq.ParquetFile(source).metadata
                    groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
                starts = [min(g.column(c).dictionary_page_offset or g.column(c).data_page_offset for c in range(g.num_columns)) for g in groups]
                n, digest = len(groups), _digest(f"{folder}/{name}")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * n), pa.array([size] * n, pa.int64()), pa.array([digest] * n), pa.array(range(n), pa.int32()),
                        pa.array([g.num_rows for g in groups], pa.int64()), pa.array(starts, pa.int64()),
                        pa.array([g.total_byte_size for g in groups], pa.int64()),
                    ],
                    names=[c.split()[0] for c in GROUPS.split(", ")],
                )

    return run


def _file_names(spark: SparkSession, folder: str) -> DataFrame:
    names = [n for n in versions._names(spark, folder) if n.endswith(".parquet")]
    return spark.createDataFrame([(n,) for n in names], "file string").repartition(max(1, min(len(names), parallelism(spark))))


def write_shards(
    df: DataFrame, path: str, columns: dict[str, str], shards: int, rows_per_file: int = 1_000_000,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> dict:
    """Write ``columns`` (name: type, in this order) of ``df`` as ``shards`` shards of bounded files; the new state.

    A value that its declared type can't hold is an error. What an earlier write left stays readable until
    ``vacuum``.
    """
    spark = df.sparkSession
    version = (versions.versions(spark, path) or [0])[-1] + 1
    folder, index = versions.new_folder(version, "shards"), versions.new_folder(version, "index")
    typed = df.select(*[F.col(c).cast(t).alias(c) for c, t in columns.items()])
    wrong = F.count_if(F.lit(False))
    for c in columns:  # a cast that gives null for a value
        wrong = wrong + F.count_if(df[c].isNotNull() & df[c].try_cast(columns[c]).isNull())
    if lost := df.agg(wrong).first()[0]:
        raise ValueError(f"{lost} values don't fit the declared types {columns}")
    (
        typed.repartition(shards).write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file)
        .option("parquet.block.size", row_group_bytes).parquet(f"{path}/{folder}")
    )
    groups = materialize(_file_names(spark, f"{path}/{folder}").mapInArrow(_described(f"{path}/{folder}"), GROUPS), "row-groups")
    placed = running_sums(groups, ["file", "row_group"], {"rows": "first_row"})
    placed.write.parquet(f"{path}/{index}")
    state = {"shards": folder, "index": index, "columns": columns, "schema": typed.schema.jsonValue()}
    versions.publish(spark, path, state, version)
    return state | {"version": version}


def _state(spark: SparkSession, path: str, version: int | None = None) -> dict:
    state = versions.read_state(spark, path, version)
    if state is None:
        raise ValueError(f"{path} holds no shards")
    return state


def read_index(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A row for each row group: file, its bytes and sha256, row_group, rows, offset, group_bytes, first_row."""
    state = _state(spark, path, version)
    return spark.read.schema(f"{GROUPS}, first_row long").parquet(f"{path}/{state['index']}")


def read_rows(spark: SparkSession, path: str, start: int = 0, stop: int | None = None, version: int | None = None) -> DataFrame:
    """Rows ``start`` to ``stop`` (not included; by default all) with their ``position``, from their row groups only."""
    import pyarrow.parquet as pq

    state = _state(spark, path, version)
    folder, schema = f"{path}/{state['shards']}", T.StructType.fromJson(state["schema"])
    until = F.col("first_row") + F.col("rows")
    wanted = read_index(spark, path, version).where(until > start)
    if stop is not None:
        wanted = wanted.where(F.col("first_row") < stop)

    def read(batches):
        for batch in batches:
            for g in batch.to_pylist():
                system, place = _open(f"{folder}/{g['file']}")
                with system.open_input_file(place) as source:
                    table = pq.ParquetFile(source).read_row_group(g["row_group"])
                a = max(0, start - g["first_row"])
                z = g["rows"] if stop is None else min(g["rows"], stop - g["first_row"])
                place = pa.array(range(g["first_row"] + a, g["first_row"] + z), pa.int64())
                yield from table.slice(a, z - a).append_column("position", place).combine_chunks().to_batches(max_chunksize=10_000)

    out = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in schema.fields], T.StructField("position", T.LongType())])
    spread = wanted.select("file", "row_group", "rows", "first_row").repartition(parallelism(spark), "file", "row_group")
    return spread.mapInArrow(read, out)


def verify(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Each file of the index with ``intact``: whether its bytes still have the stored length and hash."""
    state = _state(spark, path, version)
    folder = f"{path}/{state['shards']}"

    def run(batches):
        for batch in batches:
            names, digests = batch.column("file").to_pylist(), batch.column("sha256").to_pylist()
            found = [_digest(f"{folder}/{n}") == d for n, d in zip(names, digests)]
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("bytes"), pa.array(found)], names=["file", "bytes", "intact"])

    files = read_index(spark, path, version).select("file", "bytes", "sha256").distinct()
    return files.repartition(parallelism(spark), "file").mapInArrow(run, "file string, bytes long, intact boolean")
