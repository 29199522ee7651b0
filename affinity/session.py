"""Session builder and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}
_shipped: set[str] = set()  # applications whose executors have the package


def get_session(app: str = "affinity", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are tuned for; ``conf`` wins over them."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return ship_package(builder.getOrCreate())


def ship_package(spark: SparkSession) -> SparkSession:
    """Give the executors this package, so that its kernels load wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="affinity-"), "affinity.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in os.walk(package):
                for name in sorted(n for n in names if n.endswith(".py")):
                    file = os.path.join(folder, name)
                    out.write(file, os.path.relpath(file, os.path.dirname(package)))
        spark.sparkContext.addPyFile(target)
        _shipped.add(app)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a folder of one
    machine would not outlive the loss of that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="affinity-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/affinity/{app}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Used where a plan is consumed several times or must be frozen (row positions, epochs of
    an iteration). The files survive lost executors, and their sizes are known to the
    optimizer, so a join on the result is planned from true statistics.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def release_scratch(spark: SparkSession) -> None:
    """Delete what ``materialize`` wrote for this application; frames read from it are dead."""
    app = spark.sparkContext.applicationId
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/affinity/{app}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def parallelism(spark: SparkSession) -> int:
    """Task count for work that grows after a small shuffle (exploded draws, packed blocks)."""
    return max(
        spark.sparkContext.defaultParallelism,
        int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
