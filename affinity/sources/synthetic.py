"""Wide synthetic feature tables over the keys of a real table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions.hashing import hex_u32, md5_hex, md5_uniform, TWO_32


def synth_wide(
    keys: DataFrame, key: str, columns: int, labels: int = 2, seed: int = 42,
    partitions: int | None = None,
) -> DataFrame:
    """One row per key: id, uniforms r_0..r_{columns-1}, and a target in [0, labels).

    One md5 serves four columns (its 8-digit groups), so values depend on the key alone.
    """
    rows = keys.select(F.col(key).cast("bigint").alias("id"))
    if partitions:
        rows = rows.repartition(partitions)
    groups = -(-columns // 4)
    digests = rows.select("id", *[md5_hex(seed, "id", g).alias(f"_d{g}") for g in range(groups)])
    uniforms = [
        (hex_u32(F.col(f"_d{j // 4}"), j % 4) / F.lit(TWO_32)).cast("float").alias(f"r_{j}")
        for j in range(columns)
    ]
    target = F.floor(md5_uniform(seed, "id", F.lit("target")) * labels).cast("int")
    return digests.select("id", *uniforms, target.alias("target"))


def table_path(root: str, rows: int, columns: int, labels: int) -> str:
    """The folder of a synthetic table; writer and reader share this one name."""
    return f"{root.rstrip('/')}/synthetic_data_{rows}_rows_{columns}_columns_{labels}_labels"
