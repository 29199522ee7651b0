"""Tables with a primary key: upsert, and the changes between two snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.session import materialize
from affinity.sources import bucketed


def upsert(current: DataFrame, new: DataFrame, primary_keys: list[str]) -> DataFrame:
    """``new`` rows, and the ``current`` rows whose key is not among them."""
    kept = current.join(new.select(*primary_keys), primary_keys, "left_anti")
    return new.unionByName(kept, allowMissingColumns=True)


def write_feature_table(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    primary_keys: list[str],
    description: str = "",
    timestamp_keys: list[str] | None = None,
    mode: str = "merge",
    path: str | None = None,
    buckets: int = bucketed.BUCKETS,
) -> DataFrame:
    """Create a keyed table, or merge into (``merge``) or replace (``overwrite``) it; the rows it then has.

    The rows lie in hash buckets of their keys at ``path`` (by default in the warehouse). A merge rewrites the
    buckets it touches into new files and puts the new state in force last; see ``bucketed``. ``name`` is
    a view of that state, so catalog readers too see the old rows until the new ones are complete.
    """
    keys = [*primary_keys, *(timestamp_keys or [])]
    if mode not in ("merge", "overwrite"):
        raise ValueError("mode must be merge or overwrite")
    path = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name.replace('`', '')}.keyed"
    table = bucketed.open_table(spark, path)
    if table is None:
        table = bucketed.create(df, path, keys, buckets=buckets)
    elif table.state["keys"] != keys:
        raise ValueError(f"{name} has the keys {table.state['keys']}")
    else:
        table = table.merge(df) if mode == "merge" else table.replace(df)
    _show_as(spark, name, table, {"primary_keys": ",".join(keys), "comment": description})
    return table.read()


def _show_as(spark: SparkSession, name: str, table: bucketed.BucketedTable, properties: dict[str, str]) -> None:
    """Point the view ``name`` at the files of a table's state, one branch for each write that is in use."""
    columns = ", ".join(f"`{c}`" for c in table.schema.names)
    used: dict[str, list[str]] = {}
    for bucket, part in table.state["parts"].items():
        for folder in part["folders"]:
            used.setdefault(folder, []).append(bucket)
    branches = [
        f"SELECT {columns} FROM parquet.`{table.path}/{folder}` WHERE _bucket IN ({', '.join(buckets)})"
        for folder, buckets in sorted(used.items())
    ]
    if not branches:
        nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in table.schema.fields)
        branches = [f"SELECT {nulls} WHERE false"]
    quote = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    listed = ", ".join(f"{quote(k)} = {quote(v)}" for k, v in properties.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({listed}) AS {' UNION ALL '.join(branches)}")


def snapshot_changes(old: DataFrame, new: DataFrame, primary_keys: list[str]) -> DataFrame:
    """Row changes from ``old`` to ``new``: insert, delete, update_preimage, update_postimage.

    Null is compared as a value, so null -> value is an update and null -> null is none.
    """
    rest = [c for c in new.columns if c not in primary_keys]
    before = old.select(*primary_keys, F.struct(*rest).alias("_old"))
    after = new.select(*primary_keys, F.struct(*rest).alias("_new"))
    both = before.join(after, primary_keys, "full_outer").where(
        ~F.col("_old").eqNullSafe(F.col("_new"))
    )

    def change(kind, side):
        return F.struct(F.lit(kind).alias("change_type"), F.col(side).alias("row"))

    changes = (
        F.when(F.col("_old").isNull(), F.array(change("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(change("delete", "_old")))
        .otherwise(
            F.array(change("update_preimage", "_old"), change("update_postimage", "_new"))
        )
    )
    return both.select(*primary_keys, F.explode(changes).alias("_c")).select(
        *primary_keys, "_c.change_type", "_c.row.*"
    )


def digest_changes(old: DataFrame, new: DataFrame, primary_keys: list[str], leaves: int = 4096) -> DataFrame:
    """The rows of ``snapshot_changes``, found with less traffic where most rows are as they were.

    Rows are dealt in ``leaves`` parts by the hash of their keys, and each part of a snapshot has a digest, a
    sum that map tasks add up. Only rows of parts with different digests are shuffled and compared.
    """
    columns = new.columns
    leaf = F.pmod(F.xxhash64(*primary_keys), F.lit(leaves)).alias("_leaf")
    before, after = (bucketed.leaf_digests(x.select(*columns), columns, [leaf]).withColumnRenamed("digest", d)
                     for x, d in ((old, "_before"), (new, "_after")))
    differ = before.join(after, "_leaf", "full_outer").where(~F.col("_before").eqNullSafe(F.col("_after")))
    differ = F.broadcast(materialize(differ.select("_leaf"), "differing-leaves"))  # a row for each leaf at most
    only = lambda x: x.select(*columns, leaf).join(differ, "_leaf", "left_semi").drop("_leaf")
    return snapshot_changes(only(old), only(new), primary_keys)


def version_changes(old: bucketed.BucketedTable, new: bucketed.BucketedTable) -> DataFrame:
    """Row changes between two states of a bucketed table, from the files of the buckets that differ only."""
    buckets = old.differing(new)
    before, after = old.differing_rows(buckets), new.differing_rows(buckets)
    for name in set(after.columns) - set(before.columns):
        before = before.withColumn(name, F.lit(None).cast(after.schema[name].dataType))
    return snapshot_changes(before, after, new.state["keys"])
