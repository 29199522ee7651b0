"""Keyed tables in hash buckets: a merge rewrites the buckets it touches, a comparison reads those that differ.

A row lies in the bucket of the hash of its key (or of some key columns, ``by``). A state names for each bucket
its folders, its rows and a two-level digest: the sum of row hashes of each leaf, a leaf being a part of the
bucket's hash range. Buckets and leaves are parameters fixed when the table is made, so states stay small
whatever the table holds. See ``versions`` for how states follow one another.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.session import materialize
from affinity.sources import versions

BUCKETS = 64
LEAVES = 16  # per bucket
MAX_FOLDERS = 8  # of a bucket, before an append rewrites it


def _bucket(by: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*by), F.lit(n)).cast("int")


def _leaf(by: list[str], leaves: int) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(*by), 32), F.lit(leaves)).cast("int")


def row_hash(columns: list[str]) -> Column:
    """A hash of a whole row; which columns are null counts too."""
    return F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])


def leaf_digests(rows: DataFrame, columns: list[str], place: list[Column]) -> DataFrame:
    """Rows and the sum of row hashes for each ``place`` (bucket, leaf): a row for each leaf at most."""
    digest = F.sum(row_hash(columns).cast("decimal(38,0)")).cast("string")
    return rows.groupBy(*place).agg(F.count("*").alias("rows"), digest.alias("digest"))


def _duplicates(rows: DataFrame, keys: list[str], name: str) -> None:
    if not rows.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"duplicate keys {keys} in the rows for {name}")


@dataclass
class BucketedTable:
    """A state of a table. Writing gives the next state and leaves this one as it is."""

    spark: SparkSession
    path: str
    state: dict

    # ---- reading ----

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self.state["schema"])

    @property
    def version(self) -> int:
        return self.state["version"]

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows, of some buckets only if asked."""
        parts = self.state["parts"]
        wanted = sorted(parts, key=int) if buckets is None else [str(b) for b in buckets if str(b) in parts]
        folders = [f"{self.path}/{folder}/_bucket={b}" for b in wanted for folder in parts[b]["folders"]]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def bucket_of(self) -> Column:
        return _bucket(self.state["by"], self.state["buckets"])

    def leaf_of(self) -> Column:
        return _leaf(self.state["by"], self.state["leaves"])

    # ---- writing ----

    def _write(self, rows: DataFrame) -> tuple[str, dict[str, dict]]:
        """Write rows that have ``_bucket`` to a folder of their own; its name, and each bucket's part."""
        folder = versions.new_folder(self.version + 1, "data")
        target = f"{self.path}/{folder}"
        rows.repartition("_bucket").write.partitionBy("_bucket").parquet(target)
        schema = T.StructType([f for f in rows.schema.fields if f.name != "_bucket"])
        found: dict[str, dict] = {}
        if not rows.sparkSession.read.schema(rows.schema).parquet(target).isEmpty():
            stored = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(target)
            leaves = leaf_digests(stored, schema.names, [F.col("_bucket"), self.leaf_of().alias("leaf")])
            for r in leaves.collect():  # buckets x leaves at most
                part = found.setdefault(str(r["_bucket"]), {"folders": [folder], "rows": 0, "leaves": {}})
                part["rows"] += r["rows"]
                part["leaves"][str(r["leaf"])] = r["digest"]
        return folder, found

    def _next(self, parts: dict[str, dict], schema: T.StructType, batch: tuple[str, int] | None) -> BucketedTable:
        batches = self.state["batches"] | ({batch[0]: batch[1]} if batch else {})
        state = self.state | {
            "parts": {b: p for b, p in parts.items() if p["rows"]}, "schema": schema.jsonValue(), "batches": batches,
            "version": self.version + 1,
        }
        versions.publish(self.spark, self.path, state, state["version"])
        return BucketedTable(self.spark, self.path, state)

    def _done(self, batch: tuple[str, int] | None) -> bool:
        return batch is not None and self.state["batches"].get(batch[0], -1) >= batch[1]

    def _as_stored(self, rows: DataFrame) -> tuple[DataFrame, T.StructType]:
        """``rows`` frozen with their bucket, in the table's column order and types; new columns come last."""
        known = {f.name: f for f in self.schema.fields}
        fields = [*self.schema.fields, *[f for f in rows.schema.fields if f.name not in known]]
        given = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
        ]
        nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
        return materialize(rows.select(*given).withColumn("_bucket", self.bucket_of()), "merge"), nullable

    def merge(
        self, new: DataFrame, delete: DataFrame | None = None, batch: tuple[str, int] | None = None
    ) -> BucketedTable:
        """``new`` rows replace those with their keys or are added; rows with keys of ``delete`` go (unless in ``new``).

        Only touched buckets are read, joined and written. ``batch`` (stream, number) makes a repeated
        call for the same or an earlier batch of that stream do nothing.
        """
        if self._done(batch):
            return self
        keys = self.state["keys"]
        _duplicates(new, keys, self.path)
        fresh, schema = self._as_stored(new)
        gone = fresh.select(*keys, "_bucket")
        if delete is not None:
            dropped = delete.select(*[F.col(k).cast(schema[k].dataType).alias(k) for k in keys]).distinct()
            gone = materialize(gone.union(dropped.withColumn("_bucket", self.bucket_of())).distinct(), "merge-keys")
        touched = sorted(r[0] for r in gone.select("_bucket").distinct().collect())  # buckets at most
        if not touched:
            return self
        if len(schema) > len(self.schema):  # files of one state have the same columns
            touched = list(range(self.state["buckets"]))
        before = BucketedTable(self.spark, self.path, self.state | {"schema": schema.jsonValue()}).read(touched)
        before = before.withColumn("_bucket", self.bucket_of())
        same = F.lit(True)
        for k in ("_bucket", *keys):
            same = same & before[k].eqNullSafe(gone[k])
        kept = before.join(gone, same, "left_anti")
        _, parts = self._write(fresh.unionByName(kept))
        untouched = {b: p for b, p in self.state["parts"].items() if int(b) not in set(touched)}
        return self._next(untouched | parts, schema, batch)

    def replace(self, rows: DataFrame) -> BucketedTable:
        """A state with ``rows`` only, which may have other columns."""
        _duplicates(rows, self.state["keys"], self.path)
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
        _, parts = self._write(rows.withColumn("_bucket", self.bucket_of()))
        return self._next(parts, schema, None)

    def append_new(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> BucketedTable:
        """Add the rows whose keys aren't stored yet; repeated keys in ``rows`` count once.

        Touched buckets are read and get one more folder; a bucket with many of them is rewritten.
        """
        if self._done(batch):
            return self
        keys = self.state["keys"]
        fresh, schema = self._as_stored(rows.dropDuplicates(keys))
        touched = sorted(r[0] for r in fresh.select("_bucket").distinct().collect())
        known = self.read(touched).withColumn("_bucket", self.bucket_of())
        same = F.lit(True)
        for k in ("_bucket", *keys):
            same = same & fresh[k].eqNullSafe(known[k])
        fresh = fresh.join(known.select("_bucket", *keys), same, "left_anti")
        full = [b for b in touched if len(self.state["parts"].get(str(b), {"folders": []})["folders"]) >= MAX_FOLDERS]
        if full:
            fresh = fresh.unionByName(self.read(full).withColumn("_bucket", self.bucket_of()), allowMissingColumns=True)
        _, parts = self._write(fresh)
        merged = dict(self.state["parts"])
        for b, part in parts.items():
            old = merged.get(b)
            if old and int(b) not in full:
                leaves = dict(old["leaves"])
                for leaf, digest in part["leaves"].items():
                    leaves[leaf] = str(int(leaves.get(leaf, "0")) + int(digest))
                part = {"folders": old["folders"] + part["folders"], "rows": old["rows"] + part["rows"], "leaves": leaves}
            merged[b] = part
        return self._next(merged, schema, batch)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove what only states before the last ``keep`` use."""
        return versions.vacuum(self.spark, self.path, lambda s: {f for p in s["parts"].values() for f in p["folders"]}, keep)

    # ---- comparing ----

    def differing(self, other: BucketedTable) -> dict[int, list[int]]:
        """The buckets in which two states of one layout differ, and which of their leaves do; no file is read."""
        layout = ("keys", "by", "buckets", "leaves")
        if any(self.state[c] != other.state[c] for c in layout):
            raise ValueError("tables in different buckets can't be compared by bucket")
        out, none = {}, {"folders": [], "leaves": {}}
        for b in sorted({*self.state["parts"], *other.state["parts"]}, key=int):
            mine, theirs = self.state["parts"].get(b, none), other.state["parts"].get(b, none)
            if mine["folders"] != theirs["folders"]:
                every = {*mine["leaves"], *theirs["leaves"]}
                if leaves := sorted(int(x) for x in every if mine["leaves"].get(x) != theirs["leaves"].get(x)):
                    out[int(b)] = leaves
        return out

    def differing_rows(self, buckets: dict[int, list[int]]) -> DataFrame:
        """Rows of the given leaves of the given buckets."""
        places = [b * self.state["leaves"] + leaf for b, leaves in buckets.items() for leaf in leaves]
        place = self.bucket_of() * self.state["leaves"] + self.leaf_of()
        return self.read(list(buckets)).where(place.isin(places))


def create(
    rows: DataFrame, path: str, keys: list[str], by: list[str] | None = None, buckets: int = BUCKETS, leaves: int = LEAVES
) -> BucketedTable:
    """A new table at ``path`` with ``rows``; nothing may have been published there."""
    spark = rows.sparkSession
    if versions.versions(spark, path):
        raise ValueError(f"{path} holds a table")
    fields = [T.StructField(f.name, f.dataType, True) for f in rows.schema.fields]
    state = {
        "keys": keys, "by": by or keys, "buckets": buckets, "leaves": leaves, "schema": T.StructType(fields).jsonValue(),
        "parts": {}, "batches": {}, "version": 0,
    }
    empty = BucketedTable(spark, path, state)
    _duplicates(rows, keys, path)
    _, parts = empty._write(rows.withColumn("_bucket", empty.bucket_of()))
    return empty._next(parts, empty.schema, None)


def open_table(spark: SparkSession, path: str, version: int | None = None) -> BucketedTable | None:
    """The table's last state or an earlier one; None where there is none."""
    state = versions.read_state(spark, path, version)
    return state and BucketedTable(spark, path, state)
