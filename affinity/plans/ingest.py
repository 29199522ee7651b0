"""Round trips through files, tables and logs: what is written is read back as it was."""

from __future__ import annotations

from pyspark.sql import functions as F

from affinity.operators import interactions, runs
from affinity.plans import stand_ins as S
from affinity.plans.registry import query
from affinity.session import scratch_path
from affinity.sources import readers, shards, writers

PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
SUPPLIER = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"


@query("csv_typed", "select p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part")
def csv_typed(spark, sf):
    path = scratch_path(spark, "part-csv")
    S.table(spark, sf, "part").select(*[c.split()[0] for c in PART.split(", ")]).write.csv(path, header=True)
    return readers.read_csv_typed(spark, path, PART)


@query("csv_directory", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def csv_directory(spark, sf):
    path = scratch_path(spark, "supplier-csv")
    rows = S.table(spark, sf, "supplier").select(*[c.split()[0] for c in SUPPLIER.split(", ")])
    rows.repartition(4).write.csv(path, header=True)
    return readers.read_csv_dir(spark, path, SUPPLIER).drop("source_file")


@query("table_round_trip", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def table_round_trip(spark, sf):
    writers.ensure_namespace(spark, "affinity_tables", use=False)
    rows = S.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    writers.write_table(rows, "affinity_tables.customer")
    return readers.load_table(spark, "affinity_tables.customer")


@query("temp_view", "select n_nationkey, n_name, n_regionkey from nation")
def temp_view(spark, sf):
    S.table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey").createOrReplaceTempView("affinity_nation")
    return readers.load_table(spark, "affinity_nation")


@query(
    "split_directories",
    "select l_orderkey, l_linenumber, l_partkey from lineitem where l_returnflag = 'R'",
)
def split_directories(spark, sf):
    path = scratch_path(spark, "splits")
    rows = S.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    writers.export_splits(rows, path, "l_returnflag")
    return writers.read_split(spark, path, "R", "l_returnflag")


@query(
    "run_log",
    """select event_type experiment, 'rows' "key", count(*)::varchar "value" from events group by 1""",
)
def run_log(spark, sf):
    """A run is logged for each event type, twice; the later one is read back."""
    path = scratch_path(spark, "runs")
    counts = S.table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    started = counts.select("*", F.explode(F.array(F.lit(1.0), F.lit(2.0))).alias("start_time"))
    runs.append_runs(
        started.select(
            F.concat_ws("-", "event_type", "start_time").alias("run_id"), F.col("event_type").alias("experiment"), "start_time",
            F.lit("metric").alias("kind"), F.lit("rows").alias("key"),
            F.when(F.col("start_time") == 2.0, F.col("n")).otherwise(0).cast("string").alias("value"),
        ),
        path,
    )
    log = spark.read.parquet(path)
    last = runs.latest_run(log, "experiment", "run_id", "start_time").select("run_id")
    return log.join(last, "run_id").select("experiment", "key", "value")


SHARD_COLUMNS = {"o_orderkey": "bigint", "o_custkey": "int", "o_totalprice": "double", "o_orderpriority": "string"}


def _shards(spark, sf) -> str:
    path = scratch_path(spark, "shards")
    shards.write_shards(S.table(spark, sf, "orders"), path, SHARD_COLUMNS, shards=6, rows_per_file=4000, row_group_bytes=64 << 10)
    return path


@query("shard_rows", "select o_orderkey, o_custkey::integer o_custkey, o_totalprice, o_orderpriority from orders")
def shard_rows(spark, sf):
    """Orders written as shards, read back through the index as two ranges of rows."""
    path = _shards(spark, sf)
    half = shards.read_index(spark, path).agg(F.sum("rows")).first()[0] // 2
    return shards.read_rows(spark, path, 0, half).unionByName(shards.read_rows(spark, path, half)).drop("position")


@query(
    "shard_index",
    """select count(*) "rows", 0::bigint first_row, count(*)::bigint until, true intact,
      'o_custkey int,o_orderkey bigint,o_orderpriority string,o_totalprice double' types from orders""",
)
def shard_index(spark, sf):
    """The stored index adds up, the files have the stored hashes, and the rows the declared types."""
    path = _shards(spark, sf)
    found = shards.read_index(spark, path).agg(
        F.sum("rows").alias("rows"), F.min("first_row").alias("first_row"), F.max(F.col("first_row") + F.col("rows")).alias("until")
    )
    types = ",".join(sorted(f"{n} {t}" for n, t in shards.read_rows(spark, path).drop("position").dtypes))
    return found.join(shards.verify(spark, path).agg(F.bool_and("intact").alias("intact"))).withColumn("types", F.lit(types))


@query(
    "popularity_of",
    f"""with {S.POS} select product_id, count(*) "count" from pos where product_id =
      (select min(product_id) from pos) group by 1""",
)
def popularity_of(spark, sf):
    pairs = S.positives(spark, sf)
    lowest = pairs.agg(F.min("product_id")).first()[0]
    return interactions.popularity_of(pairs, lowest)
