"""Typed scans of files and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns of the order, catalogue and rating files, in file order.
ORDERS = "order_id int, user_id int, eval_set string, order_number int, order_dow int, " \
         "order_hour_of_day int, days_since_prior_order float"
PRODUCTS = "product_id int, product_name string, aisle_id int, department_id int"
ORDER_PRODUCTS = "order_id int, product_id int, add_to_cart_order int, reordered int"
DEPARTMENTS = "department_id int, department string"
AISLES = "aisle_id int, aisle string"


def read_csv_typed(spark: SparkSession, path: str | list[str], schema: str | T.StructType):
    """CSV with a header row and a declared schema; a cell that does not parse is null."""
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE")


def read_csv_dir(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """All CSV files of a directory as one relation, with ``source_file`` naming the file."""
    return read_csv_typed(spark, path, schema).select(
        "*", F.col("_metadata.file_name").alias("source_file")
    )


def load_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a Parquet path when ``name`` is one."""
    if "/" in name or name.endswith(".parquet"):
        return spark.read.parquet(name)
    return spark.table(name)


def scan_projected(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Parquet columns by name; the others are never read."""
    return spark.read.parquet(path).select(*columns)
