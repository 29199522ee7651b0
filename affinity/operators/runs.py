"""A run log as a table: parameters and metrics appended per run, latest run by query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_LOG = "run_id string, experiment string, start_time double, kind string, key string, value string"


def append_run(
    spark: SparkSession, path: str, run_id: str, experiment: str, start_time: float,
    params: dict | None = None, metrics: dict | None = None,
) -> None:
    """Append the parameters and metrics of one run as key/value rows."""
    rows = [
        (run_id, experiment, float(start_time), kind, k, str(v))
        for kind, found in (("param", params or {}), ("metric", metrics or {}))
        for k, v in found.items()
    ]
    spark.createDataFrame(rows, RUN_LOG).write.mode("append").parquet(path)


def append_runs(rows: DataFrame, path: str) -> None:
    """Append key/value rows of any number of runs (columns as in ``RUN_LOG``) in one write."""
    rows.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in RUN_LOG.split(", ")]).write.mode("append").parquet(path)


def latest_run(runs: DataFrame, experiment: str, run: str, started: str) -> DataFrame:
    """The last started run per experiment; equal starts go to the higher run id."""
    return runs.groupBy(experiment).agg(F.max(F.struct(started, run)).alias("_last")).select(
        experiment, F.col(f"_last.{run}").alias(run), F.col(f"_last.{started}").alias(started)
    )


def latest_artifact(
    artifacts: DataFrame, run: str, epoch: str, path: str, skip: Column | None = None
) -> DataFrame:
    """The artifact of the highest numeric epoch per run (so 10 comes after 9)."""
    kept = artifacts if skip is None else artifacts.where(~skip)
    return kept.groupBy(run).agg(F.max(F.struct(epoch, path)).alias("_last")).select(
        run, F.col(f"_last.{epoch}").alias(epoch), F.col(f"_last.{path}").alias(path)
    )
