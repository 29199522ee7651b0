"""A stored vector index: kept, brought up to date, compacted, and searched.

A state (``sources.versions``) names immutable segments, files of rows by cell; the ids that later segments
replace or drop (tombstones, with the cell they were in); and for each cell its radius and number of live
rows. The centres are fixed when the index is made. A sync writes one segment with the changed vectors and the
tombstones of the ids it touched; a row is live if no tombstone of a later state names its id. ``compact``
writes the live rows as one segment again.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.operators import retrieval
from affinity.operators.retrieval import BROADCAST_BYTES, ITEMS_PER_BLOCK, Cells, InvertedFile
from affinity.session import materialize
from affinity.sources import versions

ROW = "_id long, _vec array<double>, _away double, _cell int"
TOMBSTONE_BYTES = 32  # of one id in a broadcast


def _folders(state: dict) -> set[str]:
    return {state["centres"], *(x["folder"] for x in state["segments"] + state["tombstones"])}


def _state(spark: SparkSession, path: str, version: int | None = None) -> dict:
    state = versions.read_state(spark, path, version)
    if state is None:
        raise ValueError(f"{path} holds no index")
    return state


def _centres(spark: SparkSession, path: str, state: dict) -> np.ndarray:
    rows = spark.read.parquet(f"{path}/{state['centres']}").orderBy("cell").select("centre").toArrow()  # a row for each cell
    return retrieval._matrix(rows["centre"])


def _write_segment(assigned: DataFrame, path: str, version: int) -> tuple[dict, dict[int, tuple[int, float]]]:
    """Write assigned rows by cell; the segment, and the rows and greatest distance of each cell."""
    spark, folder = assigned.sparkSession, versions.new_folder(version, "segments")
    # a cell is cut by id, so a popular one is written by several tasks
    cut = F.pmod(F.xxhash64("_id"), F.lit(8))
    assigned.repartition("_cell", cut).write.partitionBy("_cell").parquet(f"{path}/{folder}")
    stored = spark.read.schema(ROW).parquet(f"{path}/{folder}")
    figures = stored.groupBy("_cell").agg(F.count("*").alias("n"), F.max("_away").alias("r")).collect()  # a row for each cell
    found = {r["_cell"]: (r["n"], r["r"] + 1e-4) for r in figures}
    return {"folder": folder, "version": version, "cells": sorted(found)}, found


def _live(spark: SparkSession, path: str, state: dict, cells: list[int] | None = None, columns=("_id", "_cell", "_vec", "_away")) -> DataFrame:
    """Live rows, of some cells only if asked: the others' files aren't read."""
    parts = []
    for segment in state["segments"]:
        there = [c for c in segment["cells"] if cells is None or c in cells]
        if there:
            rows = spark.read.schema(ROW).option("basePath", f"{path}/{segment['folder']}")
            rows = rows.parquet(*[f"{path}/{segment['folder']}/_cell={c}" for c in there])
            parts.append(rows.select(*columns, F.lit(segment["version"]).alias("_version")))
    if not parts:
        return spark.createDataFrame([], ROW).select(*columns)
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    dead = None
    for t in state["tombstones"]:
        some = spark.read.parquet(f"{path}/{t['folder']}").where("_cell is not null")
        some = (some if cells is None else some.where(F.col("_cell").isin(cells))).select("_id", F.lit(t["version"]).alias("_since"))
        dead = some if dead is None else dead.unionByName(some)
    if dead is None:
        return rows.drop("_version")
    dead = dead.groupBy(F.col("_id").alias("_dead")).agg(F.max("_since").alias("_since"))
    if sum(t["rows"] for t in state["tombstones"]) * TOMBSTONE_BYTES <= BROADCAST_BYTES:
        dead = F.broadcast(dead)
    gone = (F.col("_id") == F.col("_dead")) & (F.col("_since") > F.col("_version"))
    return rows.join(dead, gone, "left_anti").drop("_version")


def create(
    items: DataFrame, path: str, n_cells: int = 256, metric: str = "cosine", item_id: str = "item_id",
    vector: str = "embedding", seed: int = 7, centres: np.ndarray | None = None,
) -> dict:
    """Store an index of the item vectors at ``path``, where none may be; its state.

    The centres are those given, or a keyed sample of the vectors. Null vectors (and zero vectors under
    cosine) have no score and aren't stored; ids must be distinct.
    """
    spark = items.sparkSession
    if versions.versions(spark, path):
        raise ValueError(f"{path} holds an index")
    rows = materialize(retrieval.prepared_vectors(items, item_id, vector, metric), "items")
    if centres is None:
        centres = retrieval.sampled_pivots(rows, n_cells, seed)
    folder = versions.new_folder(1, "centres")
    listed = [(c, list(map(float, centre))) for c, centre in enumerate(centres)]
    spark.createDataFrame(listed, "cell int, centre array<double>").coalesce(1).write.parquet(f"{path}/{folder}")
    segment, found = _write_segment(retrieval.assign_cells(rows, centres), path, 1)
    state = {
        "metric": metric, "centres": folder, "segments": [segment], "tombstones": [], "batches": {}, "version": 1,
        "counts": [found.get(c, (0, 0.0))[0] for c in range(len(centres))],
        "radius": [found.get(c, (0, 0.0))[1] for c in range(len(centres))],
    }
    versions.publish(spark, path, state, 1)
    return state


def sync(spark: SparkSession, path: str, changes: DataFrame, batch: tuple[str, int] | None = None) -> dict:
    """Bring the index up to date with row changes; its new state.

    ``changes`` has item_id, embedding, change_type (insert, update_postimage, delete; update_preimage is
    ignored) and, where an id may occur more than once, ``seq``, their order. Only changed vectors are
    assigned and written. ``batch`` (stream, number) makes a batch that has been taken in before do nothing.
    """
    state = _state(spark, path)
    if batch is not None and state["batches"].get(batch[0], -1) >= batch[1]:
        return state
    version, metric = state["version"] + 1, state["metric"]
    rows = changes.where("change_type <> 'update_preimage'")
    if "seq" in rows.columns:
        last = F.max(F.struct("seq", "change_type", "embedding")).alias("c")
        rows = rows.groupBy("item_id").agg(last).select("item_id", "c.change_type", "c.embedding")
    rows = materialize(rows.select(F.col("item_id").cast("bigint").alias("item_id"), "change_type", "embedding"), "changes")

    # the changed ids that are live now, with the cells that they leave
    ids = rows.select(F.col("item_id").alias("_changed")).distinct()
    left = _live(spark, path, state, columns=("_id", "_cell")).join(ids, F.col("_id") == F.col("_changed"), "left_semi")
    folder = versions.new_folder(version, "tombstones")
    left.write.parquet(f"{path}/{folder}")
    stored = spark.read.schema("_id long, _cell int").parquet(f"{path}/{folder}")
    leaving = {r["_cell"]: r["n"] for r in stored.groupBy("_cell").agg(F.count("*").alias("n")).collect()}

    fresh = retrieval.prepared_vectors(rows.where("change_type <> 'delete'"), "item_id", "embedding", metric)
    segment, found = _write_segment(retrieval.assign_cells(fresh, _centres(spark, path, state)), path, version)
    cells = range(len(state["counts"]))
    state = state | {
        "version": version,
        "segments": state["segments"] + ([segment] if found else []),
        "tombstones": state["tombstones"] + ([{"folder": folder, "version": version, "rows": sum(leaving.values())}] if leaving else []),
        "counts": [n - leaving.get(c, 0) + found.get(c, (0,))[0] for c, n in zip(cells, state["counts"])],
        "radius": [max(r, found[c][1]) if c in found else r for c, r in zip(cells, state["radius"])],
        "batches": state["batches"] | ({batch[0]: batch[1]} if batch else {}),
    }
    versions.publish(spark, path, state, version)
    return state


def compact(spark: SparkSession, path: str) -> dict:
    """Write the live rows as one segment without tombstones, with their true radii; the new state."""
    state = _state(spark, path)
    version = state["version"] + 1
    segment, found = _write_segment(_live(spark, path, state).select("_id", "_vec", "_cell", "_away"), path, version)
    cells = range(len(state["counts"]))
    state = state | {
        "version": version, "segments": [segment] if found else [], "tombstones": [],
        "counts": [found.get(c, (0, 0.0))[0] for c in cells], "radius": [found.get(c, (0, 0.0))[1] for c in cells],
    }
    versions.publish(spark, path, state, version)
    return state


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove what only states before the last ``keep`` use."""
    return versions.vacuum(spark, path, _folders, keep)


def load(spark: SparkSession, path: str, version: int | None = None, cells: list[int] | None = None) -> InvertedFile:
    """The index as ``retrieval.search_index`` takes it; with ``cells`` only those cells' rows."""
    state = _state(spark, path, version)
    counts = np.array(state["counts"])
    blocks = [max(1, -(-int(n) // ITEMS_PER_BLOCK)) for n in counts]
    n_blocks = F.array(*[F.lit(b) for b in blocks])[F.col("_cell")]
    items = _live(spark, path, state, cells, ("_id", "_cell", "_vec")).withColumn("_block", F.pmod(F.xxhash64("_id"), n_blocks).cast("int"))
    return InvertedFile(Cells(items, _centres(spark, path, state), np.array(state["radius"]), counts, blocks), state["metric"])


def search(
    spark: SparkSession, path: str, queries: DataFrame, k: int, nprobe: int, version: int | None = None,
    query_id: str = "query_id", vector: str = "embedding", **options,
) -> DataFrame:
    """``retrieval.search_index`` on the stored index; files of cells that no query visits aren't read."""
    index = load(spark, path, version, [])
    n_cells = len(index.cells.counts)
    visited = None
    if nprobe < n_cells:
        asked = retrieval.prepared_vectors(queries, query_id, vector, index.metric)
        visited = retrieval.visited_cells(asked, index.cells, retrieval.nearest_cells(nprobe, index.metric))
    index = load(spark, path, version, visited)
    return retrieval.search_index(index, queries, k, nprobe, query_id, vector, **options)
