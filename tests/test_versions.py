import numpy as np
import pytest
from pyspark.sql import functions as F

from affinity.operators import index_store, retrieval
from affinity.sources import bucketed, keyed_tables, versions
from affinity.streaming import incremental

ROWS = "k bigint, v string"


def rows(spark, items, schema=ROWS):
    return spark.createDataFrame(list(items), schema)


def content(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def folders(table):
    return {int(b): p["folders"] for b, p in table.state["parts"].items()}


@pytest.fixture
def table(spark, tmp_path):
    return bucketed.create(rows(spark, [(i, f"v{i}") for i in range(200)]), str(tmp_path / "t"), ["k"], buckets=16, leaves=8)


def test_merge_writes_touched_buckets_only(spark, table):
    new = rows(spark, [(3, "new"), (500, None)])
    later = table.merge(new, delete=rows(spark, [(9, ""), (77777, "")]).select("k"))
    want = {**{i: f"v{i}" for i in range(200) if i != 9}, 3: "new", 500: None}
    assert content(later.read()) == sorted(want.items(), key=str)
    assert content(bucketed.open_table(spark, table.path).read()) == content(later.read())
    touched = {r[0] for r in rows(spark, [(k, "") for k in (3, 9, 500, 77777)]).select(table.bucket_of()).collect()}
    assert {b for b, f in folders(later).items() if f != folders(table)[b]} == touched
    assert content(table.read()) == sorted([(i, f"v{i}") for i in range(200)], key=str)  # the old state can still be read


def test_merge_equals_upsert_with_null_keys_and_new_columns(spark, tmp_path):
    first = rows(spark, [(None, "n"), (1, "a"), (2, "b")])
    table = bucketed.create(first, str(tmp_path / "t"), ["k"], buckets=4)
    second = rows(spark, [(None, "m", 1.5), (2, "c", 2.5), (3, None, None)], ROWS + ", x double")
    later = table.merge(second)
    assert content(later.read()) == content(rows(spark, [(None, "m", 1.5), (1, "a", None), (2, "c", 2.5), (3, None, None)], ROWS + ", x double"))
    assert content(bucketed.open_table(spark, table.path, 1).read()) == content(first)
    again = later.merge(rows(spark, [(1, 9.0)], "k bigint, x double"))  # a missing column is null
    assert (1, None, 9.0) in content(again.read())


def test_a_failure_on_the_way_leaves_the_old_table(spark, table, monkeypatch):
    before = content(table.read())

    def fail(*args):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "publish", fail)
        with pytest.raises(OSError):
            table.merge(rows(spark, [(1, "x")]))
    assert content(bucketed.open_table(spark, table.path).read()) == before
    table.merge(rows(spark, [(1, "x")])).vacuum()  # what the failed write left goes with the old state
    now = bucketed.open_table(spark, table.path)
    assert (1, "x") in content(now.read()) and versions.versions(spark, table.path) == [2]
    there = set(versions._names(spark, f"{table.path}/data"))
    assert there == {f.split("/")[1] for parts in folders(now).values() for f in parts}


def test_the_later_of_two_writers_fails(spark, table):
    table.merge(rows(spark, [(1, "x")]))
    with pytest.raises(versions.StaleStateError):
        table.merge(rows(spark, [(2, "y")]))
    assert (2, "v2") in content(bucketed.open_table(spark, table.path).read())


def test_only_differing_buckets_are_read(spark, table):
    later = table.merge(rows(spark, [(3, "new"), (4, "v4")]))  # 4 is as it was
    places = later.differing(table)
    assert sum(map(len, places.values())) == 1
    read = later.differing_rows(places)
    assert {f.split("_bucket=")[1].split("/")[0] for f in read.inputFiles()} == {str(b) for b in places}
    assert content(keyed_tables.version_changes(table, later)) == [(3, "update_postimage", "new"), (3, "update_preimage", "v3")]
    assert table.differing(table) == {}
    assert content(keyed_tables.version_changes(later, later)) == []


def test_digest_changes_equal_the_plain_comparison(spark):
    old = rows(spark, [(i, None if i % 7 == 0 else f"v{i % 5}") for i in range(300)])
    new = rows(spark, [(i, None if i % 7 == 0 else f"v{i % 5 if i % 50 else 9}") for i in range(3, 320)])
    want = content(keyed_tables.snapshot_changes(old, new, ["k"]))
    for leaves in (1, 16, 4096):
        assert content(keyed_tables.digest_changes(old, new, ["k"], leaves)) == want
    assert content(keyed_tables.digest_changes(old, old, ["k"])) == []


def test_appends_add_what_is_new_and_keep_digests(spark, tmp_path):
    table = bucketed.create(rows(spark, []), str(tmp_path / "t"), ["k"], buckets=4)
    everything = set()
    for n in range(bucketed.MAX_FOLDERS + 3):
        more = [(i, "x") for i in range(n * 5, n * 5 + 12)]
        everything |= set(more)
        table = table.append_new(rows(spark, more + more[:3]), ("s", n))
    assert content(table.read()) == sorted(everything, key=str)
    assert max(len(f) for f in folders(table).values()) <= bucketed.MAX_FOLDERS
    same = table.append_new(rows(spark, [(10**6, "y")]), ("s", 2))  # a batch that was taken in before
    assert same.version == table.version
    rebuilt = bucketed.create(rows(spark, everything), str(tmp_path / "u"), ["k"], buckets=4)
    assert table.differing(rebuilt) == {}


def test_feature_table_view_follows_the_state(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS keyed_views")
    try:
        name, path = "keyed_views.f", str(tmp_path / "f")
        write = lambda items, schema=ROWS, **more: keyed_tables.write_feature_table(spark, name, rows(spark, items, schema), ["k"], "it's", path=path, **more)
        write([(1, "a"), (2, "b")])
        assert content(spark.table(name)) == [(1, "a"), (2, "b")]
        write([(2, "c"), (3, "d")])
        assert content(spark.table(name)) == [(1, "a"), (2, "c"), (3, "d")]
        write([(3, "e", 1)], ROWS + ", n int")
        assert content(spark.table(name)) == [(1, "a", None), (2, "c", None), (3, "e", 1)]
        write([(9, "z")], mode="overwrite")
        assert content(spark.table(name)) == [(9, "z")]
        write([], mode="overwrite")
        assert content(spark.table(name)) == []
    finally:
        spark.sql("DROP DATABASE keyed_views CASCADE")


def test_a_trigger_reads_the_buckets_of_its_users_only(spark, tmp_path, monkeypatch):
    feed, out, log = (str(tmp_path / n) for n in ("feed", "out", "log"))
    schema = "user_id bigint, product_id bigint"
    spark.createDataFrame([(u, p) for u in range(100) for p in range(3)], schema).write.parquet(feed)
    trigger = lambda: incremental.sync_positives(incremental.file_stream(spark, feed, incremental.PAIRS), out, log, buckets=16)
    trigger()
    asked = []
    plain = bucketed.BucketedTable.read
    monkeypatch.setattr(bucketed.BucketedTable, "read", lambda self, buckets=None: asked.append(buckets) or plain(self, buckets))
    spark.createDataFrame([(5, 1), (5, 99)], schema).write.mode("append").parquet(feed)
    trigger()
    assert [len(b) for b in asked if b is not None] == [1]
    assert incremental.read_positives(spark, out).count() == 301


def test_pairs_stored_before_there_were_buckets_are_kept(spark, tmp_path):
    old = spark.createDataFrame([(1, 1), (1, 2)], incremental.PAIRS)
    incremental._write_batch(old, str(tmp_path / "out"), "s", 0)
    assert incremental.read_positives(spark, str(tmp_path / "out")).count() == 2
    spark.createDataFrame([(1, 2), (2, 2)], incremental.PAIRS).write.parquet(str(tmp_path / "feed"))
    incremental.sync_positives(incremental.file_stream(spark, str(tmp_path / "feed"), incremental.PAIRS), str(tmp_path / "out"), str(tmp_path / "log"))
    assert content(incremental.read_positives(spark, str(tmp_path / "out"))) == [(1, 1, 1), (1, 2, 1), (2, 2, 1)]


# ---- stored index -------------------------------------------------------------------------

VECTORS = "item_id bigint, embedding array<double>"


def vectors(spark, n=400, width=6, first=0, seed=1):
    x = np.random.default_rng(seed).normal(size=(n, width))
    return spark.createDataFrame([(first + i, list(map(float, v))) for i, v in enumerate(x)], VECTORS)


def as_changes(frame, kind, seq=0):
    return frame.select("item_id", "embedding", F.lit(kind).alias("change_type"), F.lit(seq).alias("seq"))


@pytest.fixture
def stored(spark, tmp_path):
    items = vectors(spark)
    path = str(tmp_path / "ix")
    index_store.create(items, path, n_cells=8, metric="dot")
    return path, items


def search(spark, path, queries, **options):
    return content(index_store.search(spark, path, queries, 5, 8, **options).select("query_id", "item_id", "rank"))


def exact(queries, items, **options):
    return content(retrieval.topk(queries, items, 5, "dot", **options).select("query_id", "item_id", "rank"))


def test_synced_index_is_searched_exactly(spark, stored):
    path, items = stored
    asked = vectors(spark, 30, seed=2).withColumnRenamed("item_id", "query_id")
    assert search(spark, path, asked) == exact(asked, items)
    moved, more, gone = vectors(spark, 50, seed=3), vectors(spark, 40, first=1000, seed=4), items.where("item_id between 60 and 90")
    index_store.sync(spark, path, as_changes(moved, "update_postimage").union(as_changes(more, "insert")).union(as_changes(gone, "delete")))
    now = items.where("item_id >= 50 and not item_id between 60 and 90").union(moved).union(more)
    assert search(spark, path, asked) == exact(asked, now)
    index_store.sync(spark, path, as_changes(more, "delete", 1).union(as_changes(more, "insert", 0)))  # the last one counts
    index_store.sync(spark, path, as_changes(gone, "insert"))
    now = items.where("item_id >= 50").union(moved)
    assert search(spark, path, asked) == exact(asked, now)
    assert search(spark, path, asked, exclude_self=True) == exact(asked, now, exclude_self=True)
    seen = exactly = retrieval.topk(asked, now, 3, "dot").select("query_id", "item_id")
    assert search(spark, path, asked, seen=seen) == exact(asked, now, seen=exactly)
    few = now.where("item_id % 9 = 0").select("item_id")
    assert search(spark, path, asked, allowed=few) == exact(asked, now.where("item_id % 9 = 0"))

    state = versions.read_state(spark, path)
    rows = index_store.load(spark, path).cells.items
    counts = {r["_cell"]: r["n"] for r in rows.groupBy("_cell").agg(F.count("*").alias("n")).collect()}
    assert [counts.get(c, 0) for c in range(8)] == state["counts"]
    compacted = index_store.compact(spark, path)
    assert compacted["counts"] == state["counts"] and len(compacted["segments"]) == 1 and not compacted["tombstones"]
    assert all(a <= b for a, b in zip(compacted["radius"], state["radius"]))
    assert search(spark, path, asked) == exact(asked, now)
    assert search(spark, path, asked, version=1) == exact(asked, items)  # an older state
    assert index_store.vacuum(spark, path)
    assert search(spark, path, asked) == exact(asked, now)


def test_a_batch_is_taken_in_once_and_whole(spark, stored, monkeypatch):
    path, items = stored
    changes = as_changes(vectors(spark, 5, first=900, seed=9), "insert")
    first = index_store.sync(spark, path, changes, ("s", 3))
    assert index_store.sync(spark, path, changes, ("s", 3))["version"] == first["version"]
    with monkeypatch.context() as m:
        m.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            index_store.sync(spark, path, as_changes(items, "delete"), ("s", 4))
    assert index_store.load(spark, path).cells.items.count() == 405


def test_only_visited_cells_are_read(spark, stored):
    path, _ = stored
    some = index_store.load(spark, path, cells=[2, 5]).cells.items
    assert {f.split("_cell=")[1].split("/")[0] for f in some.inputFiles()} == {"2", "5"}
    asked = vectors(spark, 1, seed=2).withColumnRenamed("item_id", "query_id")
    assert index_store.search(spark, path, asked, 5, 1).count() == 5


def test_an_empty_index_and_no_queries(spark, tmp_path):
    path = str(tmp_path / "ix")
    asked = vectors(spark, 3).withColumnRenamed("item_id", "query_id")
    index_store.create(vectors(spark).limit(0), path, metric="dot", centres=np.eye(6)[:4])
    assert index_store.search(spark, path, asked, 5, 4).count() == 0
    index_store.sync(spark, path, as_changes(vectors(spark, 20), "insert"))
    assert index_store.search(spark, path, asked, 5, 4).count() == 15
    assert index_store.search(spark, path, asked.limit(0), 5, 2).count() == 0
    with pytest.raises(ValueError, match="holds an index"):
        index_store.create(vectors(spark), path)
    with pytest.raises(ValueError, match="holds no index"):
        index_store.load(spark, str(tmp_path / "none"))
