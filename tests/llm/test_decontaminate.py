import random

from affinity.llm import decontaminate

ITEM = "Mary bought 12 apples for 3 dollars each and gave Peter 5 apples. How many apples are left for her today"


def run(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as gram", "'x' as item_id")
    bench = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "2 as words")
    return docs, bench, decontaminate.leaks(docs, bench)


def test_exact_and_reparameterised(spark):
    other = "then Anna bought 40 apples for 7 dollars each and gave John 9 apples. How many apples are left for her today"
    mixed = "then Mary bought 12 apples for 3 dollars each and gave Peter 12 apples. How many apples are left for her today"
    noise = "word " * 40
    rows = [(1, noise + ITEM + noise), (2, f"{noise} {other} {noise}"), (3, noise), (4, None), (5, ""), (6, ITEM.lower()), (7, ITEM), (7, ITEM), (8, mixed)]
    _, _, found = run(spark, rows, [(10, ITEM), (11, None), (12, "too short an"), (13, "unrelated words of some other question here now")])
    got = {(r["doc_id"], r["item_id"]): r for r in found.collect()}
    assert {(1, 10), (2, 10), (7, 10)} <= set(got) and {d for d, _ in got} <= {1, 2, 6, 7, 8} and {i for _, i in got} == {10}
    assert got[7, 10]["n_changed"] == 0 and got[7, 10]["share"] == 1.0
    assert got[2, 10]["n_changed"] >= 3


def test_slots_must_be_consistent(spark):
    item = "give 5 apples and 5 pears to the child in the old red house by the sea"
    rows = [(1, item), (2, item.replace("5", "8")), (3, item.replace("5 pears", "6 pears"))]
    _, _, found = run(spark, rows, [(1, item)])
    assert {r["doc_id"] for r in found.collect()} == {1, 2}


def test_short_items_are_one_window(spark):
    rows = [(1, "before one red fox runs home after"), (2, "one red fox runs")]
    _, _, found = run(spark, rows, [(1, "one red fox runs home")])
    assert {r["doc_id"] for r in found.collect()} == {1}


def brute_exact(docs, items):
    """Documents in which an item stands word by word."""
    split = lambda t: "".join(c.lower() if c.isalnum() or ord(c) > 127 else " " for c in t).split()
    joined = {d: f" {' '.join(split(t))} " for d, t in docs}
    return {d for d, t in joined.items() if any(f" {' '.join(split(i))} " in t for i in items)}


def test_all_planted_passages_and_no_clean_document(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    want = brute_exact([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in items.collect()])
    got = {r["doc_id"] for r in decontaminate.leaks(docs, items).collect()}
    assert want and got == want
    cleaned = decontaminate.clean(docs, items)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count() - len(want)


def test_windows_by_join_equal_windows_by_filter(spark, monkeypatch):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abc") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(20))) for i in range(6)]
    rows = [(d, " ".join(word() for _ in range(30)) + " " + items[d % 6][1] + " tail") for d in range(20)]
    _, _, found = run(spark, rows, items)
    by_filter = sorted(map(tuple, found.collect()))
    monkeypatch.setattr(decontaminate, "MAX_FILTER", -1)
    _, _, found = run(spark, rows, items)
    assert sorted(map(tuple, found.collect())) == by_filter and len(by_filter) >= 20


def test_empty(spark):
    _, bench, found = run(spark, [], [(1, ITEM)])
    assert found.count() == 0
    docs, none, found = run(spark, [(1, ITEM)], [])
    assert found.count() == 0 and decontaminate.clean(docs, none).count() == 1


def test_verbatim_copies_whatever_the_slots_say(spark):
    """Word for word but for one of two equal numbers; behind a word without a full stop; lower-cased or
    wrapped at other lines."""
    long = (
        "A farmer keeps 12 hens in the yard behind the old barn and sells their eggs at the market each morning before the "
        "first bus arrives while a neighbour helps with the feed and the water because the well is far away from the "
        "gate and when the week is over they count the 12 hens again and write the sum down on a board"
    )
    short, names = "What is the capital of France", "tell us when Anna met Bert and Carl with Dora near Essen"
    rows = [
        (1, long.replace("the 12 hens", "the 13 hens")), (2, f"now we ask {short} and wait"), (3, f"so {names.lower()} then"),
        (4, "so " + names.replace(" Anna", "\nAnna").replace(" Carl", "\nCarl") + " then"), (5, "now we ask What is the colour of France and wait"),
    ]
    _, _, found = run(spark, rows, [(1, long), (2, short), (3, names)])
    got = {(r["doc_id"], r["item_id"]): r for r in found.collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 3)}
    assert got[2, 2]["share"] == got[3, 3]["share"] == got[4, 3]["share"] == 1.0 and got[2, 2]["first_word"] == 3


def test_rows_without_doc_id_are_cleaned_by_their_own_text(spark):
    rows = [(None, f"so {ITEM}"), (None, "nothing of it"), (None, None), (1, ITEM), (2, "nothing of it")]
    docs, bench, _ = run(spark, rows, [(1, ITEM)])
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted([rows[1], rows[2], rows[4]], key=str)


def test_number_tables_are_no_templates(spark):
    """Rows of other numbers, or of other names, aren't copies; the same numbers are."""
    item = "Add 1 2 3 4 5 6 7 8 9 10 11 12 13 14 and tell the sum"
    names = "the guests were Anna Bert Carl Dora Emil Fritz Gerd Hans Ida Jan Karl Lena Max Nora"
    rows = [
        (1, "Rain 31 24 18 9 12 0 3 7 22 40 51 38 29 30 as measured"), (2, "so 1 2 3 4 5 6 7 8 9 10 11 12 13 14 it is"),
        (3, "here came Olaf Paul Rita Sven Tina Udo Vera Willi Xaver Yana Zoe Adam Bea Cora too"),
    ]
    _, _, found = run(spark, rows, [(1, item), (2, names)])
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(2, 1)}
