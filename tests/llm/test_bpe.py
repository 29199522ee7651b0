import random

import public_tokenizers
import pytest
import tokenizers

from affinity.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    out = tokenizers.Tokenizer.from_file(PATH)
    out.no_padding()
    out.no_truncation()
    return out


@pytest.fixture(scope="module")
def mine():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Tokenizer(f.read())


def texts():
    rng = random.Random(2)
    out = ["", " \t\n", "a", "aaaaaaa aa", "b" * 300, "#" * 500, "<|endoftext|>Hi <|startoftext|>", "ΣΑΣ Σ", "İstanbul K",
           "½ ² Ⅷ 12a", "中文字 かな 한국어", "don't I'LL we've 'S", "x\x85y\xa0z\x1c ", "é Å", "\x00\x01�", "é" * 90]
    alphabet = [*range(32, 127), *range(160, 0x250), *range(0x391, 0x3CA), *range(0x410, 0x450), *range(0x4E00, 0x4E80), *range(0x1F600, 0x1F640)]
    out += ["".join(chr(rng.choice(alphabet)) for _ in range(rng.randrange(1, 50))) for _ in range(600)]
    out += ["".join(rng.choice("abceinorst ") for _ in range(rng.randrange(1, 120))) for _ in range(600)]
    return out


def test_ids_and_decoded_text_equal_the_library(mine, library):
    every = texts()
    want = [e.ids for e in library.encode_batch(every, add_special_tokens=False)]
    got = mine.encode(every)
    assert [t for t, a, b in zip(every, got, want) if a != b] == []
    assert [mine.decode(x) for x in got] == [library.decode(x, skip_special_tokens=False) for x in want]


def test_long_words_are_read_as_short_ones(mine):
    automaton = mine.automaton
    words = [w.encode() for w in ("internationalization", "a" * 40, "thethethe", "zqxj")]
    assert [automaton._read_long(w) for w in words] == automaton.read(words)


def test_frame_over_test_documents(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r["doc_id"]: r for r in bpe.encode_decode(docs, PATH).collect()}
    for r in docs.collect():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        assert list(got[r["doc_id"]]["ids"]) == ids
        assert got[r["doc_id"]]["decoded"] == library.decode(ids, skip_special_tokens=False)
    again = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert {r["doc_id"]: r["decoded"] for r in again.collect()} == {d: r["decoded"] for d, r in got.items()}


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, "Hi"), (2, "")], "doc_id bigint, text string").selectExpr("*", "0 as ids")
    got = sorted(((r["doc_id"] or 0), len(r["ids"]), r["decoded"]) for r in bpe.encode_decode(docs, PATH).collect())
    assert got == [(0, 1, "hi</w>"), (1, 0, ""), (1, 0, ""), (2, 0, "")]
    assert bpe.encode(docs.limit(0), PATH).count() == 0
