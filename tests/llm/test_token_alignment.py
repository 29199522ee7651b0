import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from affinity.llm import token_alignment as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", "Hello  world", " lead and trail ", "a\n\nb\t c", "é <|endoftext|> </s> <unk> <0x41>", "a ▁x", "▁", "ﬁ Å \xa0x", "\x00a​b",
    "日本語🙂 naïve coöperate", "aaaaaaaaaaaaaaaaaaaaaa", "the the the of the", "the the the of the", "x" * 3000, "tokenization internationalization " * 400, "\r\n",
]


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        tokens = ta.byte_level_tokens(a.read()), ta.piece_tokens(b.read())
    return first, sentencepiece.SentencePieceProcessor(model_file=B), *tokens


def brute(texts, tools):
    first, second, a_bytes, b_bytes = tools
    docs, counts = [], Counter()
    for text in texts:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        whole = b" " + (text or "").encode()
        if b"".join(a_bytes[i] for i in a) != whole or b"".join(b_bytes[i] for i in b) != whole:
            a, b = [], []
        cover = lambda ids, table: [(i, n) for n, i in enumerate(ids) for _ in table[i]]
        links = list(dict.fromkeys(zip(cover(a, a_bytes), cover(b, b_bytes))))
        links = [(x[0], y[0]) for x, y in links]
        counts.update(links)
        groups, i, j, x, y = [], 0, 0, 0, 0
        left, right = [], []
        while i < len(a) or j < len(b):
            if x <= y:
                left.append(a[i])
                x += len(a_bytes[a[i]])
                i += 1
            else:
                right.append(b[j])
                y += len(b_bytes[b[j]])
                j += 1
            if x == y:
                groups.append(",".join(map(str, left)) + "|" + ",".join(map(str, right)))
                left, right = [], []
        docs.append((len(a), len(b), groups, links))
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    return [
        (
            i, n_a, n_b, len(groups), len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for i, (n_a, n_b, groups, links) in enumerate(docs)
    ]


def align(spark, texts, **kwargs):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, n_a string, _row int")
    return sorted(map(tuple, ta.align(frame, A, B, **kwargs).collect()))


def test_vocabularies(tools):
    first, second, a, b = tools
    assert len(a) == first.get_vocab_size() - 1 and len(b) == second.vocab_size()
    assert all(a) and b[second.piece_to_id("<0x0A>")] == b"\n" and b[second.piece_to_id("▁the")] == b" the"
    same = ta.identity_map(a, b)
    assert (same >= 0).sum() > 10_000 and all(a[i] == b[j] for i, j in enumerate(same) if j >= 0)


@pytest.mark.parametrize("hot_pairs", [0, 5, 100_000])
def test_equal_brute_force(spark, sf, tools, hot_pairs, monkeypatch):
    texts = TEXTS + [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    assert align(spark, texts, hot_pairs=hot_pairs) == brute(texts, tools)


def test_slices_change_nothing(tools, monkeypatch):
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        aligner = ta.Aligner(a.read(), b.read())
    whole = aligner.figures(TEXTS).to_pylist()
    assert whole == [r for t in TEXTS for r in aligner.figures([t]).to_pylist()]


def test_pieces_are_encoded_as_the_whole_text_is(tools, monkeypatch):
    first, second, _, _ = tools
    rng = random.Random(4)
    letters = list(" " * 12 + "aaeetn.,'’\"-_1209\t\n\r\x0b\x1c\x85\xa0\u2003\u2028\u3000▁é×日ßЖ🙂\u200b\ufeffÅ")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(3000)] + [t for t in TEXTS if t]
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        aligner = ta.Aligner(a.read(), b.read())
    assert len(aligner.cut("one two, three  four")) == 3
    monkeypatch.setattr(ta, "MEMO", 100)
    aligner.encode(texts[:500])  # is forgotten
    a, a_counts, b, b_counts = aligner.encode(texts)
    want = [first.encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert a.tolist() == sum(want, []) and a_counts.tolist() == list(map(len, want))
    want = [second.encode(t) for t in texts]
    assert b.tolist() == sum(want, []) and b_counts.tolist() == list(map(len, want))


def test_empty_tables_repeats_and_null_ids(spark, tools):
    assert align(spark, []) == []
    assert align(spark, [None, ""]) == brute([None, ""], tools)
    frame = spark.createDataFrame([(None, "one two"), (7, "one two"), (7, "one two"), (7, None)], "doc_id bigint, text string")
    want = brute(["one two"] * 3 + [None], tools)
    got = sorted((tuple(r)[1:], r["doc_id"] or 0) for r in ta.align(frame, A, B).collect())
    assert got == sorted([(want[0][1:], 0), (want[1][1:], 7), (want[2][1:], 7), (want[3][1:], 7)])


def test_groups_are_made_once_for_a_piece(monkeypatch):
    """They were made for every place of it."""
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        aligner = ta.Aligner(a.read(), b.read())
    seen, made = [], ta.Groups
    monkeypatch.setattr(ta, "Groups", lambda a, *rest: seen.append(len(a)) or made(a, *rest))
    n_a = aligner.figures(["tokenization internationalization " * 400, "of tokenization"])["n_a"].to_pylist()
    assert sum(n_a) > 800 and sum(seen) < 50


def test_a_piece_that_is_not_faithful_leaves_its_text_without_tokens(spark, tools):
    texts = ["good words and ▁x here", "good words", "▁x", "a ﬁ b c", "a Å b"]
    assert align(spark, texts) == brute(texts, tools)
