import hashlib

import corpus_pipeline
import public_tokenizers
import tokenizers

from affinity.llm import quality_rules, secret_scan
from test_decontaminate import brute_exact
from test_jaccard_join import brute

SF = "/root/testdata/sf0.01"


def test_stages_equal_their_brute_force_versions(spark):
    """Each stage on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    kept = {r["doc_id"]: r for r in docs.collect()}
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    judged = {r["doc_id"] for r in quality_rules.judge(docs, marks).where("kept").collect()}
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), f"test-{name}")
        after[name] = {r["doc_id"]: r for r in docs.collect()}
        assert len(after[name]) == docs.count()
        if name != names[-1]:
            assert docs.columns == columns
    assert set(after["quality_rules"]) == judged
    rows = [(d, kept[d]["text"]) for d in sorted(judged)]
    assert set(after["jaccard_join"]) == {c for _, _, c in brute(rows, 5, 80, 100)}
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = [(d, r["text"]) for d, r in after["jaccard_join"].items()]
    assert set(after["decontaminate"]) == set(after["jaccard_join"]) - brute_exact(left, items)
    assert set(after["secret_scan"]) == set(after["decontaminate"])
    changed = {d for d, r in after["secret_scan"].items() if r["text"] != kept[d]["text"]}
    assert changed == {d for d in after["decontaminate"] if 'token = "' in kept[d]["text"]}
    assert all(secret_scan.MARK in after["secret_scan"][d]["text"] for d in changed)
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_padding()
    library.no_truncation()
    assert set(after["bpe"]) == set(after["secret_scan"])
    for d, r in after["bpe"].items():
        ids = library.encode(after["secret_scan"][d]["text"], add_special_tokens=False).ids
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_run_over_empty_documents(spark, tmp_path):
    for name, schema in (("documents", "doc_id bigint, text string, lang string, source string, n_chars bigint"),
                         ("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
