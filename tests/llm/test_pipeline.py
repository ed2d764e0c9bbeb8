import corpus_pipeline
from pyspark.sql import functions as F

from churnlab.llm import mixing, quality, spm
from tests.llm.brute import components
from tests.llm.test_simhash import plain_simhash

SF = "/root/testdata/sf0.01"


def test_every_stage_takes_effect(spark):
    """Each stage's rows against a plain version on what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    after = {}
    for name, stage in stages.items():
        docs = corpus_pipeline.written(stage(spark, docs, SF), "test-pipeline")
        after[name] = docs.cache()
        if name != "sentencepiece encoding":
            assert docs.columns == columns
    first, second, third, fourth, last = after.values()

    raw = spark.read.parquet(f"{SF}/documents.parquet")
    good = quality.quality_scores(raw, labels).filter("kept")
    assert {r["doc_id"] for r in first.collect()} == {r["id"] for r in good.collect()}

    groups = {}
    for r in first.collect():
        key = "".join(c for c in r["text"] if c not in " \t\n\x0b\x0c\r")
        groups.setdefault(key, []).append((-len(r["text"]), r["doc_id"]))
    assert {r["doc_id"] for r in second.collect()} == {min(g)[1] for g in groups.values()}

    prints = sorted((r["doc_id"], plain_simhash(r["text"])) for r in second.collect())
    # Not the smallest of its component, exactly if linked to a kept smaller one, over any number of links.
    links = [(a, b) for i, (a, x) in enumerate(prints) for b, y in prints[:i] if (x ^ y).bit_count() <= 2]
    roots = components(links, [i for i, _ in prints])
    assert {r["doc_id"] for r in third.collect()} == set(roots.values())

    order = mixing.mixed(third)
    assert sorted(r["doc_id"] for r in fourth.collect()) == sorted(r["id"] for r in order.collect())
    assert {r["doc_id"] for r in fourth.collect()} == set(roots.values())

    texts = {r["doc_id"]: r["text"] for r in third.collect()}
    codec = spm.Codec(open(spm.MODEL_FILE, "rb").read())
    for r in last.orderBy(F.xxhash64("doc_id")).limit(50).collect():
        assert r["round_trip"] and codec.encode([texts[r["doc_id"]]])[0].tolist() == r["ids"]
    assert last.count() == fourth.count()


def test_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = corpus_pipeline.written(stage(spark, docs, SF), "test-odd")
            if name != "sentencepiece encoding":
                assert docs.columns == columns
        assert docs.count() >= (10 if docs is not no_docs and "n_tokens" in docs.columns and docs.count() else 0)


def test_stages_are_in_order():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["keep_quality", "drop_exact_copies", "drop_near_copies", "mix_sources", "encode"]
    assert corpus_pipeline.ORACLE_SQL is None
