import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.llm.sketch import Shingles, containment, distinct, edited_pairs, merge, merged, read_form, resemblance, sketched, written_form


def shingle_set(text, width=5):
    words = text.split()
    width = min(width, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def make(rng, n):
    return " ".join(rng.choice("the of and to in is it for on as by ox fox hen cat dog bee ant elk".split()) for _ in range(n))


def test_small_documents_are_exact():
    rng, shingles = random.Random(4), Shingles()
    texts = ["", "one", "one two three", *(make(rng, n) for n in (5, 6, 40, 90, 120))]
    texts += [t + " and more of it" for t in texts]
    for a in texts:
        for b in texts:
            x, y = shingles.sketch(a), shingles.sketch(b)
            assert resemblance(x, y) == pytest.approx(jaccard(shingle_set(a), shingle_set(b)))
            assert distinct(x) == len(shingle_set(a))
            if shingle_set(a):
                assert containment(x, y) == pytest.approx(len(shingle_set(a) & shingle_set(b)) / len(shingle_set(a)))


def test_large_documents_are_estimated():
    rng, shingles = random.Random(6), Shingles()
    whole = [str(rng.random()) for _ in range(20_000)]
    a, b = " ".join(whole[:15_000]), " ".join(whole[5_000:])
    x, y = shingles.sketch(a), shingles.sketch(b)
    assert len(x) == 256
    assert resemblance(x, y) == pytest.approx(0.5, abs=0.1)
    assert containment(x, y) == pytest.approx(2 / 3, abs=0.15)
    assert distinct(x) == pytest.approx(15_000, rel=0.2)
    parts = merge(shingles.sketch(" ".join(whole[:9_000])), shingles.sketch(" ".join(whole[8_996:15_000])))
    assert np.array_equal(parts, x)  # parts that overlap by a shingle less one word


def test_repeated_shingles_do_not_hide_others():
    shingles = Shingles()
    text = "a b c d e " * 5000 + " ".join(map(str, range(700)))
    direct = np.unique(shingles.hashes(text))[:256]
    assert np.array_equal(shingles.sketch(text), direct)
    assert np.array_equal(read_form(written_form(direct)), direct)


def expected_pairs(rows):
    out = []
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), jaccard(shingle_set(text), shingle_set(edited)), jaccard(shingle_set(text), shingle_set(after))))
    return out


@pytest.mark.parametrize("parts", ["1", "5", "16"])
def test_pairs_do_not_depend_on_the_deal(spark, parts):
    rng = random.Random(8)
    rows = [(i, make(rng, rng.randint(0, 120)) + "é" * (i % 3)) for i in sorted(rng.sample(range(1000), 60), reverse=True)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = edited_pairs(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    columns = ("id", "n_chars", "edited_sha256", "near_edited", "near_next")
    got = sorted((tuple(r[c] for c in columns) for r in found), reverse=True)
    assert [g[:3] for g in got] == [e[:3] for e in expected_pairs(rows)]
    assert [x for g in got for x in g[3:]] == pytest.approx([x for e in expected_pairs(rows) for x in e[3:]], abs=1e-12)


def test_merged_over_documents(spark):
    rng = random.Random(3)
    rows = [(i, make(rng, 60), "hot" if i % 3 else None) for i in range(60)] + [(99, "", "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    each = sketched(docs).join(docs.select(F.col("doc_id").alias("id"), "source"), "id")
    found = {r["source"]: r["sketch"] for r in merged(each, "source", 64).collect()}
    shingles = Shingles()
    for source in ("hot", None, "none"):
        hashes = np.unique(np.concatenate([shingles.hashes(t) for _, t, s in rows if s == source] + [np.zeros(0, np.uint64)]))[:64]
        assert [x ^ -(1 << 63) for x in found[source]] == [int(h) - (1 << 64) if int(h) >> 63 else int(h) for h in hashes]


def test_odd_rows(odd_docs, no_docs):
    rows = edited_pairs(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(r["n_chars"] for r in rows) == sorted(len(r["text"] or "") for r in odd_docs.collect())
    assert edited_pairs(no_docs).count() == 0 and sketched(no_docs).count() == 0
    lone = edited_pairs(odd_docs.filter("doc_id = 1")).collect()
    assert len(lone) == 1 and lone[0]["near_next"] == 1.0
