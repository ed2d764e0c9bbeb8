import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.llm.lm import discounts, lm_scores, pack, row_key, shard_of, unpack
from tests.llm.brute import KneserNey
from tests.llm.brute import discounts as plain_discounts

SF = "/root/testdata/sf0.001"


def tokens_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [""]


def expected(rows, order):
    train = [tokens_of(t) for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 5 != 1]
    counts = {}
    for text in train:
        for t in text:
            counts[t] = counts.get(t, 0) + 1
    n, v = sum(counts.values()), len(counts)
    model = KneserNey(train, order)
    out = []
    for i, text in rows:
        tokens = tokens_of(text)
        base = sum(math.log10((counts.get(t, 0) + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        out.append((i, i is not None and zlib.crc32(str(i).encode()) % 5 == 1, len(tokens), sum(t in counts for t in tokens), n, base, model.log10(tokens)))
    return sorted(out, key=str)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_match_plain_model(spark, order):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = sorted(map(tuple, lm_scores(docs, order=order).collect()), key=str)
    for a, b in zip(found, expected(rows, order), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_probabilities_sum_to_one():
    texts = [tokens_of(t) for t in ("a b a c", "b a", "", "a b d")]
    model = KneserNey(texts, 3)
    words = {t for text in texts for t in text}
    for context in (("<s>", "<s>"), ("a", "b"), ("x", "a"), ("x", "y")):
        assert sum(model.p((*context, w)) for w in words) + model.p((*context, "new")) == pytest.approx(1)


def test_held_out_texts_score_above_unigrams(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    row = lm_scores(docs).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert row[0] > row[1]


def test_odd_rows(spark, odd_docs, no_docs):
    found = sorted(map(tuple, lm_scores(odd_docs).collect()), key=str)
    wanted = expected([(r["doc_id"], r["text"]) for r in odd_docs.collect()], 2)
    for a, b in zip(found, wanted, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)
    assert lm_scores(no_docs).count() == 0
    none_to_train = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    out = lm_scores(spark.createDataFrame([(i, "a b") for i in none_to_train], "doc_id long, text string")).collect()
    assert len(out) == len(none_to_train) and all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in out)


def test_arrays():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2))
    assert np.array_equal(unpack(pack(keys), np.uint64), keys)
    assert (np.diff(shard_of(keys, 7)) >= 0).all() and set(shard_of(keys, 7)) == set(range(7))
    ids = rng.integers(0, 1 << 32, (2, 1000), dtype=np.uint32)
    assert len(np.unique(row_key(list(ids)))) == 1000
    assert not np.array_equal(row_key([ids[0], ids[1]]), row_key([ids[1], ids[0]]))
    counts = [1] * 50 + [2] * 20 + [3] * 9 + [4] * 5
    assert discounts(50, 20, 9, 5) == plain_discounts(counts)
