import math
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlab.llm import negatives
from churnlab.llm.common import written
from churnlab.llm.oracle import ORACLE
from churnlab.llm.registry import op12_hard_negatives
from tests.conftest import SF_SMALL

KIND = "vec_id long, embedding array<double>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, every=3, positives=5, k=3, factor=256):
    sound = [(i, [math.floor(factor * x) for x in v], c) for i, v, c in rows if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, c in sound:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, d) for j, w, d in sound if j != i)
        for s, j, _ in [x for x in scored if x[2] == c][:positives]:
            fits = [(t, n) for t, n, d in scored if d != c and 50 * -s <= 100 * -t <= 95 * -s][:k]
            out += [(i, j, rank, n, -s, -t) for rank, (t, n) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, rows, every=3, **options):
    frame = spark.createDataFrame(rows, KIND).repartition(3) if rows else spark.createDataFrame([], KIND)
    for name in ("key", "window", "low", "block", "n", "V"):
        frame = frame.withColumn(name, F.lit("x"))
    found = negatives.hard_negatives(frame, F.col("id") % every == 0, **options)
    assert found.columns == COLUMNS
    return sorted(tuple(r) for r in found.collect())


def vectors(n, dims, labels, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dims))
    label = rng.integers(0, labels, n)
    made = centres[label] + rng.normal(size=(n, dims))
    return [(i, (x / np.linalg.norm(x) * scale).tolist(), int(c)) for i, (x, c) in enumerate(zip(made, label))]


def test_matches_sql(spark):
    con = duckdb.connect()
    path = f"{SF_SMALL}/embeddings.parquet"
    con.execute(f"create view embeddings as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    want = sorted(con.execute(f"select {', '.join(COLUMNS)} from ({ORACLE['op12_hard_negatives']})").fetchall())
    assert sorted(tuple(r) for r in op12_hard_negatives(spark, SF_SMALL).select(*COLUMNS).collect()) == want


@pytest.mark.parametrize("dims, labels", [(5, 2), (40, 4)])
def test_matches_brute_force_over_small_blocks(spark, monkeypatch, dims, labels):
    monkeypatch.setattr(negatives, "VECTORS", 16)
    monkeypatch.setattr(negatives, "ANCHORS", 8)
    rows = vectors(120, dims, labels, dims)
    assert mined(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = vectors(40, 6, 3, 1)
    copies = [(100 + i, rows[0][1], i % 2) for i in range(15)]
    odd = [(3, None, 1), (6, [float("nan")] * 6, 1), (9, [1.0, None], 1), (12, [math.inf], 0), (None, [0.5] * 6, 1), (60, [0.5] * 6, None), (63, [], 0), (66, [0.0] * 6, 1), (69, [0.7, 0.7], 2), (3, rows[3][1], 2), (300, [0.1] * 6, 77)]
    rows = rows + copies + odd + [rows[8]]
    assert mined(spark, rows) == plain(rows)


def test_large_components(spark):
    rows = vectors(30, 4, 2, 9, scale=2.0**18)
    assert mined(spark, rows) == plain(rows)
    rows = vectors(20, 4, 2, 9, scale=3e6)
    assert mined(spark, rows, positives=2, negatives=1) == plain(rows, positives=2, k=1)


def test_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(3, [1.0], 1)]) == []


def test_nothing_is_broadcast_or_copied_for_each_block(spark, monkeypatch):
    """Not even small tables: the windows left after a round, once for each block, are not small."""
    plans, sets = [], {}

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        if name == "negatives-sets":
            sets[len(sets)] = df.selectExpr("sum(n)").first()[0] or 0
        return written(df, name)

    monkeypatch.setattr(negatives, "written", watched)
    monkeypatch.setattr(negatives, "VECTORS", 4)
    rows = vectors(150, 8, 3, 5)
    frame = spark.createDataFrame(rows, KIND).repartition(2)
    found = negatives.hard_negatives(frame, F.col("id") % 3 == 0)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert sorted(tuple(r) for r in found.collect()) == plain(rows)
    assert not [p for p in plans if "Broadcast" in p]
    assert len(sets) >= 4 and max(sets.values()) <= 50 * 5


def test_index_never_loses_a_pair_and_leaves_dimensions_out():
    rng = np.random.default_rng(4)
    vectors_ = np.floor(rng.normal(size=(300, 40)) * np.geomspace(100, 1, 40)).astype(np.int64)
    anchors = vectors_[:20]
    index = negatives.Index(vectors_)
    scores = anchors @ vectors_.T
    for q in (0.5, 0.9, 0.99, 1.0):
        least = np.quantile(scores, q, axis=1).astype(np.int64)
        a, v = index.candidates(anchors, least, np.ones(scores.shape, bool))
        assert set(zip(*np.nonzero(scores >= least[:, None]))) <= set(zip(a.tolist(), v.tolist()))
    # The last dimensions hold too little to reach the threshold.
    assert (np.sqrt((anchors**2).sum(axis=1)).max() * index.rest[-2] < np.quantile(scores, 0.99, axis=1).min()).any()
