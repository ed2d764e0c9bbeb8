import math

import duckdb
import pytest
from pyspark.sql import functions as F

from churnlab.llm.mixing import mixed, mixed_documents, mixture, temperature_weights
from churnlab.llm.oracle import MIXING


def rows_of(frame):
    return sorted((tuple(r) for r in frame), key=str)


def test_matches_sql_with_a_hot_source(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.expr("array_join(transform(sequence(1, 1 + pmod(xxhash64(id), 40)), x -> 'w'), ' ')").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("id") % 11)).alias("source"),
    )
    docs = docs.union(spark.createDataFrame([(9000, None, "silent"), (9001, "", "silent")], "doc_id long, text string, source string"))
    documents = docs.toPandas()
    documents["source"] = documents["source"].astype(object)
    columns = ["id", "source", "tokens", "epoch", "block", "rank"]
    expected = duckdb.sql(MIXING.replace("SELECT doc_id, source, tokens, epoch", "SELECT doc_id AS id, source, tokens, epoch"))
    assert expected.columns == columns
    found = [tuple(r) for r in mixed(docs).select(*columns).collect()]
    assert rows_of(found) == rows_of(expected.fetchall())
    assert max(r[3] for r in found) == 1  # small sources are seen twice
    assert {r[0] for r in found} == {r["doc_id"] for r in docs.collect()}


@pytest.mark.parametrize("entropy,repeats", [(0.9, 100.0), (1.0, 3.0), (0.99, 1.0), (1.0, 1e9)])
def test_exponent_meets_the_limits(spark, entropy, repeats):
    tokens = {"a": 100_000, "b": 20_000, "c": 5_000, "d": 1_000}
    found = temperature_weights(spark.createDataFrame(list(tokens.items()), "source_key string, tokens long"), entropy, repeats)
    total = sum(tokens.values())

    def facts(a):
        power = {s: (n / total) ** a for s, n in tokens.items()}
        w = {s: p / sum(power.values()) for s, p in power.items()}
        per_token = {s: w[s] / tokens[s] for s in tokens}
        return w, -sum(x * math.log(x) for x in w.values()) / math.log(len(w)), max(per_token.values()) / min(per_token.values())

    weights, reached, most = facts(found.exponent)
    assert {r["source_key"]: r["weight"] for r in found.sources.collect()} == pytest.approx(weights, abs=1e-9)
    if found.exponent < 1:
        assert reached <= entropy + 1e-9 and most <= repeats * (1 + 1e-9)
    if found.exponent > 0:  # anything flatter would break a limit
        _, reached, most = facts(found.exponent - 1e-6)
        assert reached > entropy or most > repeats


def test_budget_is_spent_in_proportion(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") < 2400, "big").otherwise("small").alias("source"), F.lit(10).alias("tokens"))
    weights = temperature_weights(rows.select(F.concat(F.lit("="), "source").alias("source_key"), "tokens"), 1.0, 4.0, budget=10_000)
    order = mixture(rows, weights, block_tokens=1000).toPandas()
    spent = order.groupby("source").tokens.sum()
    assert (spent - [r["budget"] for r in weights.sources.sort("source_key").collect()]).abs().max() < 10
    assert order.block.nunique() == 10
    each = order.groupby(["block", "source"]).tokens.sum().unstack()
    assert (each.max() - each.min()).max() <= 20  # every block holds the weights
    assert not order[order.epoch == 0].duplicated(["id"]).any()
    assert sorted(order[order.block == 3]["rank"]) == list(range(1, (order.block == 3).sum() + 1))


def test_odd_rows(odd_docs, no_docs):
    out = mixed_documents(odd_docs)
    assert out.columns == odd_docs.columns
    found = sorted(str(r["doc_id"]) for r in out.collect())
    assert set(found) == {str(r["doc_id"]) for r in odd_docs.collect()} and len(found) >= odd_docs.count()
    assert found.count("10") >= 2
    assert mixed(no_docs).count() == 0 and mixed_documents(no_docs).count() == 0


def test_repeats_do_not_depend_on_the_order_of_rows(spark):
    docs = spark.range(900).select(
        F.col("id").alias("doc_id"), F.lit("two words").alias("text"), F.when(F.col("id") % 3 > 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source")
    )
    seen = [sorted(r["doc_id"] for r in mixed_documents(d).collect()) for d in (docs.coalesce(1), docs.repartition(5, "source"), docs.orderBy(F.desc("doc_id")))]
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) > 900
    assert seen[0] == sorted(r["id"] for r in mixed(docs).collect())
