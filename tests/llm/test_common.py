import random

from pyspark.sql import functions as F

from churnlab.llm.common import connected, neighbour_runs
from tests.llm.brute import components


def test_connected_matches_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    links += [(i, i + 1) for i in range(500, 560)]  # a long chain
    links += [(1000, i) for i in range(1001, 1400)]  # a hub
    links += [(7, 7), (1000, 1001)]
    expected = components(links, {n for link in links for n in link})
    alone = {n for n in expected if all(a == b or n not in (a, b) for a, b in links)}
    found = {r["node"]: r["component"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {n: c for n, c in expected.items() if n not in alone}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_neighbour_runs_show_every_neighbour(spark):
    keys = sorted(random.Random(1).sample(range(10_000), 300))
    for parts in (1, 4, 17):
        runs = neighbour_runs(spark.createDataFrame([(k,) for k in keys], "k long"), "k", parts, both_sides=True)
        rows = [tuple(r) for r in runs.sort("run", "place", "k").select("run", "place", "k").collect()]
        own = [k for _, place, k in rows if place == 0]
        assert own == keys
        seen = set()
        for a, b in zip(rows, rows[1:]):
            if a[0] == b[0]:
                seen.add((a[2], b[2]))
        assert seen == set(zip(keys, keys[1:]))


def test_neighbour_runs_wrap(spark):
    keys = list(range(50))
    runs = neighbour_runs(spark.createDataFrame([(k,) for k in keys], "k long"), "k", 5, wrap=True)
    last = runs.filter(F.col("place") == 1).sort(F.desc("run")).first()
    assert last["k"] == 0
    assert neighbour_runs(spark.createDataFrame([], "k long"), "k", 5, wrap=True).count() == 0
