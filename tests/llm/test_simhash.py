import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from churnlab.llm.simhash import bucket_stars, hex_digits, near_edges, near_groups, near_kept, simhash
from tests.llm.brute import components


def plain_simhash(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "Two words", "a b c", "A B c d d d d", "é ß x\x0by\x85z w", "w " * 3000])
def test_fingerprint(text):
    assert simhash(text) == plain_simhash(text)


def crowd(rng, n, centre, spread):
    out = []
    for _ in range(n):
        value = centre
        for b in rng.sample(range(64), rng.randint(0, spread)):
            value ^= 1 << b
        out.append(value)
    return out


def expected_components(values, radius):
    array = np.array(sorted(set(values)), np.uint64)
    links = []
    for i, v in enumerate(array):
        near = np.flatnonzero(np.bitwise_count(array ^ v) <= radius)
        links += [(i, int(j)) for j in near if j > i]
    roots = components(links, range(len(array)))
    return {frozenset(int(array[j]) for j in roots if roots[j] == r) for r in set(roots.values())}


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_comparison(radius):
    rng = random.Random(radius)
    values = np.array(sorted({*crowd(rng, 250, rng.getrandbits(64), 4), *(rng.getrandbits(64) for _ in range(150))}), np.uint64)
    a, b = bucket_stars(np.zeros(len(values), np.int64), values, radius)
    sets = {int(v): {int(v)} for v in values}
    for x, y in zip(a, b):
        merged = sets[int(x)] | sets[int(y)]
        for v in merged:
            sets[v] = merged
    assert {frozenset(s) for s in sets.values()} == expected_components(values.tolist(), radius)


@pytest.mark.parametrize("bucket_rows", [8, 1024])
@pytest.mark.parametrize("radius", [1, 2, 3])
def test_search_finds_every_link(spark, radius, bucket_rows):
    """Also with buckets so small that the crowd takes the other way."""
    rng = random.Random(17)
    values = {*crowd(rng, 200, rng.getrandbits(64), 3), *(rng.getrandbits(64) for _ in range(300))}
    values |= {v ^ 3 << rng.randrange(63) for v in list(values)[:60]}
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    edges = near_edges(spark.createDataFrame([(v,) for v in signed], "fp long"), radius, bucket_rows).collect()
    back = {v: int(np.int64(v).view(np.uint64)) for v in signed}
    sets = {v: {v} for v in back.values()}
    for r in edges:
        merged = sets[back[r["a"]]] | sets[back[r["b"]]]
        for v in merged:
            sets[v] = merged
    assert {frozenset(s) for s in sets.values()} == expected_components(values, radius)


def test_groups_on_odd_rows(odd_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    prints = [plain_simhash(r["text"]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    roots = components(links, range(len(rows)))
    low = {root: min((rows[j]["doc_id"] for j in roots if roots[j] == root and rows[j]["doc_id"] is not None), default=None) for root in set(roots.values())}
    expected = sorted(((r["doc_id"], f"{p:016x}", low[roots[i]]) for i, (r, p) in enumerate(zip(rows, prints))), key=str)
    found = near_groups(odd_docs).select("id", hex_digits(F.col("fp")), "component").collect()
    assert sorted(map(tuple, found), key=str) == expected


def test_kept(odd_docs, no_docs):
    kept = near_kept(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 1 in ids and 2 not in ids and ids.count(None) == 2
    assert near_groups(no_docs).count() == 0 and near_kept(no_docs).count() == 0
