import random
import zlib
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from churnlab.llm import packing
from churnlab.llm.bpe import ByteBpe
from churnlab.llm.registry import op13_packing
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "  ", "a ", "a  b", "a \n b", "\n a", "a\xa0 b", "x <|endoftext|> y<|endoftext|>", "it's  don't 12 !!", "\t\t x", "ä ö  ü", "a\x85 b", "日本 語 。 です", "🙂 🙂  🙂", "\x00 \x00 a"]


@pytest.mark.parametrize("as_text", [False, True])
def test_encoder_gives_the_librarys_ids(as_text):
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = as_text
    rng = random.Random(7)
    texts = ODD + ["".join(rng.choices(" \n\tab1!'s\x85é日​ ᠎ ﻿<|", k=rng.randint(1, 40))) for _ in range(2000)]
    coder = ByteBpe(PATH, as_text)
    for part in (texts, [""], [None], texts[:1]):
        ids, n = coder.encode(pa.array(part, pa.string()))
        got = [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
        assert got == [plain.encode(t or "", add_special_tokens=False).ids for t in part]
    ids, n = coder.encode(pa.array(["café <|endoftext|>"]))
    assert b"".join(coder.bytes[i] for i in ids) == "café <|endoftext|>".encode()


def checked(rows, texts, sequence=packing.SEQUENCE):
    """Every id of every document in one piece, sequences gapless; returns places and padding.
    ``texts``: (id, text) of every row; rows with one id are told apart by their ids."""
    coder = Tokenizer.from_file(PATH)
    want = {}
    for key, text in texts:
        ids = np.array(coder.encode(text or "", add_special_tokens=False).ids + [packing.END], "<u4")
        want.setdefault((key, len(ids)), []).append(ids)
    got = {}
    for r in rows:
        got.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    assert got.keys() == want.keys()
    for key, documents in want.items():
        if len({d.tobytes() for d in documents}) == 1:
            ids, pieces = documents[0], sorted((r["start"], r["length"], r["ids_crc32"]) for r in got[key])
            assert sum(n for _, n, _ in pieces) == len(ids) * len(documents)
            for start, n, crc in pieces:
                assert n > 0 and crc == zlib.crc32(ids[start : start + n].tobytes())
            if len(documents) == 1:
                ends = np.cumsum([n for _, n, _ in pieces]).tolist()
                assert [start for start, _, _ in pieces] == [0, *ends[:-1]]
    filled = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(filled.values(), default=0) <= sequence
    return sum(filled.values()), sum(packing.full_tokens(n, sequence) - n for n in filled.values())


def test_documents_are_packed_whole_with_little_padding(spark):
    rows = op13_packing(spark, SF_SMALL).collect()
    texts = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    places, padding = checked(rows, texts)
    assert padding <= 0.002 * places


def test_odd_documents(odd_docs):
    rows = packing.packed(odd_docs, PATH).withColumnRenamed("id", "doc_id").collect()
    checked(rows, [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()])
    assert {r["doc_tokens"] for r in rows if r["doc_id"] in (4, 5)} == {1}


def test_no_documents(no_docs):
    assert packing.packed(no_docs, PATH).collect() == []


@pytest.mark.parametrize("words, sequence", [([5] * 40, 8), ([2, 5, 6] * 30, 8), ([1] * 7, 16), ([40, 3, 9, 15, 16, 17, 31, 32], 16)])
def test_lengths_that_do_not_fit(spark, words, sequence):
    texts = [(i, "a" + " a" * (n - 1)) for i, n in enumerate(words)]
    rows = packing.packed(spark.createDataFrame(texts, "doc_id long, text string"), PATH, sequence=sequence).withColumnRenamed("id", "doc_id").collect()
    places, padding = checked(rows, texts, sequence)
    # What a cut costs is never more than what padding would.
    assert padding <= packing.CUT_COST * places + 1


def test_a_length_of_many_documents_is_ranked_in_slices(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 10)
    pieces = spark.range(300).select(F.when(F.col("id") < 200, 7).otherwise(F.col("id") % 5).cast("long").alias("length"), F.col("id").alias("piece"))
    ranks = {}
    for r in packing._ranks(pieces, 300).collect():
        ranks.setdefault(r["length"], []).append(r["rank"])
    assert {n: len(r) for n, r in ranks.items()} == {7: 200, 0: 20, 1: 20, 2: 20, 3: 20, 4: 20}
    assert all(sorted(r) == list(range(len(r))) for r in ranks.values())


def brute_worth(lengths, worth, sequence):
    """Least cost less worth of any pattern, by trying all."""
    found = []
    for k in range(1, sequence // min(lengths) + 1):
        for items in combinations_with_replacement(range(len(lengths)), k):
            total = sum(lengths[i] for i in items)
            if total <= sequence:
                found.append(packing.full_tokens(total, sequence) - sum(worth[i] for i in items))
    return min(found)


def test_pricing_finds_the_best_pattern():
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = np.sort(rng.choice(np.arange(3, 16), 4, replace=False))
        worth = lengths * rng.uniform(0.9, 1.3, 4)
        found = packing.best_patterns(lengths, worth, 16)
        best = brute_worth(lengths.tolist(), worth, 16)
        if best < -1e-7:
            value = packing._cost(found[0], 16) - sum(worth[list(lengths).index(n)] * k for n, k in found[0].items())
            assert abs(value - best) < 1e-9
        else:
            assert found == []


def test_the_program_uses_no_more_pieces_than_there_are():
    rng = np.random.default_rng(5)
    lengths, counts = np.arange(1, 256), rng.poisson(40, 255) + 1
    used = np.zeros(256)
    for pattern, x in packing.solve(lengths, counts, 256):
        assert sum(n * k for n, k in pattern.items()) <= 256
        for n, k in pattern.items():
            used[n] += k * x
    assert (used[1:] <= counts + 1e-6).all()
    whole = packing.rounded(lengths, counts, 256)
    tokens = sum(times * sum(n * k for n, k in p.items()) for p, times in whole)
    assert tokens >= 0.95 * (lengths * counts).sum()
    for n in range(1, 256):
        assert sum(times * p.get(n, 0) for p, times in whole) <= counts[n - 1]


def test_last_sequence_in_powers_of_two():
    assert packing.stream_ends(0, 1024) == [] and packing.stream_ends(2048, 1024) == []
    assert packing.stream_ends(1024 + 777, 1024) == [1024 + 512, 1024 + 768, 1024 + 776]
