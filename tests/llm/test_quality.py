import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from churnlab.llm import quality
from churnlab.llm.arrays import sorted_arrays
from churnlab.llm.common import written
from churnlab.llm.quality import AGAIN, END, START, UNKNOWN, Spelling, StoredSpelling, Tokens, fit, hashed, perplexity, quality_kept, quality_scores, sample, shape, text_hashes, uncovered
from tests.llm.brute import KneserNey

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_shapes():
    assert [shape(w) for w in ("Haus,", "THE!!", "a1b2", "|", "")] == ["Aa,", "A!", "a0a0", "|", ""]
    assert shape("aAaAaAaAaA\n\n") == "aAaAaAaA" and shape("\n\n²x") == "\n0a"
    words = ["Haus,", "haus", "THE!!", "a1b2", "|", "||", "ÖÖ²\xa0\xa0x", "\U00010348\U00010348", "aAaAaAaAaA"]
    assert quality.shapes_of(words) == [shape(w) for w in words]


def test_hashes_are_those_of_spark(spark):
    rows = spark.createDataFrame([(i * 7 - 3, "wörd" * i) for i in range(40)], "n long, text string")
    found = rows.select("n", "text", F.xxhash64("n").alias("one"), F.xxhash64("text").alias("own"), F.xxhash64(F.lit(5).cast("long"), "n", F.xxhash64("text")).alias("three")).collect()
    numbers, texts = np.array([r["n"] for r in found]), text_hashes([r["text"].encode() for r in found])
    assert hashed(numbers).tolist() == [r["one"] for r in found]
    assert texts.tolist() == [r["own"] for r in found]
    assert hashed(5, numbers, texts).tolist() == [r["three"] for r in found]


def test_tokens_of_both_models(spark):
    words = ["the"] * 1100 + ["dog", "cow", "xX"] * 3 + ["fog", "hog", "nag"] * 2 + ["B7"]
    rows = spark.createDataFrame([(1, " ".join(words), "en")], "id long, text string, lang string")
    tokens = Tokens(fit(rows).known, "en", Spelling(*Spelling.grams(["fog", "hog"])))
    the, dog, low, cased = text_hashes([b"the", b"dog", b"a", b"aA"]).tolist()
    ids, lengths, spelt = tokens.read(["the dog hog the the B7", "", "the the dog dog xX "])
    assert lengths.tolist() == [9, 3, 8] and spelt[0] < spelt[1] == spelt[2] == 0
    assert ids[0].tolist() == [START, START, the, dog, low, the, AGAIN, UNKNOWN, END, START, START, END, START, START, the, AGAIN, dog, AGAIN, text_hashes([b"xX"])[0], END]
    assert ids[1].tolist()[:9] == [START, START, the, low, low, the, AGAIN, UNKNOWN, END]
    assert ids[1][-2] == cased
    more = [f"hog{chr(97 + i % 26)}{i}" for i in range(3000)]
    one = [tokens.read([w])[2][0] for w in more]
    assert tokens.read([" ".join(more)])[2][0] == pytest.approx(sum(one))
    assert tokens.read(["the dog"])[0][0].tolist() == [START, START, the, dog, END]


def test_spelling_matches_plain_witten_bell():
    rng = random.Random(5)
    fitted = ["".join(rng.choice("abcdef") for _ in range(rng.randint(1, 6))) for _ in range(200)] + ["Öl", "x2", "😀"]
    padded = ["\0\0" + "".join("0" if c.isdigit() else c for c in w.lower()) + "\0" for w in fitted]
    grams = [p[i : i + 3] for p in padded for i in range(len(p) - 2)]

    def p(gram):
        if not gram:
            return 1 / 0x110000
        tails = [g[3 - len(gram) :] for g in grams]
        after = [t for t in tails if t[:-1] == gram[:-1]]
        kinds = len(set(after))
        return (after.count(gram) + kinds * p(gram[1:])) / (len(after) + kinds) if after else p(gram[1:])

    asked = ["abc", "A", "zz\x1cq", "ÖL", "x7", "\U00010348", "fedcba" * 3]
    found = Spelling(*(lambda keys, of: (keys, np.ones(len(keys), np.int64)))(*Spelling.grams(fitted))).log_p(asked)
    for word, log in zip(asked, found):
        w = "\0\0" + "".join("0" if c.isdigit() else c for c in word.lower()) + "\0"
        assert log == pytest.approx(sum(math.log(p(w[i : i + 3])) for i in range(len(w) - 2)))
    assert Spelling(np.zeros(0, np.int64), np.zeros(0, np.int64)).log_p(["ab"])[0] == pytest.approx(-3 * math.log(0x110000))


def test_words_are_cut_alike_when_fitted_and_scored(spark):
    """Other white space than the contracts' belongs to the words."""
    rows = spark.createDataFrame([(i, "bonjour\xa0! salut\u2003\x1cami bonjour\xa0!", "fr") for i in range(5)], "id long, text string, lang string")
    ids = Tokens(fit(rows).known, "fr").read([rows.first()["text"]])[0][0]
    assert ids[2:-1].tolist() == text_hashes([w.encode() for w in ("bonjour\xa0!", "salut\u2003\x1cami", "bonjour\xa0!")]).tolist()


def test_sorted_arrays_find_what_is_stored(spark):
    table = spark.range(0, 5000, 5).selectExpr("id * id - 900 AS k", "id / 2 AS v")
    arrays = sorted_arrays(table, rows=70)
    assert len(arrays.names) > 5
    stored = {r["k"]: r["v"] for r in table.collect()}
    keys = np.unique(np.array([*list(stored)[::3], *range(-1000, 3000, 7), 10**12, -(10**12)]))
    values, has = arrays.find(keys)
    assert [v if h else None for v, h in zip(values.tolist(), has.tolist())] == [stored.get(k) for k in keys.tolist()]
    nothing = sorted_arrays(table.filter("v < 0"))
    assert not nothing.find(keys)[1].any()


def test_perplexity_matches_plain_model(spark, tables):
    docs, labels = tables
    rows = docs.join(labels.filter("quality = 1"), "doc_id").filter("lang in ('de', 'es')").select(F.col("doc_id").alias("id"), "text", "lang")
    chosen = rows.filter(F.length("text") <= 10_000).orderBy(F.xxhash64("id"), "id").limit(60).collect()
    model = fit(spark.createDataFrame([tuple(r) for r in chosen], rows.schema))
    plain = {}
    for lang in ("de", "es"):
        tokens = Tokens(model.known, lang)
        both = [tokens.read([r["text"]])[0].tolist() for r in chosen if r["lang"] == lang]
        texts = [[["<s>" if t == START else t for t in ids[which][2:]] for ids in both] for which in (0, 1)]
        plain[lang] = tokens, [KneserNey(of, 3) for of in texts]
    scored = {r["id"]: r for r in perplexity(rows.limit(80), model).collect()}
    met = 0
    for r in rows.limit(80).filter("id % 7 = 0").collect():
        tokens, models = plain[r["lang"]]
        ids, found = tokens.read([r["text"]])[0].tolist(), scored[r["id"]]
        for name, own, plain_model in zip(("log_p", "log_shapes"), ids, models):
            assert found[name] == pytest.approx(plain_model.log10(own[2:]) * math.log(10), rel=1e-9)
        assert found["n_tokens"] == len(ids[0]) - 2
        met += 1
    assert met


def test_held_out_accuracy(tables):
    docs, labels = tables
    found = quality_scores(docs, labels).join(labels.withColumnRenamed("doc_id", "l_id"), F.col("id") == F.col("l_id"))
    good, bad = found.filter("quality = 1"), found.filter("quality = 0")
    assert good.filter("kept").count() >= 0.98 * good.count()
    assert bad.filter("not kept").count() >= 0.9 * bad.count()


def test_kept_follows_the_scores(tables):
    docs, labels = tables
    scores = {r["id"]: r["kept"] for r in quality_scores(docs, labels).collect()}
    kept = quality_kept(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, k in scores.items() if k}


def test_odd_rows(spark, odd_docs, no_docs):
    no_labels = spark.createDataFrame([], "doc_id long, quality int")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (3, 0), (8, None), (9, 1), (9, None), (None, 1), (10, 1), (12, 1)], "doc_id long, quality int")
    for known in (no_labels, labels):
        assert quality_scores(odd_docs, known).count() == odd_docs.count()
        kept = quality_kept(odd_docs, known)
        assert kept.columns == odd_docs.columns
        assert quality_scores(no_docs, known).count() == 0 and quality_kept(no_docs, known).count() == 0
    assert quality_kept(odd_docs, no_labels).count() == odd_docs.count()
    other = quality_scores(odd_docs, labels).filter("lang is null")
    assert other.filter("kept and perplexity is null").count() == odd_docs.filter("lang is null").count()


def _language(rng, letters, words=1500):
    """Words of syllables, each with few that may follow it."""
    vocabulary = sorted({"".join(rng.choice(letters) + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(words)})
    follows = {w: rng.sample(vocabulary, 3) for w in vocabulary}

    def text(n=80):
        out = [rng.choice(vocabulary)]
        while len(out) < n:
            out.append(rng.choice(follows[out[-1]]))
        return " ".join(out)

    return text


def test_bad_text_of_ordinary_shape_is_rejected(spark):
    rng = random.Random(3)
    one, two = _language(rng, "bdgklmn"), _language(rng, "fprstvz")
    rows = [(i, one(), "xx") for i in range(400)] + [(400 + i, two(), "yy") for i in range(400)]
    labels = [(i, 1) for i in range(800)]

    def gibberish(n=80):
        return " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(rng.randint(4, 8))) for _ in range(n))

    def shuffled():
        words = one().split()
        rng.shuffle(words)
        return " ".join(words)

    rows += [(1000 + i, one(), "xx") for i in range(20)]
    for at, bad in ((2000, gibberish), (3000, shuffled), (4000, two)):
        rows += [(at + i, bad(), "xx") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labelled = spark.createDataFrame(labels, "doc_id long, quality int")
    kept = {r["id"]: r["kept"] for r in quality_scores(docs, labelled).collect()}
    assert sum(kept[1000 + i] for i in range(20)) >= 19
    for at in (2000, 3000, 4000):
        assert sum(kept[at + i] for i in range(20)) == 0, at


def test_each_language_has_its_own_sample(spark):
    rows = [(i, f"text {i}", "xx") for i in range(3000)] + [(3000 + i, f"text {i}", "yy") for i in range(30)] + [(4000, "z" * 99, "zz")] + [(5000, "again", "xx")] * 3
    rows = spark.createDataFrame(rows, "id long, text string, lang string")
    found = sample(rows, 50, 40).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in found} == {"xx": 50, "yy": 30}
    first = rows.filter("lang = 'xx'").distinct().orderBy(F.xxhash64("id", "text")).limit(50)
    assert {r["id"] for r in sample(rows, 50, 40).filter("lang = 'xx'").collect()} == {r["id"] for r in first.collect()}


def test_a_rare_language_is_filtered_and_others_are_reported(spark):
    rng = random.Random(4)
    one, two = _language(rng, "bdgklmn"), _language(rng, "fprstvz")
    rows = [(i, one(30), "xx") for i in range(900)] + [(900 + i, two(30), "yy") for i in range(60)] + [(960, "x", "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(960)], "doc_id long, quality int")
    scores = written(quality_scores(docs, labels, fit_docs=10), "scores")
    assert scores.filter("lang = 'yy' and threshold is null").count() == 0
    assert [tuple(r) for r in uncovered(scores).collect()] == [("zz", 1, "no model")]


def test_a_batch_is_read_in_slices():
    """A worker holds the texts of a slice as Python strings, not those of a batch."""
    texts = [f"{i} " + "wörd " * 2000 for i in range(2000)] + ["x" * 3_000_000, "", "end"]
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": [("xx", "yy", None)[i % 3] for i in range(len(texts))]})
    seen = []
    tracemalloc.start()
    for part, rows, own in quality._by_language([batch, batch.slice(0, 0)]):
        assert len(own) == part.num_rows and sorted(i for at in rows.values() for i in at) == [i for i, x in enumerate(part.column("lang").to_pylist()) if x]
        seen += [hash(t) for t in own]
        del part, own
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == [hash(t) for t in texts]
    assert peak < 12_000_000 < batch.nbytes


def test_languages_share_the_room_for_words(monkeypatch):
    met = []

    class Watched(Tokens):
        def __init__(self, *args):
            super().__init__(*args)
            met.append(self)

    monkeypatch.setattr(Watched, "KEEP", 150)
    monkeypatch.setattr(quality, "Tokens", Watched)
    nothing = quality.SortedArrays("", [], [])
    texts = [" ".join(f"{lang}{n}w{i}" for i in range(100)) for n in range(2) for lang in "abcdef"]
    batches = [pa.RecordBatch.from_pydict({"text": [t], "lang": [t[0]]}) for t in texts]
    grams = 0
    for out in quality._count(batches, nothing):
        grams += sum(out.column("n").to_pylist())
        assert sum(len(t.slots) for t in met) <= 150 + 100
    assert len(met) == 6 and grams == 2 * 12 * 101


def test_all_trusted_texts_are_fitted(spark, monkeypatch):
    """More texts of a language, and longer ones, than a sample would hold; equal rows once."""
    rows = [(i, f"word{i % 70} of text {i}", "xx") for i in range(5000)] + [(5000 + i, f"long{i} " * 3000, "xx") for i in range(20)]
    docs = spark.createDataFrame(rows + rows[:300], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], 1) for r in rows], "doc_id long, quality int")
    fitted = []

    def watched(chosen, *args):
        fitted.extend(chosen.select("id", F.length("text")).collect())
        return fit(chosen, *args)

    monkeypatch.setattr(quality, "fit", watched)
    assert quality_scores(docs, labels).count() == len(rows) + 300
    want = docs.distinct().filter(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).select("doc_id", F.length("text")).collect()
    assert sorted(map(tuple, fitted)) == sorted(map(tuple, want))
    assert len(want) > 2300 and max(n for _, n in want) > 10_000


def test_long_and_late_texts_teach_the_model_their_words(spark):
    rows = [(i, "one two three", "xx") for i in range(2500)] + [(9000, "four five six " * 1000, "xx")]
    model = fit(sample(spark.createDataFrame(rows, "id long, text string, lang string")))
    known = [int(n) for n in Tokens(model.known, "xx").read(["one four six"])[0][0][2:-1]]
    assert known == text_hashes([b"one", b"four", b"six"]).tolist()


def test_shards_and_parts_of_tasks_change_nothing(spark, tables, monkeypatch):
    docs, labels = tables
    rows = docs.join(labels.filter("quality = 1"), "doc_id").filter("lang in ('de', 'es')").select(F.col("doc_id").alias("id"), "text", "lang").limit(60)
    rows = spark.createDataFrame(rows.collect(), rows.schema).repartition(5)
    one = {r["id"]: r for r in perplexity(rows, fit(rows)).collect()}
    monkeypatch.setattr(quality, "SHARD_WORDS", 1500)
    monkeypatch.setattr(quality, "FLUSH", 700)
    model = fit(rows)
    assert all(len(t.parts) > 5 for t in (*model.grams.values(), *model.contexts.values()))
    for r in perplexity(rows, model).collect():
        for name in ("log_p", "log_shapes", "log_spelling", "n_tokens"):
            assert r[name] == pytest.approx(one[r["id"]][name], rel=1e-12)


def test_stored_spellings_are_those_of_the_rarer_words(spark):
    words = ["Hauses", "x2y", "öde", "haus", "haus"]
    rows = [(1, " ".join([*words, *["dog"] * 3]), "xx"), (2, "other words", "yy")]
    model = fit(spark.createDataFrame(rows, "id long, text string, lang string"))
    grams, of = Spelling.grams(words[:4])
    plain = Spelling(grams, np.array([1, 1, 1, 2])[of])
    asked = ["Hauses", "dog", "zz", "X7", "\U00010348"]
    assert StoredSpelling(model.known, "xx").log_p(asked) == pytest.approx(plain.log_p(asked))
    nothing = Spelling(np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert StoredSpelling(model.known, "zz").log_p(asked) == pytest.approx(nothing.log_p(asked))
