"""Language-model scoring: an interpolated modified Kneser-Ney n-gram model,
counted in Spark, stored as sorted hash arrays and mapped into memory by workers."""

from __future__ import annotations

import os
import uuid
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import mounted, picked, shared_folder

#: Words of an n-gram.
ORDER = 2
#: Documents whose crc32(id) leaves this remainder are held out.
FOLDS, HELD_OUT = 5, 1
CHUNK_BYTES = 4 << 20
FLUSH_TOKENS = 4_000_000

# The end of a text is a token of its own; as a word it cannot occur in a text.
END_WORD = b"\n"
#: Ids beyond the vocabulary: the place before a text, and a word not met in training.
BEFORE, UNKNOWN = 0xFFFFFFFF, 0xFFFFFFFE

PIECES = "shard int, kind string, arrays array<binary>, stats array<double>"
_ARROW_PIECES = pa.schema([("shard", pa.int32()), ("kind", pa.string()), ("arrays", pa.list_(pa.binary())), ("stats", pa.list_(pa.float64()))])


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def row_key(columns: list[np.ndarray]) -> np.ndarray:
    """64-bit keys of rows of token ids (a multiply-xorshift mix, column by column)."""
    key = np.full(len(columns[0]), len(columns), np.uint64)
    for column in columns:
        key = (key ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
        key *= np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return key


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of keys, so that the shards in order are one sorted array."""
    return (((keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


def pack(values: np.ndarray) -> bytes:
    """Bytes of equal rank together, which compresses sorted keys and small counts."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(("shard", "kind", "arrays", "stats"), r)) for r in rows], schema=_ARROW_PIECES)


def _dealt(kind: str, keys: np.ndarray, columns: list[np.ndarray], shards: int):
    """Rows in key order, cut into a piece for each shard."""
    ends = np.searchsorted(shard_of(keys, shards), np.arange(shards + 1))
    for shard in np.flatnonzero(np.diff(ends)):
        part = slice(ends[shard], ends[shard + 1])
        yield _pieces([(int(shard), kind, [pack(np.ascontiguousarray(c[part])) for c in columns], None)])


def _summed(keys: np.ndarray, columns: list[np.ndarray], sums: list[np.ndarray]) -> tuple:
    """Rows with equal keys as one: (sorted keys, columns, sums)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    added = [np.add.reduceat(s[order], first) if len(first) else s for s in sums]
    return keys[first], [c[order][first] for c in columns], added


def _texts(batches, column: str = "text"):
    """Lists of texts (as bytes) of a few MB, with the rows they come from."""
    for batch in batches:
        held, size, start = [], 0, 0
        values = batch.column(batch.schema.get_field_index(column))
        for i in range(batch.num_rows):
            text = (values[i].as_py() or "").encode("utf-8", "replace")
            held.append(text)
            size += len(text)
            if size >= CHUNK_BYTES:
                yield batch.slice(start, len(held)), held
                held, size, start = [], 0, i + 1
        if held:
            yield batch.slice(start, len(held)), held


class Chunk:
    """Texts as tokens: distinct words, and each token's place among them."""

    def __init__(self, texts: list[bytes]):
        place: dict[bytes, int] = {END_WORD: 0}
        at: list[int] = []
        ends = []
        for text in texts:
            words = text.lower().split()
            for w in words:
                if w not in place:
                    place[w] = len(place)
            at += map(place.__getitem__, words)
            at.append(0)
            ends.append(len(at))
        self.at = np.array(at, np.int64)
        self.starts = np.array([0, *ends[:-1]], np.int64)
        self.lengths = np.array(ends, np.int64) - self.starts
        self.hashes = np.fromiter((word_hash(w) for w in place), np.uint64, len(place))

    def grams(self, ids: np.ndarray, order: int) -> list[np.ndarray]:
        """Columns of ids: of each token, and of the order-1 places before it."""
        pad = order - 1
        flat = np.full(len(self.at) + pad * len(self.starts), BEFORE, np.uint32)
        where = np.arange(len(self.at)) + pad * np.repeat(np.arange(1, len(self.starts) + 1), self.lengths)
        flat[where] = ids[self.at]
        return [flat[where - back] for back in range(pad, -1, -1)]


class Tables:
    """Sorted arrays in the shared folder; every look-up maps only what it reads."""

    def __init__(self, folder: str, shards: int):
        self.folder, self.shards = folder, shards

    def save(self, name: str, shard: int, **arrays: np.ndarray) -> None:
        """Whole files under final names only, so that a task may run twice."""
        os.makedirs(self.folder, exist_ok=True)
        for array, values in arrays.items():
            path = f"{self.folder}/{name}-{shard:06d}.{array}.npy"
            with open(f"{path}.{uuid.uuid4().hex}", "wb") as f:
                np.save(f, values)
            os.replace(f.name, path)

    def find(self, name: str, keys: np.ndarray, *arrays: str) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(shard, position or -1, values or 0) of each key."""
        distinct, inverse = np.unique(keys, return_inverse=True)
        shard = shard_of(distinct, self.shards)
        position = np.full(len(distinct), -1, np.int64)
        values = [np.zeros(len(distinct)) for _ in arrays]
        ends = np.searchsorted(shard, np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(ends)):
            path = f"{self.folder}/{name}-{s:06d}"
            if not os.path.exists(f"{path}.keys.npy"):
                continue  # a shard without any entry
            stored = np.load(f"{path}.keys.npy", mmap_mode="r")
            asked = distinct[ends[s] : ends[s + 1]]
            spot = np.searchsorted(stored, asked)
            spot[spot == len(stored)] = 0
            hit = np.flatnonzero(stored[spot] == asked)
            position[ends[s] + hit] = spot[hit]
            for out, array in zip(values, arrays):
                out[ends[s] + hit] = np.load(f"{path}.{array}.npy", mmap_mode="r")[spot[hit]]
        return shard[inverse], position[inverse], [v[inverse] for v in values]


def _count_words(batches, shards: int):
    seen: Counter = Counter()

    def flush():
        hashes = np.fromiter((word_hash(w) for w in seen), np.uint64, len(seen))
        counts = np.fromiter(seen.values(), np.uint64, len(seen))
        keys, _, (n,) = _summed(hashes, [], [counts])
        yield from _dealt("word", keys, [keys, n], shards)

    for _, texts in _texts(batches):
        for text in texts:
            seen.update(text.lower().split())
        seen[END_WORD] += len(texts)
        if len(seen) > FLUSH_TOKENS:
            yield from flush()
            seen.clear()
    if seen:
        yield from flush()


def _by_shard(batches):
    """The pieces of one shard after the other; rows come sorted by shard."""
    shard, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != shard and held:
                yield shard, held
                held = []
            shard = row["shard"]
            held.append(row["arrays"])
    if held:
        yield shard, held


def _stacked(pieces: list, kinds: list[type]) -> list[np.ndarray]:
    return [np.concatenate([unpack(p[i], kind) for p in pieces]) for i, kind in enumerate(kinds)]


def _merge_words(batches, tables: Tables):
    for shard, pieces in _by_shard(batches):
        keys, counts = _stacked(pieces, [np.uint64, np.uint64])
        keys, _, (counts,) = _summed(keys, [], [counts])
        tables.save("words", shard, keys=keys, counts=counts)
        yield _pieces([(shard, "stats", None, [float(len(keys)), float(counts.sum())])])


def _word_ids(hashes: np.ndarray, tables: Tables, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    shard, position, (counts,) = tables.find("words", hashes, "counts")
    return np.where(position < 0, UNKNOWN, offsets[shard] + position).astype(np.uint32), counts


def _count_grams(batches, order: int, tables: Tables, offsets: np.ndarray):
    held: list[list[np.ndarray]] = []
    size = 0

    def flush():
        columns = [np.concatenate(c) for c in zip(*held)]
        keys, columns, (n,) = _summed(row_key(columns), columns, [np.ones(len(columns[0]), np.uint64)])
        yield from _dealt("gram", keys, [*columns, n], tables.shards)

    for _, texts in _texts(batches):
        chunk = Chunk(texts)
        ids, _ = _word_ids(chunk.hashes, tables, offsets)
        held.append(chunk.grams(ids, order))
        size += len(chunk.at)
        if size >= FLUSH_TOKENS:
            yield from flush()
            held, size = [], 0
    if held:
        yield from flush()


def _merge_grams(batches, order: int, tables: Tables):
    """Store the n-grams of a shard with their counts; hand on what the next
    tables need: sums of their contexts, and their suffixes, each of which
    counts once for every different word before it."""
    for shard, pieces in _by_shard(batches):
        *columns, counts = _stacked(pieces, [np.uint32] * order + [np.uint64])
        keys, columns, (counts,) = _summed(row_key(columns), columns, [counts])
        small = np.uint16 if counts.max() < 1 << 16 else np.uint64
        tables.save(f"grams{order}", shard, keys=keys, counts=counts.astype(small))
        kinds = [(counts == i).sum() for i in (1, 2, 3, 4)]
        yield _pieces([(shard, "stats", None, [float(x) for x in (len(keys), counts.sum(), *kinds)])])
        if order > 1:
            each = [counts, *((counts == i).astype(np.uint64) for i in (1, 2)), (counts > 2).astype(np.uint64)]
            context, _, sums = _summed(row_key(columns[:-1]), [], each)
            yield from _dealt("context", context, [context, *sums], tables.shards)
            # Nothing stands before a text's first place: there occurrences count.
            first = (columns[0] == BEFORE) & (columns[1] == BEFORE)
            once = np.where(first, counts, 1).astype(np.uint64)
            suffix, rest, (n,) = _summed(row_key(columns[1:]), columns[1:], [once])
            yield from _dealt("gram", suffix, [*rest, n], tables.shards)


def _merge_contexts(batches, order: int, tables: Tables, discounts: list[float]):
    for shard, pieces in _by_shard(batches):
        keys, *sums = _stacked(pieces, [np.uint64] * 5)
        keys, _, (total, *kinds) = _summed(keys, [], sums)
        back_off = sum(d * n for d, n in zip(discounts[1:], kinds)) / total
        tables.save(f"contexts{order}", shard, keys=keys, total=total, back_off=back_off)
        yield _pieces([(shard, "stats", None, [float(len(keys))])])


def discounts(ones: float, twos: float, threes: float, fours: float) -> list[float]:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more (Chen and
    Goodman, 1998); kept inside (0, count) where there are too few to estimate."""
    n = [ones, twos, threes, fours]
    y = ones / (ones + 2 * twos) if ones else 0.5
    found = [i - (i + 1) * y * n[i] / n[i - 1] if n[i - 1] else 0.0 for i in (1, 2, 3)]
    return [0.0] + [min(max(d, 0.05), i - 0.01) for i, d in enumerate(found, 1)]


@dataclass(frozen=True)
class Model:
    order: int
    tables: Tables
    offsets: np.ndarray  # id of the first word of each shard
    tokens: int  # N: training tokens
    words: int  # V: different training tokens
    discounts: dict[int, list[float]]
    first_total: float  # sum and back-off weight of the unigrams
    first_back_off: float


def _stats(pieces: DataFrame, n: int) -> list[float]:
    sums = [F.coalesce(F.sum(F.col("stats")[i]), F.lit(0.0)) for i in range(n)]
    return list(pieces.filter("kind = 'stats'").agg(*sums).first())


def train(texts: DataFrame, order: int = ORDER) -> Model:
    """Train on rows (text). Three kinds of Spark jobs, each with one shuffle:
    words are counted, n-grams of word ids are counted, and for each lower order
    the suffixes of the order above. Tasks sum what they have met before it is
    shuffled, as compressed pieces of sorted arrays, one for each range of
    keys; the task of a range merges them and writes its files.

    Hashed keys spread any word or passage evenly; the driver sees sums, and the
    number of words of each range.
    """
    spark = texts.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    home = shared_folder(spark, "lm")
    tables = Tables(mounted(home), shards)

    def step(name: str, rows: DataFrame, emit, merge) -> DataFrame:
        pieces = rows.mapInArrow(emit, PIECES) if emit else rows
        merged = pieces.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(merge, PIECES)
        merged.write.parquet(f"{home}-{name}")
        return spark.read.schema(merged.schema).parquet(f"{home}-{name}")

    words = step("words", texts, lambda b: _count_words(b, shards), lambda b: _merge_words(b, tables))
    sizes = np.zeros(shards, np.int64)
    for row in words.select("shard", F.col("stats")[0].alias("n")).collect():
        sizes[row["shard"]] = int(row["n"])
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    vocabulary, tokens = (int(x) for x in _stats(words, 2))
    if vocabulary >= UNKNOWN:
        raise ValueError(f"{vocabulary} different words do not fit 32-bit ids")

    cuts: dict[int, list[float]] = {}
    grams, emit = texts, lambda b: _count_grams(b, order, tables, offsets)
    for n in range(order, 0, -1):
        grams = step(f"grams{n}", grams, emit, lambda b, n=n: _merge_grams(b, n, tables))
        emit = None
        _, total, ones, twos, threes, fours = _stats(grams, 6)
        cuts[n] = discounts(ones, twos, threes, fours)
        if n > 1:
            step(f"contexts{n}", grams.filter("kind = 'context'"), None, lambda b, n=n: _merge_contexts(b, n, tables, cuts[n])).isEmpty()
            grams = grams.filter("kind = 'gram'")
        else:
            more = _stats(grams, 1)[0] - ones - twos
            back_off = (cuts[1][1] * ones + cuts[1][2] * twos + cuts[1][3] * more) / total if total else 1.0
    return Model(order, tables, offsets, tokens, vocabulary, cuts, total, back_off)


def _score(texts: list[bytes], model: Model) -> dict[str, np.ndarray]:
    chunk = Chunk(texts)
    ids, counts = _word_ids(chunk.hashes, model.tables, model.offsets)

    def per_text(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, chunk.starts)

    base = np.log10((counts + 0.5) / (model.tokens + 0.5 * (model.words + 1)))
    _, _, (follows,) = model.tables.find("grams1", row_key([ids]), "counts")

    def less(n: np.ndarray, order: int) -> np.ndarray:
        return n - np.array(model.discounts[order])[np.minimum(n, 3).astype(np.int64)]

    single = model.first_back_off / (model.words + 1)
    if model.first_total:
        single = less(follows, 1) / model.first_total + single
    p = np.broadcast_to(single, ids.shape)[chunk.at]
    columns = chunk.grams(ids, model.order)
    for order in range(2, model.order + 1):
        own = columns[-order:]
        _, _, (n,) = model.tables.find(f"grams{order}", row_key(own), "counts")
        _, _, (total, back_off) = model.tables.find(f"contexts{order}", row_key(own[:-1]), "total", "back_off")
        known = total > 0
        p = np.where(known, less(n, order) / np.where(known, total, 1) + back_off * p, p)
    return {
        "n_tokens": chunk.lengths,
        "n_known": per_text((counts > 0).astype(np.int64)[chunk.at]),
        "base_score": per_text(base[chunk.at]),
        "score": per_text(np.log10(p)),
    }


def scores(rows: DataFrame, model: Model) -> DataFrame:
    """Rows (text, ...) with n_tokens, n_known, base_score and score (sums of
    log10 probabilities over a text's tokens) in place of the text."""
    kept = [f for f in rows.schema if f.name != "text"]
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n_tokens long, n_known long, base_score double, score double"])

    def run(batches):
        for batch, texts in _texts(batches):
            found = _score(texts, model)
            columns = {f.name: batch.column(batch.schema.get_field_index(f.name)) for f in kept}
            yield pa.RecordBatch.from_pydict(columns | {k: pa.array(v) for k, v in found.items()})

    return rows.mapInArrow(run, out)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    A model is trained on all texts whose crc32(id) does not leave the held-out
    remainder; all texts are scored. Tokens are the words of the text with A-Z
    in lower case, and its end. ``base_score`` is that of a unigram model with
    half a count added.

    Null texts are empty (one token, the end); rows without an id are trained
    on; repeated rows count as often as they come; without training texts all
    scores are those of an empty model; no documents give no rows.
    """
    rows = picked(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    held_out = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    model = train(rows.filter(~held_out).select("text"), order)
    found = scores(rows.select("id", held_out.alias("held_out"), "text"), model)
    return found.select("id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
