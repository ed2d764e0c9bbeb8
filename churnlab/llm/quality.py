"""Quality classifier: perplexity under an n-gram model of trusted text."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.llm.arrays import CodedArrays, SortedArrays, small, sorted_arrays, store, store_coded, stored
from churnlab.llm.bpe import text_chunks
from churnlab.llm.common import drop_shuffles, free_name, picked, shared_folder, whole_text, written
from churnlab.llm.lm import pack, unpack

#: The model's words are those that occur this often in a language's fitted texts, those
#: of the model of shapes such as make up this share of a language's tokens ...
WORD_COUNT, WORD_SHARE = 3, 0.003
#: ... and its shapes are those that other words have this often.
SHAPE_COUNT = 3
#: Documents are rejected above this quantile of trusted perplexity, times a margin:
#: for shapes MARGIN; for words the least of these with the fewest errors on held-out
#: labels, or MARGIN if a language has no bad ones.
QUANTILE, MARGIN = 0.99, 2.0
MARGINS = tuple(round(1 + i / 10, 1) for i in range(21))
#: ... of at least so many texts; languages with fewer reject nothing.
LEAST_TRUSTED = 10
#: A document's mean is drawn to its language's trusted mean as by so many more tokens.
PRIOR_TOKENS = 10
SHAPE_LENGTH = 8
#: Languages whose words a worker keeps at a time.
READERS = 8
#: Parts of the hash order in which a sample's end is looked for.
SLICES = 1024
#: Bytes of texts read at a time (a longer text is read alone), and trigrams scored at a time.
READ_BYTES, SCORED = 1_000_000, 250_000
#: Words of the fitted texts for each shard of the models' tables; a gram's shard is told
#: by the first bits of its key.
SHARD_WORDS, SHARD_BITS = 2_000_000, 12
#: Trigrams that a task of the fit sums before they are dealt to the shards.
FLUSH = 1_000_000
#: Tokens with a fixed meaning; all others are 64-bit hashes of a word or shape.
UNKNOWN, START, END, AGAIN = 0, 1, 2, 3
#: What a key of the table of known words is the hash of, with the columns that follow
#: it: a word; a language's own word; a shape; of the spellings of a language's other
#: words, up to three characters, and the sum and number of what follows up to two.
WORD, OWN, SHAPE, SPELT, SPELT_SUM, SPELT_KINDS = range(6)
#: Bits of a character in the key of a spelling.
CHAR = 21


class _Kinds(dict):
    """Kinds of characters by code point, for str.translate."""

    def __missing__(self, code: int) -> str:
        ch = chr(code)
        kind = self[code] = "A" if ch.isupper() else "a" if ch.isalpha() else "0" if ch.isdigit() else ch
        return kind


_KINDS, _RUNS = _Kinds(), re.compile(r"(.)\1+", re.DOTALL)


def shape(word: str) -> str:
    """A word's kinds of characters, runs folded: 'Haus,' is 'Aa,'."""
    return _RUNS.sub(r"\1", word.translate(_KINDS))[:SHAPE_LENGTH]


def shapes_of(words: list[str]) -> list[str]:
    """Shapes of words (not empty, without line feeds), at once."""
    return [s[:SHAPE_LENGTH] for s in _RUNS.sub(r"\1", "\n".join(words).translate(_KINDS)).split("\n")]


# The primes of XXH64.
_PRIMES = [np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def hashed(*columns) -> np.ndarray:
    """Spark's ``xxhash64`` of long columns (arrays or single numbers), as longs.

    Keys that differ share a hash with a chance of 2^-64 a pair.
    """
    p1, p2, p3, p4, p5 = _PRIMES
    h = np.full(1, 42, np.uint64)
    for column in columns:
        x = np.atleast_1d(np.asarray(column, np.int64)).view(np.uint64)
        h = (h + p5 + np.uint64(8)) ^ (_turned(x * p2, 31) * p1)
        h = _turned(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def _key(role: int, *columns) -> Column:
    """The same as ``hashed(role, *columns)`` over columns of a DataFrame."""
    return F.xxhash64(F.lit(role).cast("long"), *columns)


def text_hashes(texts: list[bytes]) -> np.ndarray:
    """Spark's ``xxhash64`` of strings."""
    return np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in texts), np.uint64, len(texts)).view(np.int64)


def _numbers(lang: str) -> list[int]:
    """A language's numbers in the tables of the two models."""
    return [int(hashed(text_hashes([lang.encode()]), which)[0]) for which in (0, 1)]


def _found(tables: SortedArrays | CodedArrays, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wanted, place = np.unique(keys, return_inverse=True)
    value, has = tables.find(wanted)
    return value[place], has[place]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(place, counts, len(distinct))


class Spelling:
    """Log probability of words' spellings: a character trigram model (Witten-Bell,
    down to any of the code points) of one language's rarer words. Case and
    figures are the shape's business."""

    ANY = 0x110000
    _FIGURE = re.compile(r"\d")

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.levels = {}
        for width in (1, 2, 3):
            keys, n = _summed(grams & ((1 << CHAR * width) - 1), counts)
            contexts, whole = _summed(keys >> CHAR, n)
            self.levels[width] = (keys, n, contexts, whole, _summed(keys >> CHAR, np.ones(len(keys)))[1])

    def _seen(self, width: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of grams of so many characters, and the sums and numbers of what
        follows their contexts."""
        keys, n, contexts, whole, kinds = self.levels[width]
        if not len(keys):
            return np.zeros(len(grams)), np.zeros(len(grams)), np.zeros(len(grams))
        at, after = np.minimum(np.searchsorted(keys, grams), len(keys) - 1), np.minimum(np.searchsorted(contexts, grams >> CHAR), len(contexts) - 1)
        known = contexts[after] == grams >> CHAR
        return np.where(keys[at] == grams, n[at], 0.0), np.where(known, whole[after], 0.0), np.where(known, kinds[after], 0.0)

    @classmethod
    def grams(cls, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Trigrams of the words' characters between two edges and one, and which
        word each is of."""
        plain = [w.lower() for w in words]
        lengths = np.fromiter(map(len, plain), np.int64, len(plain)) + 3
        joined = cls._FIGURE.sub("0", "".join(f"\0\0{w}\0" for w in plain)) + "\0\0"
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        keys = (code[:-2] << 2 * CHAR) | (code[1:-1] << CHAR) | code[2:]
        of = np.repeat(np.arange(len(words)), lengths)
        inside = np.arange(len(keys)) - np.repeat(np.cumsum(lengths) - lengths, lengths) < lengths[of] - 2
        return keys[inside], of[inside]

    def log_p(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        grams, of = self.grams(words)
        distinct, place = np.unique(grams, return_inverse=True)
        p = np.full(len(distinct), 1 / self.ANY)
        for width in (1, 2, 3):
            seen, whole, kinds = self._seen(width, distinct & ((1 << CHAR * width) - 1))
            p = np.where(whole > 0, (seen + kinds * p) / np.maximum(whole + kinds, 1), p)
        return np.bincount(of, np.log(p)[place], len(words))


class StoredSpelling(Spelling):
    """The same from counts in the table of known words."""

    def __init__(self, known: SortedArrays, lang: str):
        self.known, self.lang = known, text_hashes([lang.encode()])

    def _seen(self, width: int, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        asked = ((SPELT, grams), (SPELT_SUM, grams >> CHAR), (SPELT_KINDS, grams >> CHAR))
        return tuple(_found(self.known, hashed(role, self.lang, width, keys))[0] for role, keys in asked)


class _Slots(dict):
    """Words' places in the order in which they are met; the first two are the
    start and the end."""

    def __missing__(self, word: bytes) -> int:
        slot = self[word] = len(self) + 2
        return slot


class Tokens:
    """Tokens of one language's words under both models: known words stand for
    themselves, others for their shape; a word that repeats the word before it is a
    token of its own.

    Words are what stands between the contracts' white space, as in the fit. Each
    distinct word is looked at once while its slot is kept (KEEP words or KEEP_BYTES
    bytes, over all languages of a worker: see ``make_room``), new words of many texts at once; ``spelling`` adds the log probability of
    the spelling of words that are not the language's own.
    """

    KEEP, KEEP_BYTES = 300_000, 16 << 20

    def __init__(self, known: SortedArrays, lang: str, spelling: Spelling | None = None):
        self.known, self.spelling = known, spelling
        self.lang = text_hashes([lang.encode()])
        self.forget()

    def forget(self) -> None:
        self.slots, self.size = _Slots(), 0
        self.ids = np.array([[START, END]] * 2, np.int64)
        self.spelt = np.zeros(2)

    def _learn(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8", "replace") for w in words]
        hashes = text_hashes(words)
        shapes = shapes_of(texts)
        distinct = dict.fromkeys(shapes)
        shape_ids = text_hashes([s.encode() for s in distinct])
        at = dict(zip(distinct, range(len(distinct))))
        at = np.fromiter(map(at.__getitem__, shapes), np.int64, len(shapes))
        words_in = _found(self.known, hashed(WORD, hashes))[0].astype(np.int64)
        shapes_in = _found(self.known, hashed(SHAPE, shape_ids))[0].astype(np.int64)[at]
        ids = [np.where(words_in & bit, hashes, np.where(shapes_in & bit, shape_ids[at], UNKNOWN)) for bit in (1, 2)]
        spelt = np.zeros(len(words))
        if self.spelling:
            other = np.flatnonzero(~_found(self.known, hashed(OWN, self.lang, hashes))[1])
            spelt[other] = self.spelling.log_p([texts[i] for i in other])
        self.ids = np.concatenate([self.ids, ids], axis=1)
        self.spelt = np.append(self.spelt, spelt)
        self.size += sum(map(len, words))

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For both models a row of tokens, each text's from two starts to its end;
        the texts' lengths in it; and their spellings' log probabilities, where a word
        that repeats the one before is not spelt again."""
        if len(self.slots) > self.KEEP or self.size > self.KEEP_BYTES:
            self.forget()
        before, slot_of = len(self.slots), self.slots.__getitem__
        flat: list[int] = []
        ends = [0]
        for text in texts:
            flat += (0, 0, *map(slot_of, text.encode("utf-8", "replace").split()), 1)
            ends.append(len(flat))
        if len(self.slots) > before:
            self._learn(list(islice(self.slots, before, None)))
        at = np.array(flat, np.int64)
        again = np.flatnonzero((at[1:] == at[:-1]) & (at[1:] > 1)) + 1
        ids, spelt = self.ids[:, at], self.spelt[at]
        ids[:, again], spelt[again] = AGAIN, 0.0
        ends = np.array(ends)
        return ids, np.diff(ends), np.add.reduceat(spelt, ends[:-1])


def make_room(readers: list[Tokens]) -> None:
    """Forget the words of a worker's languages where these together are too many to keep."""
    if sum(len(r.slots) for r in readers) > Tokens.KEEP or sum(r.size for r in readers) > Tokens.KEEP_BYTES:
        for r in readers:
            r.forget()


def _trigrams(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The trigrams of texts of these lengths that follow one another."""
    inside = np.ones(len(ids), bool)
    starts = np.cumsum(lengths) - lengths
    inside[starts] = inside[starts + 1] = False
    last = np.flatnonzero(inside)
    return ids[last - 2], ids[last - 1], ids[last]


def _by_language(batches) -> Iterator[tuple[pa.RecordBatch, dict[str, list[int]], list[str]]]:
    """Slices of Arrow batches of at most READ_BYTES of texts: the slice, the rows of
    each language, and the texts."""
    for part in text_chunks(batches, size=READ_BYTES):
        rows: dict[str, list[int]] = {}
        for i, lang in enumerate(part.column("lang").to_pylist()):
            if lang is not None:
                rows.setdefault(lang, []).append(i)
        yield part, rows, part.column("text").to_pylist()


def _count(batches, known: SortedArrays):
    """mapInArrow over (text, lang): both models' trigrams with counts."""
    readers: dict[str, Tokens] = {}
    names = ["number", "a", "b", "c", "n"]
    for _, rows, texts in _by_language(batches):
        for lang, own in rows.items():
            if lang not in readers:
                if len(readers) >= READERS:
                    readers.clear()
                readers[lang] = Tokens(known, lang)
            make_room(list(readers.values()))
            both, lengths, _ = readers[lang].read([texts[i] for i in own])
            for number, ids in zip(_numbers(lang), both):
                a, b, c = _trigrams(ids, lengths)
                _, first, n = np.unique(hashed(a, b, c), return_index=True, return_counts=True)
                columns = (np.full(len(n), number), a[first], b[first], c[first], n)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names)


def _spelt(batches):
    """mapInArrow over (lang, word, n): the characters' trigrams with counts."""
    for part in batches:
        words, n = part.column("word").to_pylist(), part.column("n").to_numpy()
        langs = part.column("lang").to_pylist()
        for lang in dict.fromkeys(langs):
            own = [i for i, other in enumerate(langs) if other == lang]
            grams, of = Spelling.grams([words[i] for i in own])
            keys, sums = _summed(grams, n[own][of])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(sums.astype(np.int64))], ["lang", "gram", "n"])


def gram_keys(order: int, number, tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the contexts of grams (their numbers, and columns of tokens) and of the
    grams: 64-bit hashes. A gram's shares the first bits with that of its context, so
    that both are in one shard; single tokens have no context that could be spread."""
    context = hashed(order, number, *tokens[:-1])
    own = hashed(context, tokens[-1])
    rest = np.int64((1 << 64 - SHARD_BITS) - 1)
    return context, own if order == 1 else (context & ~rest) | (own & rest)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of keys, ended only between different first bits."""
    return (((keys >> (64 - SHARD_BITS)) + (1 << SHARD_BITS - 1)) * shards) >> SHARD_BITS


_PIECE = pa.schema([("shard", pa.int32()), ("kind", pa.string()), ("first", pa.int64()), ("name", pa.string()), ("sums", pa.list_(pa.int64())), ("arrays", pa.list_(pa.binary()))])
_PIECES = "shard int, kind string, first long, name string, sums array<long>, arrays array<binary>"


def _piece(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([columns], schema=_PIECE)


def _packed(values: np.ndarray) -> bytes:
    values = small(values)
    return bytes([values.itemsize]) + pack(values)


def _unpacked(data: bytes) -> np.ndarray:
    return unpack(data[1:], np.dtype(f"<u{data[0]}")).astype(np.int64)


def _merged(keys: np.ndarray, sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Rows with equal keys as one: the sorted keys, where each is met, and sums."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], order[first], [np.add.reduceat(n[order], first) if len(first) else n for n in sums]


def _dealt(order: int, number: np.ndarray, tokens: list[np.ndarray], n: np.ndarray, shards: int, folder: str):
    """Grams with counts, equal ones summed, as a packed piece for each shard: places of
    their tokens among the different ones, which are stored once for all pieces by
    falling frequency, and of their numbers; sorted by all but the last token, as this
    packs best."""
    keys, at, (n,) = _merged(gram_keys(order, number, tokens)[1], [n])
    if not len(keys):
        return
    words, places = np.unique(np.concatenate([t[at] for t in tokens]), return_inverse=True)
    often = np.argsort(-np.bincount(places), kind="stable")
    rank = np.empty_like(often)
    rank[often] = np.arange(len(often))
    places = rank[places].reshape(order, -1)
    name = store(folder, tokens=words[often])
    ends = np.searchsorted(_shard(keys, shards), np.arange(shards + 1))
    for shard in np.flatnonzero(np.diff(ends)):
        part = slice(ends[shard], ends[shard + 1])
        numbers, place = np.unique(number[at[part]].view(np.uint64), return_inverse=True)
        own = places[:, part]
        sort = np.lexsort((*own[-2::-1], place)) if order > 1 else np.argsort(place, kind="stable")
        yield _piece(shard=int(shard), kind=str(order), name=name, arrays=[_packed(x) for x in (own[:, sort].ravel(), numbers, place[sort], n[part][sort])])


def _from_piece(name: str, arrays: list[bytes], order: int, folder: str) -> list[np.ndarray]:
    """A piece's numbers, columns of tokens, and counts."""
    places, numbers, place, n = map(_unpacked, arrays)
    return [numbers[place], *stored(folder, name, "tokens")[places].reshape(order, -1), n]


def _counted(batches, known: SortedArrays, shards: int, folder: str, flush: int):
    """mapInArrow over (text, lang): both models' trigrams, summed in the task, in pieces."""
    held: list[list[np.ndarray]] = []
    size = 0

    def dealt():
        number, a, b, c, n = (np.concatenate(column) for column in zip(*held))
        return _dealt(3, number, [a, b, c], n, shards, folder)

    for grams in _count(batches, known):
        held.append([column.to_numpy() for column in grams.columns])
        size += grams.num_rows
        if size >= flush:
            yield from dealt()
            held, size = [], 0
    if held:
        yield from dealt()


def _merge(batches, order: int, shards: int, folder: str):
    """mapInArrow over the pieces of a shard: store its grams with their counts and
    its contexts with what follows them, and hand on the grams without their first
    token: each counts once for every different token before it, at a text's start
    (where none is) as often as it occurs. Other rows are handed on."""

    def merged(shard: int, pieces: list[tuple[str, list[bytes]]]):
        number, *tokens, n = (np.concatenate(column) for column in zip(*(_from_piece(*p, order, folder) for p in pieces)))
        keys, at, (n,) = _merged(gram_keys(order, number, tokens)[1], [n])
        number, tokens = number[at], [t[at] for t in tokens]
        distinct, codes = np.unique(n, return_inverse=True)
        yield _piece(shard=shard, kind=f"grams{order}", first=int(keys[0]), name=store_coded(folder, keys, codes, distinct[:, None]))
        numbers, of = np.unique(number, return_inverse=True)
        counts = [np.bincount(of, weights) for weights in (n == 1, n == 2, n == 3, n == 4, n, np.ones(len(n)))]
        for row in zip(numbers.tolist(), *counts):
            yield _piece(shard=shard, kind="sums", sums=[order, *map(int, row)])
        if order == 1:
            return
        keys, _, follows = _merged(gram_keys(order, number, tokens)[0], [n, n == 1, n == 2, n > 2])
        rows = np.stack(follows, axis=1)
        _, first, codes = np.unique(hashed(*follows), return_index=True, return_inverse=True)
        yield _piece(shard=shard, kind=f"contexts{order}", first=int(keys[0]), name=store_coded(folder, keys, codes, rows[first]))
        starts = (tokens[0] == START) & (tokens[1] == START) & (order == 3)
        yield from _dealt(order - 1, number, tokens[1:], np.where(starts, n, 1), shards, folder)

    held: dict[int, list[tuple[str, list[bytes]]]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == str(order):
                held.setdefault(row["shard"], []).append((row["name"], row["arrays"]))
            else:
                yield _piece(**row)
    for shard in sorted(held):
        yield from merged(shard, held.pop(shard))


@dataclass(frozen=True)
class Model:
    """Two models in one: of words and of shapes.

    known: words and shapes (1: of the model of words, 2: of the other, 3: both),
    each language's own words, and the spellings of its others; grams, contexts: by
    order, counts of grams, and of contexts the sum of what follows and how much of it
    is met once, twice and more often; numbers: for each language and model, by order,
    Kneser-Ney discounts, and the sum of single tokens and the share of it left for
    any other token."""

    known: SortedArrays
    grams: dict[int, CodedArrays]
    contexts: dict[int, CodedArrays]
    numbers: dict[int, tuple[dict[int, np.ndarray], float, float]]


def sample(rows: DataFrame, fit_docs: int | None = None, fit_chars: int | None = None) -> DataFrame:
    """The rows (id, text, lang) of a language, equal ones once, and only those of at
    most ``fit_chars`` characters if that is given.

    If ``fit_docs`` is given, of each language at most so many: the first by a hash of
    id and text. Where a language's sample ends is found from counts of slices of the
    hash order; the driver sees these, and the hashes of one slice of each language.
    """
    fits = rows.filter(F.col("lang").isNotNull()).withColumn("at", F.xxhash64("id", "text"))
    if fit_chars is not None:
        fits = fits.filter(F.length("text") <= fit_chars)
    if fit_docs is None:
        # Only rows that are not the only ones of their kind are shuffled with their texts.
        key = ["id", "lang", "at"]
        fits = written(fits, "quality-trusted", "zstd")
        again = written(fits.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "quality-again")
        if again.isEmpty():
            return fits.drop("at")
        once = fits.join(again, key, "left_semi").dropDuplicates(key)
        return fits.join(again, key, "left_anti").unionByName(once).drop("at")
    order = written(fits.select("lang", "at").distinct(), "quality-order")
    part = F.floor((F.col("at") / 2.0**64 + 0.5) * SLICES)
    left: dict[str, int] = {}
    ends: dict[str, int] = {}
    for r in order.groupBy("lang", part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("lang", "part").collect():
        lang = r["lang"]
        if lang not in ends:
            room = left.setdefault(lang, fit_docs)
            if r["n"] > room:
                ends[lang] = r["part"]
            else:
                left[lang] = room - r["n"]
    if not ends:
        return fits.dropDuplicates(["id", "lang", "at"]).drop("at")
    spark = rows.sparkSession
    cut = spark.createDataFrame(list(ends.items()), "lang string, part long")
    last: dict[str, list[int]] = {}
    for r in order.withColumn("part", part).join(F.broadcast(cut), ["lang", "part"]).select("lang", "at").collect():
        last.setdefault(r["lang"], []).append(r["at"])
    # The first hash that is no longer in.
    bounds = spark.createDataFrame([(lang, sorted(found)[left[lang]]) for lang, found in last.items()], "lang string, bound long")
    fits = fits.join(F.broadcast(bounds), "lang", "left").filter("bound is null or at < bound")
    return fits.dropDuplicates(["id", "lang", "at"]).drop("at", "bound")


def _spelt_rows(words: DataFrame) -> DataFrame:
    """Rows (key, value) of the spellings of counted words (lang, word, n)."""
    grams = words.mapInArrow(_spelt, "lang string, gram long, n long")
    widths = F.explode(F.array(*[F.struct(F.lit(w).cast("long").alias("width"), F.col("gram").bitwiseAND(F.lit((1 << CHAR * w) - 1)).alias("own")) for w in (1, 2, 3)]))
    grams = grams.select("lang", widths.alias("g"), "n").groupBy("lang", "g.width", "g.own").agg(F.sum("n").alias("n"))
    grams = written(grams, "quality-spellings").withColumn("l", F.xxhash64("lang"))
    after = grams.groupBy("l", "width", F.shiftright("own", CHAR).alias("own")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"))
    tables = [(grams, SPELT, "n"), (after, SPELT_SUM, "n"), (after, SPELT_KINDS, "kinds")]
    rows = [df.select(_key(role, "l", "width", "own").alias("key"), F.col(n).cast("double").alias("value")) for df, role, n in tables]
    return rows[0].union(rows[1]).union(rows[2])


def _vocabulary(words: DataFrame) -> SortedArrays:
    """Store the known words and shapes of counted words (lang, word, n), and how the
    others of a language are spelt."""
    whole = words.groupBy("lang").agg(F.sum("n").alias("whole"))
    flag = (F.col("n") >= WORD_COUNT).cast("int"), (F.col("n") >= WORD_SHARE * F.col("whole")).cast("int") * 2
    flagged = words.join(whole, "lang").select("lang", "word", "n", flag[0].alias("w"), flag[1].alias("s"))
    by_word = written(flagged.groupBy("word").agg(F.sum("n").alias("n"), (F.max("w") + F.max("s")).alias("flags")), "quality-vocabulary")
    shape_of = F.pandas_udf(lambda column: column.map(shape), "string")
    other = [F.sum(F.when(F.col("flags").bitwiseAND(bit) == 0, F.col("n"))).alias(name) for bit, name in ((1, "n1"), (2, "n2"))]
    shapes = by_word.filter("flags < 3").groupBy(shape_of("word").alias("shape")).agg(*other)
    shape_flags = F.coalesce((F.col("n1") >= SHAPE_COUNT).cast("int"), F.lit(0)) + F.coalesce((F.col("n2") >= SHAPE_COUNT).cast("int") * 2, F.lit(0))
    rows = by_word.select(_key(WORD, F.xxhash64("word")).alias("key"), F.col("flags").cast("double").alias("value"))
    rows = rows.union(shapes.select(_key(SHAPE, F.xxhash64("shape")), shape_flags.cast("double"))).filter("value > 0")
    own = words.filter(F.col("n") >= WORD_COUNT).select(_key(OWN, F.xxhash64("lang"), F.xxhash64("word")), F.lit(1.0))
    spelt = _spelt_rows(words.filter(F.col("n") < WORD_COUNT))
    return sorted_arrays(written(rows.union(own).union(spelt), "quality-known"))


def _discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 0, 1, 2 and more, from how many grams
    occur once to four times; kept inside (0, count) where those are too few."""
    n = (n1, n2, n3, n4)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    return np.array([0.0, *(max(0.05, min(i - 0.01, i - (i + 1) * y * n[i] / max(n[i - 1], 1))) for i in (1, 2, 3))])


def fit(rows: DataFrame, fit_chars: int | None = None) -> Model:
    """Fit both models on rows (id, text, lang): trusted texts, all of them or those of
    at most ``fit_chars`` characters.

    Every word that a language has WORD_COUNT times is a token of the first; of the
    other only the few most frequent ones are, and other words are just their shapes.

    Trigrams of both are counted and dealt to shards by hash of their context; each
    shard's task merges and stores its trigrams and contexts, and deals out the
    trigrams' Kneser-Ney continuation counts, which make the orders below in the same
    way. The driver sees names of arrays, and a few sums for each language.
    """
    chosen = rows.filter(F.col("lang").isNotNull()).select("text", "lang")
    if fit_chars is not None:
        chosen = chosen.filter(F.length("text") <= fit_chars)
    words = chosen.select("lang", F.explode(F.split("text", r"[ \t\n\x0b\x0c\r]+")).alias("word")).filter("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    words = written(words, "quality-words")
    known = _vocabulary(words)
    shards = min(1 << SHARD_BITS, -(-(words.agg(F.sum("n")).first()[0] or 1) // SHARD_WORDS))
    folder, flush = shared_folder(rows.sparkSession, "arrays"), FLUSH
    drop_shuffles(rows.sparkSession)
    pieces = chosen.mapInArrow(lambda batches: _counted(batches, known, shards, folder, flush), _PIECES)
    for order in (3, 2, 1):
        dealt = pieces.repartitionById(shards, F.col("shard"))
        pieces = dealt.mapInArrow(lambda batches, order=order: _merge(batches, order, shards, folder), _PIECES)
    pieces = written(pieces, "quality-model")

    def coded(kind: str, width: int) -> CodedArrays:
        return CodedArrays(folder, [tuple(r) for r in pieces.filter(F.col("kind") == kind).select("first", "name").collect()], width)

    drop_shuffles(rows.sparkSession)
    each = [F.col("sums")[i] for i in range(8)]
    sums = pieces.filter("kind = 'sums'").groupBy(each[0].alias("order"), each[1].alias("number")).agg(*[F.sum(s) for s in each[2:]]).collect()
    cuts: dict[int, dict[int, np.ndarray]] = {}
    for order, number, n1, n2, n3, n4, *_ in sums:
        cuts.setdefault(number, {})[order] = _discounts(n1, n2, n3, n4)
    numbers = {}
    for order, number, n1, n2, _, _, whole, kinds in sums:
        if order == 1:
            left = cuts[number][1] @ (0, n1, n2, kinds - n1 - n2)
            numbers[number] = cuts[number], float(whole), float(left / whole / (kinds + 1))
    return Model(known, {order: coded(f"grams{order}", 1) for order in (1, 2, 3)}, {order: coded(f"contexts{order}", 4) for order in (2, 3)}, numbers)


def _log_p(number: int, a: np.ndarray, b: np.ndarray, c: np.ndarray, model: Model) -> np.ndarray:
    """Natural logarithms of the trigrams' probabilities."""
    cuts, whole, rest = model.numbers[number]
    context, keys = gram_keys(3, number, [a, b, c])
    keys, at, back = np.unique(keys, return_index=True, return_inverse=True)
    b, c, context = b[at], c[at], context[at]

    def less(found: np.ndarray, order: int) -> np.ndarray:
        n = found[:, 0]
        return n - cuts[order][np.minimum(n, 3).astype(np.int64)]

    p = less(_found(model.grams[1], gram_keys(1, number, [c])[1])[0], 1) / whole + rest
    for order, contexts, grams in ((2, *gram_keys(2, number, [b, c])), (3, context, keys)):
        follows, known = _found(model.contexts[order], contexts)
        all_ = np.where(known, follows[:, 0], 1.0)
        back_off = follows @ (0, *cuts[order][1:]) / all_
        found = model.grams[3].find(grams)[0] if order == 3 else _found(model.grams[2], grams)[0]
        p = np.where(known, less(found, order) / all_ + back_off * p, p)
    return np.log(p)[back]


def perplexity(rows: DataFrame, model: Model) -> DataFrame:
    """Rows (id, text, lang, ...) with log_p (natural logarithm, of the tokens of the
    model of words), log_shapes (of the other), log_spelling (of the words that are not
    the language's own) and n_tokens (words and one end) instead of the text; all null
    for other languages.

    Workers map the stored tables into memory and merge each slice's sorted different
    trigrams with them, shard by shard; only the tables' names and a few sums for each
    language are broadcast. Texts stay where they are, and each is read once for both models.
    """
    fields = [f for f in rows.schema if f.name != "text"]
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = ["log_p", "log_shapes", "log_spelling"]

    def run(batches):
        model = shared.value
        readers: dict[str, tuple[list[int], Tokens | None]] = {}

        def reader(lang: str) -> tuple[list[int], Tokens | None]:
            if lang not in readers:
                if len(readers) >= READERS:
                    readers.clear()
                numbers = _numbers(lang)
                readers[lang] = numbers, Tokens(model.known, lang, StoredSpelling(model.known, lang)) if numbers[0] in model.numbers else None
            return readers[lang]

        for part, langs, texts in _by_language(batches):
            sums = np.full((3, part.num_rows), np.nan)
            lengths = np.zeros(part.num_rows, np.int64)
            for lang, own in langs.items():
                numbers, tokens = reader(lang)
                if tokens is None:
                    continue
                make_room([t for _, t in readers.values() if t])
                both, sizes, sums[2, own] = tokens.read([texts[i] for i in own])
                lengths[own] = sizes - 2
                starts = np.cumsum(sizes - 2) - (sizes - 2)
                for which, (number, ids) in enumerate(zip(numbers, both)):
                    a, b, c = _trigrams(ids, sizes)
                    logs = [_log_p(number, a[i : i + SCORED], b[i : i + SCORED], c[i : i + SCORED], model) for i in range(0, len(a), SCORED)]
                    sums[which, own] = np.add.reduceat(np.concatenate(logs), starts)
            none = lengths == 0
            kept = [part.column(i) for i, name in enumerate(part.schema.names) if name != "text"]
            more = [*[pa.array(x, pa.float64(), mask=none) for x in sums], pa.array(lengths, pa.int64(), mask=none)]
            yield pa.RecordBatch.from_arrays([*kept, *more], [*[f.name for f in fields], *names, "n_tokens"])

    own_fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
    return rows.mapInArrow(run, ", ".join([*own_fields, *[f"{n} double" for n in names], "n_tokens long"]))


def _margins(good: DataFrame, bad: DataFrame, limits: DataFrame) -> DataFrame:
    """(lang, margin) of languages with bad texts: see ``quality_scores``."""
    kinds = good.select("lang", "words", F.lit(0).alias("bad")).union(bad.select("lang", "words", F.lit(1)))
    over = kinds.join(limits, "lang").select("lang", "bad", *[(F.col("words") > F.col("words_limit") + math.log(m)).alias(f"m{i}") for i, m in enumerate(MARGINS)])
    lost = [(F.avg(F.when(F.col("bad") == 0, F.col(f"m{i}").cast("int"))) + F.avg(F.when(F.col("bad") == 1, 1 - F.col(f"m{i}").cast("int")))).alias(f"e{i}") for i in range(len(MARGINS))]
    errors = over.groupBy("lang").agg(*lost, F.sum("bad").alias("n_bad")).filter("n_bad > 0").withColumn("least", F.least(*[f"e{i}" for i in range(len(MARGINS))]))
    best = F.coalesce(*[F.when(F.col(f"e{i}") == F.col("least"), F.lit(m)) for i, m in enumerate(MARGINS)])
    return errors.select("lang", best.alias("margin"))


def _of_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows (id, ...) with one of the ids (t_id, none null), looked up by hash in
    stored arrays: texts stay where they are, however many ids there are."""
    own = F.col("t_id").cast(rows.schema["id"].dataType)
    found = sorted_arrays(written(ids.select(F.xxhash64(own).alias("key"), F.lit(1.0).alias("value")).distinct(), "quality-ids"))
    has = F.pandas_udf(lambda keys: pd.Series(_found(found, keys.to_numpy())[1]), "boolean")
    return rows.filter(F.col("id").isNotNull() & has(F.xxhash64("id")))


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    fit_docs: int | None = None, fit_chars: int | None = None, quantile: float = QUANTILE, margin: float | None = None,
) -> DataFrame:
    """One row per document: id, lang, text_hash, n_tokens, perplexity, threshold, kept.

    ``labels`` (doc_id, quality) names trusted documents: those with quality 1
    in all their rows. By a hash of the id, half of them are used to fit an
    interpolated modified Kneser-Ney trigram model (all of them, or a sample of each
    language if ``fit_docs`` or ``fit_chars`` is given, see ``sample``; ``uncovered``
    reports languages without) and all of the other half to set each language's threshold:
    the given quantile of their perplexity times a margin. Documents above their
    language's threshold are rejected.

    Two models read each text. That of words knows every word that the fitted texts
    have a few times, and charges others for their shape and spelling; so wrong
    languages, gibberish and (where a language's words have an order) shuffled text
    cost. That of shapes knows only the most frequent words; under it repetition
    and odd signs cost. ``perplexity`` is the worse of the two, that of shapes
    scaled so that both have the one threshold. ``margin`` holds for both; if none
    is given, it is MARGIN for shapes, and for words that of MARGINS with the fewest
    errors (rates of good texts lost and bad ones kept, added) on the held-out half
    of the labels, of several the least, or MARGIN without bad ones.

    The mean log probability of a document is taken with some further tokens at
    its language's trusted mean, so that one odd word does not condemn a short text.

    Documents of a language (or null) without trusted text have no perplexity or
    threshold and are kept, as are those of languages with too few to set one; null texts are empty (one token: the end); equal
    rows get equal results; no documents give no rows, no labels keep all.
    """
    rows = picked(docs, id=id_col, text=text_col, lang=lang_col).withColumn("text", whole_text("text"))
    labelled = picked(labels, id="doc_id", quality="quality").filter("id is not null").groupBy("id").agg(F.min("quality").alias("q"), F.count_if(F.col("quality").isNull()).alias("none"))
    trusted = labelled.filter("q = 1 and none = 0").select(F.col("id").alias("t_id"))
    refused = labelled.filter("q = 0 and none = 0").select(F.col("id").alias("t_id"))
    for_fit = F.pmod(F.xxhash64("t_id"), F.lit(2)) == 0
    chosen = sample(_of_ids(rows, trusted.filter(for_fit)), fit_docs, fit_chars)
    if fit_docs is not None:
        chosen = written(chosen.select("id", "text", "lang"), "quality-sample")
    model = fit(chosen, fit_chars)
    scored = perplexity(rows.select("id", "text", "lang", F.xxhash64("text").alias("text_hash")), model)
    scored = written(scored.withColumn("log_p", F.col("log_p") + F.col("log_spelling")).drop("log_spelling"), "quality-scores")
    held = scored.filter("log_p is not null").join(trusted.filter(~for_fit), F.col("id") == F.col("t_id"), "left_semi")
    means = held.groupBy("lang").agg(*[(F.sum(log) / F.sum("n_tokens")).alias(mean) for log, mean in (("log_p", "mean"), ("log_shapes", "shapes_mean"))])
    means = written(means, "quality-means")

    # Logarithms up to the end: texts without spaces are single tokens of many characters.
    def drawn(df: DataFrame) -> DataFrame:
        for log, mean, name in (("log_p", "mean", "words"), ("log_shapes", "shapes_mean", "shapes")):
            df = df.withColumn(name, -(F.col(log) + PRIOR_TOKENS * F.col(mean)) / (F.col("n_tokens") + PRIOR_TOKENS))
        return df

    enough = F.count(F.lit(1)) >= LEAST_TRUSTED
    good = drawn(held.join(means, "lang"))
    # Written, so that its size (a row a language) is known to the joins below.
    limits = written(good.groupBy("lang").agg(*[F.when(enough, F.percentile_approx(name, quantile, 10_000)).alias(f"{name}_limit") for name in ("words", "shapes")]), "quality-quantiles")
    if margin is None:
        bad = scored.filter("log_p is not null").join(refused.filter(~for_fit), F.col("id") == F.col("t_id"), "left_semi")
        limits = limits.join(_margins(good, drawn(bad.join(means, "lang")), limits), "lang", "left")
        limits = limits.withColumn("margin", F.coalesce("margin", F.lit(MARGIN)))
    else:
        limits = limits.withColumn("margin", F.lit(float(margin)))
    threshold = F.col("words_limit") + F.log("margin")
    shapes_threshold = F.col("shapes_limit") + math.log(MARGIN if margin is None else margin)
    limits = written(means.join(limits.select("lang", threshold.alias("most"), (threshold - shapes_threshold).alias("scale")), "lang"), "quality-limits")
    out = drawn(scored.join(limits, "lang", "left"))
    # Both on the words' scale, where they have one threshold.
    worse = F.greatest("words", F.col("shapes") + F.col("scale"))
    kept = F.coalesce(worse <= F.col("most"), F.lit(True))
    out = out.withColumn("perplexity", F.exp(worse)).withColumn("threshold", F.exp("most"))
    return out.select("id", "lang", "text_hash", "n_tokens", "perplexity", "threshold", kept.alias("kept"))


def uncovered(scores: DataFrame) -> DataFrame:
    """Of ``quality_scores``: languages of which nothing can be rejected (lang,
    n_docs, reason), as no text of theirs was fitted or too few are held out."""
    reason = F.when(F.max("perplexity").isNull() & F.max("scored").isNull(), "no model").otherwise("no threshold")
    scored = F.when(F.col("n_tokens").isNotNull(), 1).alias("scored")
    open_ = scores.filter("threshold is null").select("lang", "perplexity", scored)
    return open_.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), reason.alias("reason"))


def quality_kept(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    gone = quality_scores(docs, labels, id_col, text_col, lang_col).filter("not kept")
    names = [free_name(docs, n) for n in ("gone_id", "gone_lang", "gone_hash", "own_hash")]
    gone = written(gone.select(*[F.col(c).alias(n) for c, n in zip(("id", "lang", "text_hash"), names)]).distinct(), "quality-gone")
    own = (F.col(f"`{id_col}`"), F.col(f"`{lang_col}`"), F.col(names[3]))
    same = [a.eqNullSafe(F.col(n)) for a, n in zip(own, names)]
    return docs.withColumn(names[3], F.xxhash64(whole_text(text_col))).join(gone.hint("merge"), same, "left_anti").drop(names[3])
