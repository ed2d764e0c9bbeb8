"""SimHash near-dedup with a bit-sliced comparison of fingerprints."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import connected, free_name, picked, written

SHINGLE_WORDS = 3
HASH_SEED = 42
MAX_BITS = 2
#: Fingerprints of one bucket that are compared bit-sliced; beyond, see ``near_edges``.
BUCKET_ROWS = 1024
CHUNK_ROWS = 1 << 16


def simhash(text: str | None, words_per_shingle: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> int:
    """64-bit SimHash of the word shingles of a text (null: empty, 0)."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < words_per_shingle:
        words, width = [b" ".join(words)], 1
    else:
        width = words_per_shingle
    n = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    shingles = words if width == 1 else map(b" ".join, zip(*(words[i:] for i in range(width))))
    hashes = np.fromiter((digest(s, seed) for s in shingles), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def simhash_column(text: Column, words_per_shingle: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> Column:
    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        values = np.array([simhash(t, words_per_shingle, seed) for t in texts], np.uint64)
        return pd.Series(values.view(np.int64))

    return fingerprint(text)


def hex_digits(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


class Planes:
    """Fingerprints as 64 vertical bit planes: word w of plane p holds bit p of
    the fingerprints 64*w to 64*w+63."""

    def __init__(self, values: np.ndarray):
        self.words = -(-len(values) // 64)
        # A spare word at the end, so that shifted reads stay inside.
        padded = np.zeros((self.words + 1) * 64, np.uint64)
        padded[: len(values)] = values
        bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        self.planes = np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)

    def shifted(self, plane: int, words: np.ndarray, by: int) -> np.ndarray:
        """Words of a plane, read ``by`` fingerprints further on."""
        whole, rest = divmod(by, 64)
        row = self.planes[plane]
        at = np.minimum(words + whole, self.words)
        low = row[at]
        if not rest:
            return low
        return (low >> np.uint64(rest)) | (row[np.minimum(at + 1, self.words)] << np.uint64(64 - rest))

    def within(self, lanes: np.ndarray, words: np.ndarray, by: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the asked lanes differ in at most ``radius`` bits.

        Lane i of word w compares fingerprints 64*w+i and 64*w+i+by. The number
        of differing bits of 64 lanes is kept in carry-save form: one word per
        binary digit, and one that remembers an excess. A word is abandoned
        once all of its lanes are over the radius.
        """
        digits = [np.zeros(len(words), np.uint64) for _ in range(radius.bit_length())]
        for plane in range(64):
            carry = self.planes[plane][words] ^ self.shifted(plane, words, by)
            for i, digit in enumerate(digits):
                digits[i], carry = digit ^ carry, digit & carry
            # Radius 2^k-1 is exceeded by a carry out of the last digit, any other
            # before the counter overflows, as lanes over it are masked for good.
            lanes = lanes & ~(carry if radius + 1 == 1 << len(digits) else _greater(digits, radius))
            if plane % 4 == 3:
                alive = np.flatnonzero(lanes)
                if not len(alive):
                    return lanes[:0], words[:0]
                if len(alive) < len(words):
                    lanes, words, digits = lanes[alive], words[alive], [d[alive] for d in digits]
        return lanes, words


def _greater(digits: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter, given as binary digits, is greater than ``radius``."""
    greater, equal = np.zeros_like(digits[0]), ~np.zeros_like(digits[0])
    for i in reversed(range(len(digits))):
        if radius >> i & 1:
            equal = equal & digits[i]
        else:
            greater, equal = greater | (equal & digits[i]), equal & ~digits[i]
    return greater


def _roots(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    up = parent[nodes]
    while True:
        higher = parent[up]
        if np.array_equal(higher, up):
            return up
        up = higher


def bucket_stars(keys: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Compare the fingerprints that share a key; rows come sorted by key.

    Returns (fingerprint, root) for each fingerprint that is linked: the links
    inside a bucket are united as they are found, and only one edge per
    fingerprint leaves, never all pairs.
    """
    n = len(values)
    planes = Planes(values)
    parent = np.arange(n)
    ends = np.searchsorted(keys, keys, "right")  # first row after a row's bucket
    by = 1
    while True:
        paired = np.flatnonzero(np.arange(n) + by < ends)
        if not len(paired):
            break
        lanes = np.zeros(planes.words, np.uint64)
        words, at = np.unique(paired >> 6, return_inverse=True)
        np.bitwise_or.at(lanes, words[at], np.uint64(1) << (paired & 63).astype(np.uint64))
        found, where = planes.within(lanes[words], words, by, radius)
        if len(where):
            bits = np.unpackbits(found.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            word, lane = np.nonzero(bits)
            left = where[word] * 64 + lane
            right = left + by
            while len(left):
                left, right = _roots(parent, left), _roots(parent, right)
                apart = left != right
                left, right = left[apart], right[apart]
                np.minimum.at(parent, np.maximum(left, right), np.minimum(left, right))
        by += 1
    roots = _roots(parent, np.arange(n))
    linked = roots != np.arange(n)
    return values[linked], values[roots[linked]]


def _compare(batches, radius: int):
    """mapInArrow: rows (bucket, fp) sorted by bucket; whole buckets are compared at a time."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    kept_keys, kept_values, held = [], [], 0

    def compared(keys, values):
        a, b = bucket_stars(keys, values, radius)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

    for batch in batches:
        kept_keys.append(batch.column(0).to_numpy())
        kept_values.append(batch.column(1).to_numpy().view(np.uint64))
        held += batch.num_rows
        if held < CHUNK_ROWS:
            continue
        keys, values = np.concatenate(kept_keys), np.concatenate(kept_values)
        cut = int(np.searchsorted(keys, keys[-1], "left"))  # the last bucket may go on
        kept_keys, kept_values, held = [keys[cut:]], [values[cut:]], len(keys) - cut
        if cut:
            yield compared(keys[:cut], values[:cut])
    if held:
        yield compared(np.concatenate(kept_keys), np.concatenate(kept_values))


def near_edges(fingerprints: DataFrame, radius: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints (column fp) at most
    ``radius`` bits apart: of two linked fingerprints both are reached.

    Candidates: the 64 bits are cut into radius+2 blocks; two fingerprints
    within the radius agree on at least two whole blocks, so each pair of blocks
    is a table of buckets, and nothing is missed. Buckets of up to
    ``bucket_rows`` fingerprints are compared bit-sliced. A larger bucket (a
    crowd of near copies) is not compared pairwise but takes an exact way whose
    cost is linear: two fingerprints are within ``radius`` bits exactly if they
    share a point that lies at most ceil(radius/2) bits from one and
    floor(radius/2) bits from the other, so every fingerprint is put down under
    itself and all points that near. For radius 2 that are 65 points each with
    at most 65 fingerprints, whatever the crowd's size.
    """
    blocks = radius + 2
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [sum(((1 << edges[i + 1]) - (1 << edges[i])) for i in pair) for pair in combinations(range(blocks), 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    buckets = fingerprints.select("fp", F.explode(F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(signed)])).alias("bucket"))
    crowds = written(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket_rows).select("bucket"), "crowds")
    usual = buckets.join(crowds, "bucket", "left_anti").select("bucket", "fp")
    dealt = usual.repartition("bucket").sortWithinPartitions("bucket")
    found = dealt.mapInArrow(lambda batches: _compare(batches, radius), "a long, b long")
    if crowds.isEmpty():
        return found
    return found.union(_crowd_edges(buckets.join(crowds, "bucket", "left_semi").select("fp").distinct(), radius))


def _crowd_edges(crowd: DataFrame, radius: int) -> DataFrame:
    far, near = -(-radius // 2), radius // 2
    points = [(0, 0)]  # (mask, bits)
    for bits in range(1, far + 1):
        points += [(sum(1 << b for b in chosen), bits) for chosen in combinations(range(64), bits)]
    signed = F.array(*[F.struct(F.lit(m - (1 << 64) if m >> 63 else m).alias("mask"), F.lit(bits).alias("bits")) for m, bits in points])
    rows = crowd.select("fp", F.explode(signed).alias("p")).select("fp", F.col("fp").bitwiseXOR(F.col("p.mask")).alias("point"), F.col("p.bits").alias("bits"))
    if far == near:
        # At most 65 fingerprints (radius 2) lie this near to a point.
        stars = rows.groupBy("point").agg(F.collect_list("fp").alias("fps"), F.min("fp").alias("root")).filter(F.size("fps") > 1)
        return stars.select(F.explode("fps").alias("a"), F.col("root").alias("b")).filter("a <> b").distinct()
    inner = rows.filter(F.col("bits") <= near).select(F.col("fp").alias("b"), "point")
    return rows.select(F.col("fp").alias("a"), "point").join(inner, "point").filter("a <> b").select("a", "b").distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = SHINGLE_WORDS, radius: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: id, fp (SimHash as a signed long), component.

    Texts are lower-cased in A-Z, cut into words at white space, and
    fingerprinted over their word shingles (XXH64); a bit is set if it is set in
    over half of the shingle hashes. Documents are linked if their fingerprints
    differ in at most ``radius`` bits; ``component`` is the smallest id that can
    be reached over links. Documents of one fingerprint are folded into one
    before the search, so a crowd of copies costs one fingerprint.

    Null and empty texts have fingerprint 0 and are linked like any other; a
    component of documents without any id has a null component; repeated rows
    come out as often as they came in; no documents give no rows.
    """
    rows = picked(docs, id=id_col, text=text_col)
    marked = written(rows.select("id", simhash_column(F.col("text"), words_per_shingle).alias("fp")), "simhash")
    lowest = written(marked.groupBy("fp").agg(F.min("id").alias("low")), "fingerprints")
    groups = written(connected(near_edges(lowest.select("fp"), radius, bucket_rows)).withColumnRenamed("node", "fp"), "components")
    ids = lowest.join(groups, "fp", "left").select("fp", "low", F.coalesce("component", "fp").alias("root"))
    smallest = ids.groupBy("root").agg(F.min("low").alias("component"))
    resolved = written(ids.join(smallest, "root").select("fp", "component"), "smallest")
    return marked.join(resolved, "fp").select("id", "fp", "component")


def near_kept(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` of which one document of each group stays: that with
    the smallest id. Rows without an id, which no decision can name, stay."""
    groups = near_groups(docs, id_col, text_col, words_per_shingle, radius)
    gone_id = free_name(docs, "gone_id")
    gone = written(groups.filter("id <> component").select(F.col("id").alias(gone_id)).distinct(), "near-gone")
    return docs.join(gone.hint("merge"), F.col(f"`{id_col}`") == F.col(gone_id), "left_anti")
