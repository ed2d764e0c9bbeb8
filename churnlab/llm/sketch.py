"""Document fingerprints: bottom-k sketches of word shingles."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnlab.llm.common import neighbour_runs, picked

SHINGLE_WORDS = 5
#: Hashes kept of a document: the standard error of a resemblance r is sqrt(r(1-r)/SKETCH_SIZE).
SKETCH_SIZE = 256
SPACE = float(1 << 64)


class Shingles:
    """Hashes of word shingles; remembers a bounded number of word hashes."""

    KEEP = 1_000_000

    def __init__(self, words_per_shingle: int = SHINGLE_WORDS):
        self.width = words_per_shingle
        self.met: dict[str, int] = {}

    def hashes(self, text: str) -> np.ndarray:
        """One hash per place: of each run of ``width`` words, or of all words if there are fewer."""
        words = text.split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.met) > self.KEEP:
            self.met = {}
        met = self.met
        for w in words:
            if w not in met:
                met[w] = xxhash.xxh64_intdigest(w)
        each = np.fromiter(map(met.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        out = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            out = (out ^ each[i : len(words) - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        return out ^ (out >> np.uint64(32))

    def sketch(self, text: str, size: int = SKETCH_SIZE) -> np.ndarray:
        found = self.hashes(text)
        if len(found) > 8 * size:
            # The smallest ones among few distinct ones: halve the range until it is enough.
            limit = np.uint64(min(int(SPACE) - 1, int(4 * size / len(found) * SPACE)))
            low = np.unique(found[found <= limit])
            if len(low) >= size:
                return low[:size]
        return np.unique(found)[:size]


def merge(a: np.ndarray, b: np.ndarray, size: int = SKETCH_SIZE) -> np.ndarray:
    """The sketch of two parts together."""
    return np.unique(np.concatenate([a, b]))[:size]


def distinct(a: np.ndarray, size: int = SKETCH_SIZE) -> float:
    """Estimated number of different shingles: exact if the sketch holds all of them."""
    return float(len(a)) if len(a) < size else (size - 1) * SPACE / (float(a[size - 1]) + 1)


def resemblance(a: np.ndarray, b: np.ndarray, size: int = SKETCH_SIZE) -> float:
    """Estimated Jaccard similarity of the shingle sets; two empty sets are alike."""
    both = merge(a, b, size)
    if not len(both):
        return 1.0
    return len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), both, assume_unique=True)) / len(both)


def containment(a: np.ndarray, b: np.ndarray, size: int = SKETCH_SIZE) -> float:
    """Estimated part of a's shingles that b has too; of none, all."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, size) * distinct(merge(a, b, size), size) / distinct(a, size))


def written_form(sketch: np.ndarray) -> str:
    """A sketch as text: its hashes, big-endian and ascending, in base 64."""
    return base64.b64encode(sketch.astype(">u8").tobytes()).decode()


def read_form(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64)


def sketched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SKETCH_SIZE, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: id and sketch (ascending hashes with the sign bit
    flipped, so that they sort as longs). Null and empty texts have an empty
    sketch; ids and repeated rows are passed through."""

    def run(batches):
        shingles = Shingles(words_per_shingle)
        for batch in batches:
            rows = [(shingles.sketch(t or "", size) ^ np.uint64(1 << 63)).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int64()))], ["id", "sketch"])

    rows = picked(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, sketch array<long>")


def merged(sketches: DataFrame, key: str, size: int = SKETCH_SIZE) -> DataFrame:
    """The sketch of all documents of a key, from rows (key, sketch): the
    ``size`` smallest different hashes. Partial sums keep at most ``size`` hashes
    of a key for each task, so a key may hold any number of rows."""
    hashes = sketches.select(F.col(key).alias("key"), F.explode("sketch").alias("hash")).distinct()
    rank = F.row_number().over(Window.partitionBy("key").orderBy("hash"))
    lowest = hashes.withColumn("rank", rank).filter(F.col("rank") <= size)
    found = lowest.groupBy("key").agg(F.array_sort(F.collect_list("hash")).alias("sketch"))
    keys = sketches.select(F.col(key).alias("key")).distinct()
    joined = keys.alias("k").join(found.alias("f"), F.col("k.key").eqNullSafe(F.col("f.key")), "left")
    return joined.select(F.col("k.key").alias(key), F.coalesce("f.sketch", F.array().cast("array<long>")).alias("sketch"))


def _pairs(batches, size: int, words_per_shingle: int):
    """Rows (run, place, id, text), runs one after the other and sorted: each row
    of a run's own with the row after it."""
    shingles = Shingles(words_per_shingle)

    def marked(row: dict) -> dict:
        text = row["text"] or ""
        return row | {"text": text, "sketch": shingles.sketch(text, size)}

    def result(own: dict, after: dict) -> dict:
        half = len(own["text"]) // 2
        edited = own["text"][: len(own["text"]) - half] + after["text"][:half]
        sketch = shingles.sketch(edited, size)
        return {
            "id": own["id"],
            "n_chars": len(own["text"]),
            "edited_sha256": hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(),
            "fingerprint": written_form(own["sketch"]),
            "edited_fingerprint": written_form(sketch),
            "near_edited": resemblance(own["sketch"], sketch, size),
            "near_next": resemblance(own["sketch"], after["sketch"], size),
        }

    last = None
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
            row = marked(row)
            if last and not last["place"]:
                out.append(result(last, row if last["run"] == row["run"] else last))
            last = row
        if out:
            yield _as_batch(out, batch)
    if last and not last["place"]:
        yield _as_batch([result(last, last)], batch)


def _as_batch(rows: list[dict], batch: pa.RecordBatch) -> pa.RecordBatch:
    text, number = pa.string(), pa.float64()
    kinds = {"id": batch.schema.field("id").type, "n_chars": pa.int64(), "edited_sha256": text, "fingerprint": text, "edited_fingerprint": text, "near_edited": number, "near_next": number}
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(kinds.items())))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SKETCH_SIZE, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """One row per document: its sketch, that of an edited text (its second half
    replaced by the start of the next document, by descending id, the first
    after the last), and the resemblance to the edited text and to the next.

    Ids are whole numbers. Null texts are empty; null ids come last; rows of one
    id are ordered by text hash, and the next of the last of them is the next
    id's first; a lone document is its own next; no documents give no rows.

    Documents are dealt out in runs of consecutive ids, sorted, each followed by
    the head of the next run, so one shuffle of the texts brings every document
    next to its successor, and each text is sketched once.
    """
    rows = picked(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    # Descending ids, null last, as an ascending key.
    rows = rows.withColumn("order", F.when(F.col("id").isNull(), F.lit((1 << 63) - 1)).otherwise(F.bitwise_not(F.col("id").cast("long"))))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = neighbour_runs(rows, "order", parts, wrap=True)
    runs = runs.withColumn("tie", F.xxhash64("text")).sortWithinPartitions("run", "place", "order", "tie").select("run", "place", "id", "text")
    out = f"id {rows.schema['id'].dataType.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return runs.mapInArrow(lambda batches: _pairs(batches, size, words_per_shingle), out)
