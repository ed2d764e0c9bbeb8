"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

The tokens of either tokenizer are named by the bytes where they end. Texts are
worked on in chunks; the ends of a chunk's tokens under A and B are merged in
pieces of equal work: diagonals of the merge path are cut by binary search (merge
path partitioning: Green, McColl and Bader, 2012), so a piece is a range of A and
one of B that needs no other. A piece emits its overlaps (a link for each end that
differs from the one before) and the common ends in it; groups that go over a
border of pieces are put together from their common ends.

How many documents hold an id pair linked is counted in Spark, from one row for
each pair of a task, stored as sorted arrays in the shared folder, and looked up
by workers that map them into memory.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnlab.llm.bpe import ByteBpe, spread, text_chunks
from churnlab.llm.common import mounted, picked, shared_folder, written

#: Ends that a piece merges.
PIECE = 1 << 16
#: Bytes of text in a chunk: a worker holds some sixty times as much while it aligns one.
CHUNK_BYTES = 1 << 20
#: Different id pairs that a task holds before it hands them on.
HELD_PAIRS = 2_000_000
#: An id pair as one number: A's id, then B's, of this many bits.
BITS = 32
#: Rows of pair counts in a stored array.
STORED_ROWS = 4_000_000

SPACE = "▁"


def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the sorted ``a`` are among the first d of the merge of ``a`` and
    ``b`` (of equal ends a's first), for each diagonal d: all binary searches at once."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (low < high).any():
        middle = (low + high) >> 1
        taken = (low < high) & (a[np.minimum(middle, len(a) - 1)] <= b[np.clip(diagonals - middle - 1, 0, len(b) - 1)])
        low = np.where(taken, middle + 1, low)
        high = np.where(taken | (low >= high), high, middle)
    return low


def piece_overlaps(a: np.ndarray, b: np.ndarray, i: slice, j: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (places in a, places in b) and common ends (the same) of one piece.

    Each end that differs from the one before it in the merge ends one overlap: of
    the token that ends there and of the other side's token around it."""
    own_a, own_b = a[i], b[j]
    b_of_a = j.start + np.searchsorted(own_b, own_a, side="left")
    a_of_b = i.start + np.searchsorted(own_a, own_b, side="right")
    # An equal end of A may be the last of the piece before.
    common = (a_of_b > 0) & (a[np.maximum(a_of_b, 1) - 1] == own_b) if len(a) else np.zeros(len(own_b), bool)
    at_b = np.arange(j.start, j.stop)
    links_a = np.concatenate([np.arange(i.start, i.stop), a_of_b[~common]])
    links_b = np.concatenate([b_of_a, at_b[~common]])
    return links_a, links_b, a_of_b[common] - 1, at_b[common]


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All links and common ends of two lists of token ends over the same bytes."""
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, piece), total)
    upto_a = merge_path(a, b, diagonals)
    upto_b = diagonals - upto_a
    parts = [piece_overlaps(a, b, slice(*i), slice(*j)) for i, j in zip(zip(upto_a, upto_a[1:]), zip(upto_b, upto_b[1:]))]
    # Pieces are in order, and so are their common ends: the groups' borders.
    return tuple(np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 4


class PieceModel:
    """Ids of texts by a sentencepiece model, and the bytes that each stands for."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.n_bytes = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode(pc.fill_null(texts, "").to_pylist(), num_threads=1)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths


def _digits(size: int, end: str) -> np.ndarray:
    """The decimal digits of each id and a sign, filled up with zero bytes, as one number."""
    text = b"".join(f"{i}{end}".encode().ljust(8, b"\0") for i in range(size))
    return np.frombuffer(text, "<u8")


@dataclass(frozen=True)
class Aligned:
    """A chunk's documents: tokens and groups of each, and its links as id pairs."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    digests: list[str]
    link_doc: np.ndarray
    link_pair: np.ndarray


class Aligner:
    """Aligns chunks of texts. Ids of A are those of a space and the text, ids of B
    those of the text, whose model adds the space."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteBpe(path_a, specials_as_text=True), PieceModel(path_b)
        if not self.a.apart:
            raise ValueError(f"{path_a}: not a byte-level tokenizer without a normaliser")
        if max(len(self.a.bytes), len(self.b.bytes)) > 10_000_000:
            raise ValueError("ids of more than seven digits")
        size = max(len(self.a.bytes), len(self.b.bytes))
        self.digits = {sign: _digits(size, sign) for sign in ",|;"}

    @staticmethod
    def _sound(tokens: np.ndarray, n: np.ndarray, pieces: list[bytes], texts: list[bytes]) -> np.ndarray:
        """Which texts their tokens' bytes give back."""
        joined = list(map(pieces.__getitem__, tokens.tolist()))
        ends = np.cumsum(n).tolist()
        return np.array([b"".join(joined[a:b]) == text for a, b, text in zip([0, *ends], ends, texts)], bool)

    def align(self, texts: pa.Array, piece: int = PIECE) -> Aligned:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
        ids_a, n_a = self.a.encode(spaced)
        ids_b, n_b = self.b.encode(texts)
        whole = [b" " + t.encode() for t in texts.to_pylist()]
        sound = np.array([len(t) > 1 for t in whole], bool)
        for ids, n, pieces in ((ids_a, n_a, self.a.bytes), (ids_b, n_b, self.b.bytes)):
            sound &= self._sound(ids, n, pieces, whole)
        ids_a, n_a = ids_a[np.repeat(sound, n_a)], np.where(sound, n_a, 0)
        ids_b, n_b = ids_b[np.repeat(sound, n_b)], np.where(sound, n_b, 0)
        # Documents in a row: all end at a common end, so none shares a group with another.
        link_a, link_b, end_a, end_b = overlaps(np.cumsum(self.a.n_bytes[ids_a]), np.cumsum(self.b.n_bytes[ids_b]), piece)
        doc_of_a = np.repeat(np.arange(len(n_a)), n_a)
        n_groups = np.bincount(doc_of_a[end_a], minlength=len(n_a))
        pair = (ids_a[link_a].astype(np.uint64) << np.uint64(BITS)) | ids_b[link_b].astype(np.uint64)
        return Aligned(n_a, n_b, n_groups, self._digests(ids_a, ids_b, end_a, end_b, n_a, n_b, n_groups), doc_of_a[link_a], pair)

    def _digests(self, ids_a, ids_b, end_a, end_b, n_a, n_b, n_groups) -> list[str]:
        """SHA-256 of each document's groups, a1,a2|b1;a3|b2,b3 (none: empty)."""
        sizes_a, sizes_b = np.diff(end_a, prepend=-1), np.diff(end_b, prepend=-1)
        group_start = np.cumsum(sizes_a + sizes_b) - sizes_a - sizes_b
        at_a = spread(group_start, sizes_a)
        at_b = spread(group_start + sizes_a, sizes_b)
        out = np.empty(len(ids_a) + len(ids_b), "<u8")
        signed = self.digits[","][ids_a]
        signed[end_a] = self.digits["|"][ids_a[end_a]]
        out[at_a] = signed
        signed = self.digits[","][ids_b]
        signed[end_b] = self.digits[";"][ids_b[end_b]]
        out[at_b] = signed
        digests, at = [], 0
        for k, groups in zip((n_a + n_b).tolist(), n_groups.tolist()):
            text = out[at : at + k].tobytes().translate(None, b"\0")[:-1]
            digests.append(hashlib.sha256(text).hexdigest() if groups else "")
            at += k
        return digests


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers in four bytes each."""
    return values.astype("<u4").tobytes()


#: One row for each chunk: what its documents have, its distinct pairs in order, and
#: for each document's distinct pairs their place among these and their links.
_CHUNK = [(n, pa.list_(pa.int64())) for n in ("n_a", "n_b", "n_groups", "n_links", "n_pairs")]
_CHUNK += [("groups_sha256", pa.list_(pa.string())), ("pairs", pa.binary()), ("places", pa.binary()), ("links", pa.binary()), ("documents", pa.binary())]


@lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str, changed: tuple[int, int]) -> Aligner:
    """Kept by a worker from task to task: what is left of reading the files anew for
    each task adds up."""
    return Aligner(path_a, path_b)


def _chunks(batches, path_a: str, path_b: str, schema: pa.Schema):
    aligner = _aligner(path_a, path_b, (os.stat(path_a).st_mtime_ns, os.stat(path_b).st_mtime_ns))
    for batch in text_chunks(batches, size=CHUNK_BYTES):
        found = aligner.align(batch.column(batch.schema.get_field_index("text")))
        pairs, place = np.unique(found.link_pair, return_inverse=True)
        # (document, place) as one number: its distinct values with their numbers.
        held, links = np.unique(found.link_doc * max(1, len(pairs)) + place, return_counts=True)
        doc, place = held // max(1, len(pairs)), held % max(1, len(pairs))
        size = batch.num_rows
        row = {
            "id": batch.column(batch.schema.get_field_index("id")).to_pylist(),
            "n_a": found.n_a,
            "n_b": found.n_b,
            "n_groups": found.n_groups,
            "n_links": np.bincount(found.link_doc, minlength=size),
            "n_pairs": np.bincount(doc, minlength=size),
            "groups_sha256": found.digests,
            "pairs": pairs.astype("<u8").tobytes(),
            "places": _narrow(np.diff(place, prepend=0)),
            "links": _narrow(links),
            "documents": _narrow(np.bincount(place, minlength=len(pairs))),
        }
        yield pa.RecordBatch.from_pylist([row], schema=schema)


def _pair_rows(batches, schema: pa.Schema):
    """Distinct pairs of a task's chunks with the number of documents that hold them."""
    keys, counts, held = [], [], 0

    def summed():
        all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(all_keys, kind="stable")
        all_keys = all_keys[order]
        first = np.flatnonzero(np.diff(all_keys, prepend=all_keys[:1] ^ np.uint64(1)))
        return all_keys[first], np.add.reduceat(all_counts[order], first)

    def flush():
        k, n = summed()
        for at in range(0, len(k), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(k[at : at + 100_000].astype(np.int64)), pa.array(n[at : at + 100_000])], schema=schema)

    for batch in batches:
        for pairs, documents in zip(batch.column(0), batch.column(1)):
            k = np.frombuffer(pairs.as_py(), "<u8")
            if len(k):
                keys.append(k)
                counts.append(np.frombuffer(documents.as_py(), "<u4").astype(np.int64))
                held += len(k)
            if held > 2 * HELD_PAIRS:
                k, n = summed()
                keys, counts, held = [k], [n], len(k)
                if held > HELD_PAIRS:
                    yield from flush()
                    keys, counts, held = [], [], 0
    if keys:
        yield from flush()


def _stored(batches, folder: str):
    """A partition's sorted rows (pair, n, best) as arrays in the shared folder; the
    name is new for every attempt, and only the names handed on are read."""
    parts = list(batches)
    rows = sum(b.num_rows for b in parts)
    if rows:
        name = uuid.uuid4().hex
        os.makedirs(mounted(folder), exist_ok=True)
        for column, kind in (("pair", np.int64), ("n", np.int64), ("best", bool)):
            values = [b.column(b.schema.get_field_index(column)).to_numpy(zero_copy_only=False).astype(kind) for b in parts]
            np.save(os.path.join(mounted(folder), f"{name}-{column}.npy"), np.concatenate(values))
        first = parts[0].column(parts[0].schema.get_field_index("pair"))[0].as_py()
        yield pa.RecordBatch.from_pydict({"first": [first], "name": [name], "rows": [rows]}, schema=pa.schema([("first", pa.int64()), ("name", pa.string()), ("rows", pa.int64())]))


class PairCounts:
    """The stored arrays, mapped into memory when they are first needed."""

    def __init__(self, folder: str, names: list[tuple[int, str]]):
        self.folder, self.firsts, self.names = folder, [f for f, _ in names], [n for _, n in names]

    def find(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count, and whether it is its A id's highest, of sorted pairs that are stored."""
        n, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        cuts = np.append(np.searchsorted(pairs, np.array(self.firsts, np.int64)), len(pairs))
        for name, low, high in zip(self.names, cuts, cuts[1:]):
            if low < high:
                pair, count, top = (np.load(os.path.join(mounted(self.folder), f"{name}-{c}.npy"), mmap_mode="r") for c in ("pair", "n", "best"))
                at = np.searchsorted(pair, pairs[low:high])
                n[low:high], best[low:high] = count[at], top[at]
        return n, best


def _looked_up(batches, counts: PairCounts, schema: pa.Schema):
    """A chunk's documents with what the corpus-wide counts make of their links."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)}
            n, best = counts.find(np.frombuffer(row["pairs"].as_py(), "<u8").astype(np.int64))
            n_pairs = row["n_pairs"].values.to_numpy()
            # Places were stored as differences, modulo four bytes.
            place = np.cumsum(np.frombuffer(row["places"].as_py(), "<u4"), dtype=np.uint32)
            links = np.frombuffer(row["links"].as_py(), "<u4").astype(np.int64)
            doc = np.repeat(np.arange(len(n_pairs)), n_pairs)
            sums = [np.zeros(len(n_pairs), np.int64) for _ in range(2)]
            np.add.at(sums[0], doc, links * best[place])
            np.add.at(sums[1], doc, links * n[place])
            same = [row[f.name].values for f in schema if f.name not in ("n_best", "count_sum")]
            own = dict(zip([f.name for f in schema if f.name not in ("n_best", "count_sum")], same))
            own |= {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1])}
            yield pa.RecordBatch.from_arrays([own[f.name].cast(f.type) for f in schema], schema=schema)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """Rows (pair, n, best) over the chunks' pairs: how many documents hold the pair
    linked, and whether that is the highest of its A id's pairs (ties included)."""
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])
    rows = chunks.select("pairs", "documents").mapInArrow(lambda batches: _pair_rows(batches, schema), "pair long, n long")
    counts = written(rows.groupBy("pair").agg(F.sum("n").alias("n")), "alignment-pairs")
    # An id of A has at most as many pairs as B has ids.
    highest = counts.groupBy(F.shiftright("pair", BITS).alias("a")).agg(F.max("n").alias("highest"))
    joined = counts.withColumn("a", F.shiftright("pair", BITS)).join(highest, "a")
    return joined.select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    A is the byte-level tokenizer file ``path_a`` over a space and the text, B the
    sentencepiece model ``path_b`` over the text. Groups end where tokens of both end;
    links are all pairs of a token of A and one of B that share bytes. ``n_best``
    counts links whose id pair is held by most documents of all pairs of its A id
    (ties included), ``count_sum`` sums over links how many documents hold the pair.

    Texts that are null or empty, or that either tokenizer does not give back, have no
    tokens: zeros and an empty digest. Texts are aligned whole. A null id is a document
    like any other, repeated rows are documents of their own and count each. No
    documents give no rows.
    """
    from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

    own = picked(docs, id=id_col, text=text_col)
    id_type = to_arrow_type(own.schema["id"].dataType)
    schema = pa.schema([("id", pa.list_(id_type)), *_CHUNK])
    kind: StructType = from_arrow_schema(schema)
    chunks = written(own.mapInArrow(lambda batches: _chunks(batches, path_a, path_b, schema), kind), "alignment-chunks")
    counts = written(pair_counts(chunks), "alignment-counts")
    # Sorted ranges of pairs, each an array; one short row of each comes to the driver.
    folder = shared_folder(docs.sparkSession, "alignment-arrays")
    parts = max(1, -(-counts.count() // STORED_ROWS))
    ranged = counts.repartitionByRange(parts, "pair").sortWithinPartitions("pair")
    stored = ranged.mapInArrow(lambda batches: _stored(batches, folder), "first long, name string, rows long")
    table = PairCounts(folder, sorted((r["first"], r["name"]) for r in stored.collect()))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    out = pa.schema([("id", id_type), *[(n, pa.int64()) for n in names], ("groups_sha256", pa.string())])
    return chunks.drop("documents").mapInArrow(lambda batches: _looked_up(batches, table, out), from_arrow_schema(out))
