"""Hard-negative mining by threshold joins of anchors against all vectors, in blocks.

Vectors are packed into blocks, each a small inverted index: their components by
dimension. A dimension of a vector is left out of the index where the norm of its
components from there on, times the longest anchor, stays under the threshold: no
pair can reach it by those alone. Scores are accumulated over the index dimension
by dimension; pairs whose partial score and remaining norms stay under the
anchor's threshold are dropped, the others are completed. Each round of joins is
a Spark job over the anchors whose windows are not filled yet, with lower
thresholds than the one before: these are written once to the shared folder, and
every block's task reads them there. No table is broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnlab.llm.common import mounted, picked, shared_folder, written
from churnlab.operators.core import union_all

#: Vectors and anchors in a block, and blocks of vectors in a file.
VECTORS, ANCHORS, BLOCKS = 8192, 512, 8
#: Pairs whose scores are completed at a time.
PAIRS = 1 << 16
#: Dimensions that are accumulated between two prunings.
SEGMENT = 16
#: Thresholds of the rounds: for positives as shares of the anchor's norm times the
#: longest vector's (None: no threshold), for negatives as shares of the window,
#: counted from its upper end.
POSITIVE_STEPS: tuple[float | None, ...] = (0.5, 0.3, None)
NEGATIVE_STEPS: tuple[float, ...] = (1 / 16, 1 / 4, 1.0)
#: A score that no pair of vectors falls short of.
LOWEST = -(1 << 62)


def scaled(vector: str, factor: float) -> Column:
    """Components as whole numbers, floor(factor * x); null where the vector or a
    component is null or not finite."""
    values = F.col(vector).cast("array<double>")
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(sound, F.transform(values, lambda x: F.floor(x * factor)))


def _kind(matrix: np.ndarray) -> int:
    """Bytes of a component: two where that is enough."""
    return 2 if not matrix.size or np.abs(matrix).max() < 1 << 15 else 8


def _matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of components, short ones filled up with zeros."""
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), dims), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = lists.flatten().to_numpy()
    return out


def _blocks(batches, dims: int, rows: int, extra: list[str], schema: pa.Schema):
    """Rows packed into blocks of at most ``rows``; ``extra`` columns as arrays of longs."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            matrix = _matrix(part.column("v"), dims)
            wide = _kind(matrix)
            longs = {c: part.column(c).to_numpy(zero_copy_only=False).astype("<i8").tobytes() for c in ["id", "label", *extra]}
            row = {"n": part.num_rows, "ids": longs["id"], "labels": longs["label"], "vectors": matrix.astype(f"<i{wide}").tobytes(), "wide": wide}
            yield pa.RecordBatch.from_pylist([row | {c: longs[c] for c in extra}], schema=schema)


def packed(rows: DataFrame, dims: int, size: int, extra: list[str] = []) -> DataFrame:
    """Rows (id, label, v, extra) as blocks."""
    from pyspark.sql.pandas.types import from_arrow_schema

    binary = [(c, pa.binary()) for c in extra]
    schema = pa.schema([("n", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()), ("vectors", pa.binary()), ("wide", pa.int32()), *binary])
    kind: StructType = from_arrow_schema(schema)
    return rows.select("id", "label", "v", *extra).mapInArrow(lambda batches: _blocks(batches, dims, size, extra, schema), kind)


def exact_scores(anchors: np.ndarray, vectors: np.ndarray, a: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of the pairs (anchors[a], vectors[v]) of whole numbers, exactly."""
    most = float(np.abs(anchors).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * anchors.shape[1]
    if most >= 1 << 62:
        anchors, vectors = anchors.astype(object), vectors.astype(object)
        return (anchors[a] * vectors[v]).sum(axis=1)
    if most < 1 << 53:
        anchors, vectors = anchors.astype(float), vectors.astype(float)
    parts = [np.einsum("ij,ij->i", anchors[a[i : i + PAIRS]], vectors[v[i : i + PAIRS]]) for i in range(0, len(a), PAIRS)]
    return np.concatenate(parts).astype(np.int64)


class Index:
    """A block of vectors by dimension, the ones with the most energy first, without
    the dimensions that suffix-norm bounds cover."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.argsort(-(vectors.astype(float) ** 2).sum(axis=0), kind="stable")
        self.vectors = vectors[:, self.order]
        squares = self.vectors.astype(float) ** 2
        starts = range(0, max(1, vectors.shape[1]), SEGMENT)
        #: Norms of what follows the start of each segment.
        self.rest = np.sqrt(np.stack([squares[:, s:].sum(axis=1) for s in starts] + [np.zeros(len(vectors))]))
        self.by_dimension = np.ascontiguousarray(self.vectors.T.astype(float))

    def candidates(self, anchors: np.ndarray, least: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (anchor, vector) that may score ``least`` or more, of the allowed ones.

        Bounds are given a relative slack of 1e-9, far above rounding errors."""
        own = anchors[:, self.order].astype(float)
        segments = len(self.rest) - 1
        rest = np.sqrt(np.stack([(own[:, s * SEGMENT :] ** 2).sum(axis=1) for s in range(segments + 1)]))
        longest = float(rest[0].max(initial=0))
        goal = least.astype(float) - 1e-9 * (1.0 + longest * float(self.rest[0].max(initial=0)))
        lowest = goal.min(initial=np.inf)
        alive = allowed & (rest[0][:, None] * self.rest[0] >= goal[:, None])
        held = np.flatnonzero(alive.any(axis=0))
        alive, partial = alive[:, held], np.zeros((len(own), len(held)))
        for s in range(segments):
            # Only vectors in the index here: what follows of the others reaches no threshold alone.
            on = np.flatnonzero(longest * self.rest[s][held] >= lowest)
            if not len(on):
                break
            part = slice(s * SEGMENT, (s + 1) * SEGMENT)
            if len(on) == len(held):
                on = slice(None)
            partial[:, on] += own[:, part] @ self.by_dimension[part][:, held[on]]
            alive[:, on] &= partial[:, on] + rest[s + 1][:, None] * self.rest[s + 1][held[on]] >= goal[:, None]
            kept = np.flatnonzero(alive.any(axis=0))
            if len(kept) < len(held):
                alive, partial, held = alive[:, kept], partial[:, kept], held[kept]
        a, v = np.nonzero(alive)
        return a, held[v]


def _long(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8")


def _components(row: dict) -> np.ndarray:
    return np.frombuffer(row["vectors"], f"<i{row['wide']}").reshape(row["n"], -1).astype(np.int64)


def _rows(batches):
    """Rows of Arrow batches, one at a time in memory."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _top(groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group, by falling score, then rising id."""
    order = np.lexsort((ids, -scores, groups)) if scores.dtype != object else np.array(sorted(range(len(ids)), key=lambda i: (groups[i], -scores[i], ids[i])), np.int64)
    sorted_groups = groups[order]
    first = np.searchsorted(sorted_groups, sorted_groups, side="left")
    return order[np.arange(len(order)) - first < k]


FOUND = pa.schema([("key", pa.int64()), ("window", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])


def _joined(batches, sets: list[str], same: bool, k: int):
    """For each window of each anchor its first ``k`` vectors in a block, for rows of
    blocks of vectors (n, ids, ...): of the anchor's label (``same``) or of others, and
    of another id. ``sets`` are files of blocks of windows (n, ids, ..., low, high)."""
    for block in _rows(batches):
        vectors = _components(block)
        index, ids, labels = Index(vectors), _long(block["ids"]), _long(block["labels"])
        for row in (row for path in sets for row in _rows(pq.ParquetFile(path).iter_batches(16))):
            key, window, low, high = (_long(row[c]) for c in ("key", "window", "low", "high"))
            # The windows of one anchor stand together: it is joined once, at the lowest threshold.
            anchor, of = np.unique(key, return_inverse=True)
            first = np.searchsorted(of, np.arange(len(anchor)))
            anchors = _components(row)[first]
            least = np.full(len(anchor), 1 << 62, np.int64)
            np.minimum.at(least, of, low)
            label, own = _long(row["labels"])[first], _long(row["ids"])[first]
            allowed = (label[:, None] == labels) == same
            allowed &= own[:, None] != ids
            a, v = index.candidates(anchors, least, allowed)
            if not len(a):
                continue
            score = exact_scores(anchors, vectors, a, v)
            out = []
            for nth in range(int(np.bincount(of).max())):
                at = np.minimum(first + nth, len(key) - 1)
                inside = ((first + nth < len(key)) & (of[at] == np.arange(len(anchor))))[a] & (score >= low[at][a]) & (score <= high[at][a])
                i = np.flatnonzero(inside)
                i = i[_top(a[i], score[i], ids[v[i]], k)]
                out.append((key[at][a[i]], window[at][a[i]], ids[v[i]], score[i]))
            arrays = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays(arrays, schema=FOUND)


def _join(blocks: DataFrame, windows: DataFrame, n_sets: int, dims: int, same: bool, k: int) -> DataFrame:
    """One threshold join: the first ``k`` vectors of every window (key, window, id,
    label, v, at, high), in rows (key, window, id, score, rank).

    Windows are packed into sets, which are written once; the task of a block reads
    all sets, so neither is copied. At most ``k`` rows of a block come out for a window."""
    from pyspark.sql.pandas.types import from_arrow_schema

    near = windows.withColumn("low", F.col("at")).coalesce(n_sets).sortWithinPartitions("key", "window")
    stored = written(packed(near, dims, ANCHORS, ["key", "window", "low", "high"]), "negatives-sets")
    sets = sorted(mounted(path) for path in stored.inputFiles())
    found = blocks.mapInArrow(lambda batches: _joined(batches, sets, same, k), from_arrow_schema(FOUND))
    order = Window.partitionBy("key", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _rounds(blocks: DataFrame, dims: int, windows: DataFrame, n_windows: int, thresholds: list[Column], same: bool, k: int, name: str) -> DataFrame:
    """The first ``k`` vectors of every window [low, high], found by joins with the
    given thresholds, each lower than the one before and the last one at most the
    window's low end. A window is filled when ``k`` vectors reach the threshold: none
    below it can come before them."""
    n_sets = max(1, n_windows // (4 * ANCHORS))
    done, open_ = [], windows
    for step, threshold in enumerate(thresholds):
        now = open_.withColumn("at", F.greatest("low", threshold))
        found = written(_join(blocks, now, n_sets, dims, same, k), f"negatives-{name}")
        if step == len(thresholds) - 1:
            done.append(found)
            break
        counts = found.groupBy("key", "window").agg(F.count(F.lit(1)).alias("n"))
        state = now.join(counts.hint("merge"), ["key", "window"], "left").withColumn("closed", (F.coalesce("n", F.lit(0)) == k) | (F.col("at") <= F.col("low")))
        done.append(found.join(state.filter("closed").select("key", "window").hint("merge"), ["key", "window"], "left_semi"))
        open_ = written(state.filter("not closed").drop("at", "n", "closed"), f"negatives-{name}-open")
        if open_.isEmpty():
            break
    return union_all(done)


def _per_cent(score: Column, share: int) -> Column:
    """``share`` per cent of a score, exactly (the product may exceed a long)."""
    return score.cast("decimal(20,0)") * F.lit(share).cast("decimal(4,0)") / F.lit(100).cast("decimal(3,0)")


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    factor: float = 256,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of whole components, floor(factor * x). An anchor (a row
    for which ``is_anchor``, a condition on the columns ``id`` and ``label``, holds) has
    as positives the first ``positives`` rows of its label with another id, by falling
    score, then rising id (all, if fewer). For each, the first ``negatives`` rows of
    another label follow that have ``low`` to ``high`` per cent of its score, in that
    order; a positive of negative score has none, and a positive without any gives no row.

    Rows with a null id, label or vector, or a component that is null or not finite, take
    no part. Vectors shorter than the longest count as filled up with zeros. Repeated rows
    take part as often as they occur: as anchors, positives and negatives. Scores must fit
    a long. No rows give no rows. The shared folder has to be mounted on every machine.
    """
    own = picked(rows, id=id_col, label=label_col, vector=vector_col)
    own = own.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), scaled("vector", factor).alias("v"))
    own = own.filter("id is not null and label is not null and v is not null")
    # Numbers of rows have to stay what they are: they are written.
    own = written(own.withColumn("key", F.monotonically_increasing_id()), "negatives-rows")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    dims, longest, n_anchors = own.agg(F.max(F.size("v")), F.max(norm), F.count_if(is_anchor)).first()
    dims, longest = max(1, dims or 0), longest or 0.0
    # Small files, so that Spark can deal few blocks to a task.
    folder = shared_folder(rows.sparkSession, "negatives-blocks")
    packed(own, dims, VECTORS).write.option("maxRecordsPerFile", BLOCKS).parquet(folder)
    blocks = rows.sparkSession.read.parquet(folder)

    anchors = own.filter(is_anchor)
    windows = anchors.select("key", F.lit(0).cast("long").alias("window"), "id", "label", "v", F.lit(LOWEST).alias("low"), F.lit(-LOWEST).alias("high"))
    steps = [F.lit(LOWEST) if s is None else F.floor(norm * longest * s) for s in POSITIVE_STEPS]
    near = _rounds(blocks, dims, windows, n_anchors, steps, True, positives, "positives")
    near = written(near.select("key", F.col("rank").cast("long").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-near")

    score = F.col("positive_score")
    ends = [F.ceil(_per_cent(score, low)).cast("long").alias("low"), F.floor(_per_cent(score, high)).cast("long").alias("high")]
    bounds = near.select("key", "window", *ends).filter("low <= high")
    windows = anchors.select("key", "id", "label", "v").join(bounds.hint("merge"), "key")
    steps = [F.col("high") - F.floor((F.col("high") - F.col("low")) * s).cast("long") for s in NEGATIVE_STEPS]
    far = _rounds(blocks, dims, windows, n_anchors * positives, steps, False, negatives, "negatives")
    far = far.select("key", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    found = far.join(near.hint("merge"), ["key", "window"]).join(anchors.select("key", F.col("id").alias("anchor_id")).hint("merge"), "key")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
