"""Packing documents into training sequences as a cutting-stock problem.

Documents of more ids than a sequence holds are cut into full sequences and a
rest. The histogram of the rests' lengths (at most as many rows as a sequence has
places, whatever the corpus) is packed by a linear program over patterns of
lengths, solved by column generation: a knapsack by dynamic programming finds the
pattern that improves it most. Patterns are rounded to whole numbers of sequences
and given to the documents by their rank within their length, in Spark; no
document, and no list of documents, comes to the driver.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from churnlab.llm.bpe import ByteBpe, spread, text_chunks
from churnlab.llm.common import picked, written

#: Ids in a full sequence, and the id that ends a document.
SEQUENCE, END = 1024, 0
#: A token of a document that may be cut costs this share more than one that is
#: kept whole: so much padding is accepted to keep documents whole.
CUT_COST = 0.01
#: The linear program is solved to this share of the number of tokens.
GAP = 1e-4
#: Pivots after which the best packing found so far is taken.
PIVOTS = 3_000
#: Pieces ranked in one group.
SLICE_ROWS = 20_000

Pattern = dict[int, int]


def full_tokens(total: int, sequence: int) -> int:
    """Places that a sequence with ``total`` ids takes: those of a full one, except
    that a power of two is not padded."""
    return total if total & (total - 1) == 0 else sequence


def filled(left: dict, first: int, sequence: int) -> Pattern:
    """A pattern with a piece of length ``first`` and then the longest that fit and
    of which there are any left."""
    pattern, room = {first: 1}, sequence - first
    for n in sorted((n for n in left if n <= room), reverse=True):
        k = min(int(left[n]) - pattern.get(n, 0), room // n)
        if k > 0:
            pattern[n] = pattern.get(n, 0) + k
            room -= k * n
    return pattern


def _cost(pattern: Pattern, sequence: int) -> int:
    return full_tokens(sum(n * k for n, k in pattern.items()), sequence)


def _first_basis(lengths: np.ndarray, counts: np.ndarray, sequence: int) -> dict[int, tuple[Pattern | None, float]]:
    """A column for every length with its amount, a feasible basis: a pattern that
    uses the length up, longest first, or (None) its pieces that may be cut. In the
    order in which the lengths are used up."""
    left = dict(zip(map(int, lengths), map(float, counts)))
    basis: dict[int, tuple[Pattern | None, float]] = {}
    while left:
        longest = max(left)
        pattern = filled(left, longest, sequence)
        tokens = sum(n * k for n, k in pattern.items())
        if full_tokens(tokens, sequence) > tokens * (1 + CUT_COST):
            basis[longest] = (None, left.pop(longest))
            continue
        used_up = min(pattern, key=lambda n: (left[n] / pattern[n], n))
        amount = left[used_up] / pattern[used_up]
        basis[used_up] = (pattern, amount)
        for n, k in pattern.items():
            left[n] -= amount * k
        del left[used_up]
        for n in [n for n in pattern if n in left and left[n] < 1]:
            # What is left of these is less than a piece.
            basis[n] = (None, max(left.pop(n), 0.0))
    return basis


def best_patterns(lengths: np.ndarray, worth: np.ndarray, sequence: int) -> list[Pattern]:
    """Patterns that cost less than their pieces are worth, best first: for every
    length the best one with a piece of it. The pricing problem: the best worth of
    every exact total by dynamic programming."""
    best = np.full(sequence + 1, -np.inf)
    last = np.full(sequence + 1, -1)
    best[0] = 0.0
    upto = np.searchsorted(lengths, np.arange(sequence + 1), side="right")
    for total in range(int(lengths[0]), sequence + 1):
        k = upto[total]
        with_each = best[total - lengths[:k]] + worth[:k]
        last[total] = j = with_each.argmax()
        best[total] = with_each[j]
    totals = np.arange(sequence + 1)
    cost = np.where(totals & (totals - 1) == 0, totals, sequence).astype(float)
    # The best total for each length to stand in.
    reduced = [(cost[n:] - best[: sequence + 1 - n]).min() - w for n, w in zip(lengths.tolist(), worth)]
    out = []
    for j in np.argsort(reduced, kind="stable"):
        if not reduced[j] < -1e-7:
            break
        n = int(lengths[j])
        total, found = int((cost[n:] - best[: sequence + 1 - n]).argmin()), {n: 1}
        while total:
            i = int(lengths[last[total]])
            found[i] = found.get(i, 0) + 1
            total -= i
        out.append(found)
    return out


def solve(lengths: np.ndarray, counts: np.ndarray, sequence: int) -> list[tuple[Pattern, float]]:
    """The linear program's patterns with their (fractional) numbers of sequences.

    Revised simplex method with column generation, from the patterns of
    ``_first_basis``; pieces that may be cut are columns, too, at a cost of ``1 +
    CUT_COST`` a token. Ends when no pattern improves it, when it is within ``GAP``
    of the number of tokens (which no packing can beat), or after ``PIVOTS``.
    """
    place = {int(n): i for i, n in enumerate(lengths)}
    tokens = float((lengths * counts).sum())
    columns: list[Pattern | None] = [None] * len(lengths)
    inverse, worth = np.eye(len(lengths)), lengths * (1 + CUT_COST)

    def enter(pattern: Pattern, reduced: float, column: np.ndarray, row: int) -> None:
        # Row by row: a matrix library's threads are of no use beside a JVM's.
        nonlocal worth
        pivot = inverse[row] / column[row]
        worth = worth + reduced * pivot
        touched = np.flatnonzero(np.abs(column) > 1e-12)
        inverse[touched] -= column[touched, None] * pivot
        inverse[row] = pivot
        columns[row] = pattern

    def less_worth(pattern: Pattern) -> float:
        return _cost(pattern, sequence) - sum(worth[place[n]] * k for n, k in pattern.items())

    first = _first_basis(lengths, counts, sequence)
    for used_up, (pattern, _) in first.items():
        if pattern:
            # No length of the pattern is used up before: it is its own column.
            column = np.zeros(len(lengths))
            for n, k in pattern.items():
                column[place[n]] = k
            enter(pattern, less_worth(pattern), column, place[used_up])
    amount = np.array([first[int(n)][1] for n in lengths])
    pivots = 0
    while pivots < PIVOTS and (worth * counts).sum() - tokens > GAP * tokens:
        before = pivots
        for pattern in best_patterns(lengths, worth, sequence):
            # The worths have changed since the patterns were found.
            reduced = less_worth(pattern)
            if reduced > -1e-7 or pivots == PIVOTS:
                continue
            rows = [place[n] for n in pattern]
            column = (inverse[:, rows] * np.array(list(pattern.values()), float)).sum(axis=1)
            leaves = np.flatnonzero(column > 1e-9)
            row = int(leaves[(amount[leaves] / column[leaves]).argmin()])
            step = amount[row] / column[row]
            amount = np.maximum(amount - step * column, 0.0)
            amount[row] = step
            enter(pattern, reduced, column, row)
            pivots += 1
        if pivots == before:
            break
    return [(c, float(x)) for c, x in zip(columns, amount) if c and x > 1e-9]


def rounded(lengths: np.ndarray, counts: np.ndarray, sequence: int) -> list[tuple[Pattern, int]]:
    """Patterns with whole numbers of sequences, none of more pieces than there are.

    Fractions are rounded down, then up where enough pieces are left, greatest
    fraction first. Of what is left, the longest piece is filled up with the
    longest that fit, if the sequence is then full but for the cost of a cut.
    """
    if not len(lengths):
        return []
    left = dict(zip(map(int, lengths), map(int, counts)))
    found = sorted(solve(lengths, counts, sequence), key=lambda c: (c[1] % 1, sorted(c[0].items())), reverse=True)
    out: dict[tuple, int] = {}

    def take(pattern: Pattern, times: int) -> None:
        times = min(times, *(left[n] // k for n, k in pattern.items()))
        if times > 0:
            key = tuple(sorted(pattern.items()))
            out[key] = out.get(key, 0) + times
            for n, k in pattern.items():
                left[n] -= times * k

    for pattern, x in found:
        take(pattern, int(x))
    for pattern, _ in found:
        take(pattern, 1)
    for longest in sorted(left, reverse=True):
        while left[longest]:
            pattern = filled(left, longest, sequence)
            if _cost(pattern, sequence) - sum(n * k for n, k in pattern.items()) > CUT_COST * sequence:
                break
            take(pattern, min(left[n] // k for n, k in pattern.items()))
    return [(dict(p), n) for p, n in out.items()]


def _pieces(batches, path: str, sequence: int, end: int, schema: pa.Schema):
    coder = ByteBpe(path)
    for batch in text_chunks(batches):
        ids, n = coder.encode(batch.column(1))
        n_all = n + 1
        starts = np.cumsum(n_all) - n_all
        tokens = np.full(int(n_all.sum()), end, "<u4")
        tokens[spread(starts, n)] = ids
        parts = -(-n_all // sequence)
        row = np.repeat(np.arange(len(n)), parts)
        start = spread(np.zeros(len(n), np.int64), parts).astype(np.int64) * sequence
        length = np.minimum(sequence, n_all[row] - start)
        at = starts[row] + start
        raw = tokens.tobytes()
        cut = [raw[4 * a : 4 * (a + k)] for a, k in zip(at.tolist(), length.tolist())]
        crc = np.fromiter(map(zlib.crc32, cut), np.int64, len(cut))
        # Full pieces are never cut again: their ids need not be kept.
        rest = [None if k == sequence else c for c, k in zip(cut, length.tolist())]
        arrays = [batch.column(0).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crc), pa.array(n_all[row]), pa.array(rest, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def token_pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE, end: int = END) -> DataFrame:
    """Rows (id, start, length, ids_crc32, doc_tokens, ids, piece) of every
    document's ids: full pieces and the rest, whose ids are kept. A written table
    (so that ``piece`` numbers stay what they are)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    longs = [StructField(n, LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
    fields = StructType([docs.schema["id"], *longs, StructField("ids", BinaryType())])
    arrow = to_arrow_schema(fields)
    cut = docs.select("id", "text").mapInArrow(lambda batches: _pieces(batches, path, sequence, end, arrow), fields)
    return written(cut.withColumn("piece", F.monotonically_increasing_id()), "packing-pieces")


def _ranks(pieces: DataFrame, rows: int) -> DataFrame:
    """Every piece's rank (from 0) among those of its length. Pieces are ranked in
    slices by a hash of their number, so that a length of any number of pieces is
    ranked in many groups; a slice begins where those before it end."""
    slices = max(1, -(-rows // SLICE_ROWS))
    dealt = pieces.withColumn("slice", F.pmod(F.xxhash64("piece"), F.lit(slices)))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = dealt.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    begins = begins.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inside = F.row_number().over(Window.partitionBy("length", "slice").orderBy("piece")) - 1
    ranked = dealt.withColumn("inside", inside).join(begins, ["length", "slice"])
    return ranked.withColumn("rank", F.col("begin") + F.col("inside")).drop("slice", "begin", "inside")


def _plan_rows(counts: dict[int, int], patterns: list[tuple[Pattern, int]], sequence: int) -> tuple[list[tuple], int, int]:
    """For each length: which ranks which pattern takes, and from which place the
    pieces beyond them stand in the stream of pieces that may be cut. Also the
    number of sequences of the patterns, and the stream's tokens."""
    taken = dict.fromkeys(counts, 0)
    uses: dict[int, list[tuple]] = {n: [] for n in counts}
    base = 0
    for pattern, times in patterns:
        offset = 0
        for n, k in sorted(pattern.items(), reverse=True):
            uses[n].append((taken[n], k, base, offset))
            taken[n] += times * k
            offset += n * k
        base += times
    rows, stream = [], 0
    for n in sorted(counts):
        rows.append((n, uses[n], taken[n], stream))
        stream += (counts[n] - taken[n]) * n
    return rows, base, stream


def stream_ends(tokens: int, sequence: int) -> list[int]:
    """Where sequences of the last, partial sequence's powers of two begin."""
    place = tokens - tokens % sequence
    ends = []
    for bit in reversed(range(sequence.bit_length())):
        if (tokens - place) >> bit:
            place += 1 << bit
            ends.append(place)
    return [e for e in ends if e < tokens]


def _crcs(batches, schema: pa.Schema):
    for batch in batches:
        columns = batch.to_pydict()
        crc = [zlib.crc32(ids[4 * a : 4 * (a + n)]) for ids, a, n in zip(columns["ids"], columns["from"], columns["length"])]
        at = batch.schema.get_field_index("ids_crc32")
        kept = [pa.array(crc, pa.int64()) if i == at else c for i, c in enumerate(batch.columns)]
        yield pa.RecordBatch.from_arrays([kept[batch.schema.get_field_index(f.name)] for f in schema], schema=schema)


def packed(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", sequence: int = SEQUENCE, end: int = END) -> DataFrame:
    """Rows (id, start, length, ids_crc32, doc_tokens, sequence_id, offset): where
    every piece of every document's ids stands.

    A document's ids are those of the byte-level tokenizer file ``path`` followed
    by ``end``. Documents of at most ``sequence`` ids stay whole where a pattern
    takes them; the few that are left over, and those whose lengths fit no pattern
    well, stand one after the other and are cut where a sequence is full. The last
    sequence is cut into powers of two, which need no padding: at most
    ``CUT_COST`` of the pattern sequences' places are padding that patterns leave,
    apart from what is cheaper than a cut. ``sequence`` is a power of two.

    Null and empty texts are the one id ``end``. A null id is a document like any
    other. Repeated rows are documents of their own, packed as often as they occur.
    Texts are packed whole. No documents give no rows.
    """
    if sequence & (sequence - 1):
        raise ValueError("sequence must be a power of two")
    spark = docs.sparkSession
    pieces = token_pieces(picked(docs, id=id_col, text=text_col), path, sequence, end)
    narrow = pieces.drop("ids")
    # At most one row for each length: bounded by the sequence, not by the input.
    counts = {r["length"]: r["count"] for r in narrow.groupBy("length").count().collect()}
    rests = np.array(sorted(n for n in counts if n < sequence), np.int64)
    patterns = rounded(rests, np.array([counts[n] for n in rests.tolist()], np.int64), sequence)
    if sequence in counts:
        patterns.append(({sequence: 1}, counts[sequence]))
    rows, base, stream = _plan_rows(counts, patterns, sequence)
    kind = "length long, uses array<struct<first: long, each: long, base: long, offset: long>>, taken long, stream long"
    plan = spark.createDataFrame(rows, kind)

    ranked = _ranks(narrow, sum(counts.values())).join(F.broadcast(plan), "length")
    own = ["id", "start", "length", "ids_crc32", "doc_tokens"]
    use = F.try_element_at(F.filter("uses", lambda u: u["first"] <= F.col("rank")), F.lit(-1))
    fits = ranked.filter("rank < taken").withColumn("use", use).withColumn("turn", F.col("rank") - F.col("use.first"))
    whole = fits.select(
        *own,
        (F.col("use.base") + F.expr("turn div use.each")).alias("sequence_id"),
        (F.col("use.offset") + F.col("turn") % F.col("use.each") * F.col("length")).alias("offset"),
    )
    ends = F.array(*[F.lit(e) for e in stream_ends(stream, sequence)]).cast("array<long>")
    place = F.col("stream") + (F.col("rank") - F.col("taken")) * F.col("length")
    streamed = ranked.filter("rank >= taken").withColumn("place", place)
    behind = F.col("place") + F.col("length")
    inner = F.concat(F.array((F.expr(f"place div {sequence}") + 1) * sequence), ends)
    inner = F.filter(inner, lambda e: (e > F.col("place")) & (e < behind))
    cuts = F.array_sort(F.array_distinct(F.concat(F.array("place"), inner)))
    parts = streamed.withColumn("cuts", cuts).select("*", F.posexplode("cuts").alias("nth", "at"))
    parts = parts.withColumn("next", F.coalesce(F.get("cuts", F.col("nth") + 1), behind))
    reached = F.filter(ends, lambda e: e <= F.col("at"))
    begin = F.greatest(F.expr(f"at div {sequence} * {sequence}"), F.coalesce(F.try_element_at(reached, F.lit(-1)), F.lit(0)))
    parts = parts.select(
        "id",
        (F.col("start") + F.col("at") - F.col("place")).alias("start"),
        (F.col("next") - F.col("at")).alias("length"),
        "ids_crc32",
        "doc_tokens",
        (F.lit(base) + F.expr(f"least(at, {stream - stream % sequence}L) div {sequence}") + F.size(reached)).alias("sequence_id"),
        (F.col("at") - begin).alias("offset"),
        "piece",
        (F.col("at") - F.col("place")).alias("from"),
        (F.size("cuts") > 1).alias("is_cut"),
    )
    parts = written(parts, "packing-cut")
    out = whole.columns
    cut = parts.filter("is_cut").join(pieces.select("piece", "ids"), "piece")
    schema = parts.select(*out).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    again = cut.select(*out, "from", "ids").mapInArrow(lambda batches: _crcs(batches, arrow), schema)
    return whole.unionByName(parts.filter("not is_cut").select(*out)).unionByName(again)


def padding(pieces: DataFrame, sequence: int = SEQUENCE) -> Column:
    """Places of a sequence that hold no id, over rows grouped by ``sequence_id``."""
    total = F.sum("length")
    return F.when(total.bitwiseAND(total - 1) == 0, F.lit(0)).otherwise(F.lit(sequence) - total)
