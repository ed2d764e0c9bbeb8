"""Interval join: points with the intervals that hold them, as a hash join on bins."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one side in a bin beyond which the bin is split.
BIN_ROWS = 1_000_000


def days(value: Column) -> Column:
    """Dates and timestamps as days since 1970: an axis for bins."""
    return F.unix_date(value.cast("date"))


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    point: str,
    low: str,
    high: str,
    width: int,
    keys: Sequence[str] = (),
    axis: Callable[[Column], Column] = lambda c: c.cast("long"),
    bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """Rows of ``points`` x rows of ``intervals`` with ``low <= point <= high`` and equal
    ``keys``; the columns of both, ``keys`` once.

    ``axis`` takes values to whole numbers and keeps their order. The axis is cut into
    bins of ``width``; a point goes to its bin, an interval to every bin that it touches
    (so choose a width near the usual length: a shorter one copies intervals, a longer
    one compares more), and bins are joined by hash. The exact condition, on the values
    themselves, is tested on the joined pairs. Each pair meets once, in the point's bin.

    Where a side has more than ``bin_rows`` rows in a bin, its rows are dealt to parts of
    the bin by hash and the other side's rows are copied to every part: both sides may
    grow, and a bin may hold a third of all rows. The bins that are split are counted
    first, from one row a bin and task; they are at most 1 / ``bin_rows`` of the rows.

    A null point, bound or key, and an interval that ends before it starts, match nothing.
    """
    keys = list(keys)
    clash = set(points.columns) & set(intervals.columns) - set(keys)
    if clash:
        raise ValueError(f"columns on both sides: {', '.join(sorted(clash))}")

    def bin_of(c: str) -> Column:
        value = axis(F.col(c)).cast("long")
        return (value - F.pmod(value, F.lit(width).cast("long"))) / width

    at = points.withColumn("_bin", F.floor(bin_of(point))).filter(F.col("_bin").isNotNull())
    touched = F.when(F.col(low) <= F.col(high), F.sequence(F.floor(bin_of(low)), F.floor(bin_of(high))))
    over = intervals.withColumn("_bin", F.explode(touched))

    of = [*keys, "_bin"]

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*of).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > bin_rows)

    full = count(at, "_points").join(count(over, "_intervals"), of, "full").select(
        *of, F.coalesce("_points", F.lit(0)).alias("_points"), F.coalesce("_intervals", F.lit(0)).alias("_intervals")
    )
    parts = F.ceil(F.greatest("_points", "_intervals") / bin_rows).cast("int")
    full = full.select(*of, parts.alias("_parts"), (F.col("_points") >= F.col("_intervals")).alias("_deal_points"))

    def dealt(df: DataFrame, own: Column) -> DataFrame:
        """Rows with their part of the bin: one part where this side is dealt out, all
        parts where it is copied."""
        row = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col("_parts")).cast("int")
        part = F.when(F.col("_parts").isNull(), F.array(F.lit(0))).when(own, F.array(row)).otherwise(F.sequence(F.lit(0), F.col("_parts") - 1))
        marked = df.join(full, of, "left")
        return marked.withColumn("_part", F.explode(part)).drop("_parts", "_deal_points")

    pairs = dealt(at, F.col("_deal_points")).join(dealt(over, ~F.col("_deal_points")), [*of, "_part"])
    inside = (F.col(point) >= F.col(low)) & (F.col(point) <= F.col(high))
    return pairs.filter(inside).drop("_bin", "_part")
