"""Generic relational operators the models are built from.

All are plain DataFrame -> DataFrame functions. Shapes chosen for scale:

* facts are aggregated per key *before* they meet the entity table, so the
  aggregation combines map-side and a hot key collapses to one row per input
  partition before any shuffle;
* per-key windows only run over pre-aggregated rows whose count per key has a
  fixed bound (e.g. one row per user-day);
* no broadcast hints: literal lookups are broadcast because the planner knows
  their size, other joins are sized by AQE from measured bytes and split where
  a key is hot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.functions.dates import as_date, date_lit, month_series, month_start, quarter_series

def stage_flags(
    entities: DataFrame,
    events: DataFrame,
    stages: Mapping[str, str],
    key: str = "user_id",
    type_col: str = "event_type",
) -> DataFrame:
    """Entity rows plus one 0/1 flag per stage: did any event of that type occur.

    "Ever happened", not an ordered funnel. Events of unknown types are ignored
    (filtered before the shuffle, pushed to the scan), events of unknown
    entities drop out in the left join, entities without events get 0.
    """
    wanted = list(dict.fromkeys(stages.values()))
    flags = (
        events.where(F.col(type_col).isin(wanted))
        .groupBy(key)
        .agg(*[F.max(F.when(F.col(type_col) == t, 1).otherwise(0)).alias(f) for f, t in stages.items()])
    )
    out = entities.join(flags, on=key, how="left")
    return out.select(
        *entities.columns, *[F.coalesce(F.col(f), F.lit(0)).alias(f) for f in stages]
    )


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
) -> DataFrame:
    """First row per key by ``order`` (give a unique last sort key for ties).

    ``row_number() = 1`` lets the planner insert a partial group limit before
    the shuffle, so each input partition sends at most one row per key.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


#: Days in one word of a day map.
WORD_DAYS = 64


def activity_maps(activity: DataFrame, key: str = "user_id", date_col: str = "session_date") -> DataFrame:
    """Each key's active days as bit maps: (key, word, bits), one row for every 64 days
    (counted from 1970) in which the key has any.

    ``bits`` is an OR over rows, so tasks combine before the shuffle and maps of
    several loads merge by another OR; null dates are left out.
    """
    day = F.unix_date(F.col(date_col))
    place = F.pmod(day, F.lit(WORD_DAYS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    word = F.call_function("div", day - place, F.lit(WORD_DAYS)).cast("int")
    days = activity.where(F.col(date_col).isNotNull()).select(key, word.alias("word"), bit.alias("bits"))
    return days.groupBy(key, "word").agg(F.bit_or("bits").alias("bits"))


def _days_in_word(low: Column, high: Column) -> Column:
    """Bits of the days from ``low`` up to before ``high``, counted from the word's first."""
    def below(n: Column) -> Column:
        inside = F.call_function("shiftrightunsigned", F.lit(-1).cast("bigint"), F.lit(WORD_DAYS) - n)
        return F.when(n >= WORD_DAYS, F.lit(-1).cast("bigint")).when(n <= 0, F.lit(0).cast("bigint")).otherwise(inside)

    return below(high).bitwiseAND(F.bitwise_not(below(low)))


def retention_flags(
    entities: DataFrame,
    activity: DataFrame,
    windows: Mapping[str, tuple[int, int]],
    key: str = "user_id",
    anchor_col: str = "signup_date",
    date_col: str = "session_date",
) -> DataFrame:
    """Entity rows plus one 0/1 flag per window: did any activity fall in
    [anchor+lo, anchor+hi) days.

    Activity is cut to day maps first (map-side combined), so an entity meets a
    row for every 64 days at most, not one a day; a window is a test of bits.
    The flags are aggregated on the join's own partitioning (no further shuffle).
    ``key`` is unique in ``entities``; entities without activity get 0.
    """
    joined = entities.join(activity_maps(activity, key, date_col), on=key, how="left")
    anchor = F.unix_date(F.col(anchor_col)) - F.col("word") * WORD_DAYS
    flags = [
        F.max(F.when(F.col("bits").bitwiseAND(_days_in_word(anchor + lo, anchor + hi)) != 0, 1).otherwise(0)).alias(name)
        for name, (lo, hi) in windows.items()
    ]
    return joined.groupBy(*entities.columns).agg(*flags)


def daily_activity(
    sessions: DataFrame,
    key: str = "user_id",
    date_col: str = "session_date",
    minutes_col: str = "duration_minutes",
    device_col: str = "device",
) -> DataFrame:
    """Per key-day: session_count, total_minutes, devices_used, devices_list.

    The distinct device set is collected once and serves both the distinct
    count and the sorted comma list (one exchange instead of two); a device
    set is bounded by the device domain. Null devices are ignored; a day with
    only null devices has 0 devices and a null list.
    """
    devices = F.collect_set(device_col)
    agg = sessions.groupBy(key, date_col).agg(
        F.count(F.lit(1)).alias("session_count"),
        F.sum(minutes_col).cast("bigint").alias("total_minutes"),
        devices.alias("_devices"),
    )
    return agg.select(
        key,
        date_col,
        "session_count",
        "total_minutes",
        F.size("_devices").cast("bigint").alias("devices_used"),
        F.nullif(F.array_join(F.array_sort("_devices"), ","), F.lit("")).alias("devices_list"),
    )


def active_months(
    df: DataFrame,
    start_col: str,
    end_col: str,
    as_of,
    cap=None,
    out_col: str = "active_month",
    dealt: bool = False,
) -> DataFrame:
    """One row per month a span is active, both ends inclusive.

    The span runs from the month of ``start_col`` to the month of ``end_col``
    (or of ``as_of`` while still open), cut at ``cap`` when given. A narrow
    per-row generate: no join, no shuffle. Reversed or null bounds give no
    row (a start after the cap, or an end before the start).

    With ``dealt`` the rows come rebalanced by quarter, for a table that is written
    by month: a span is shuffled once for each quarter, its months are made after
    that. (Longer parts would be shuffled less, but a task's rows are sorted before
    they are written, and would grow more after the shuffle that sizes the tasks.)
    """
    lo = month_start(start_col)
    hi = month_start(F.coalesce(as_date(end_col), date_lit(as_of)))
    if cap is not None:
        hi = F.least(hi, month_start(date_lit(cap)))
    if dealt:
        df = df.select("*", F.explode(quarter_series(lo, hi)).alias(out_col)).hint("rebalance", out_col)
        lo, hi = F.greatest(lo, F.col(out_col)), F.least(hi, F.add_months(out_col, 2))
        return df.withColumn(out_col, F.explode(month_series(lo, hi)))
    return df.select("*", F.explode(month_series(lo, hi)).alias(out_col))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name of many frames, combined as a balanced tree so
    each analysis step sees log-depth plans instead of an ever longer chain."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_all needs at least one frame")
    while len(frames) > 1:
        paired = [a.unionByName(b) for a, b in zip(frames[0::2], frames[1::2])]
        if len(frames) % 2:
            paired.append(frames[-1])
        frames = paired
    return frames[0]


def anti_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-null key has no parent.

    The orphan keys are found first, from one row per key (map-side combined),
    so a key held by a large share of the child rows is one row in the anti
    join; the child's rows are then matched with the few orphan keys.
    """
    present = child.where(F.col(child_key).isNotNull())
    return present.join(orphan_keys(present, parent, child_key, parent_key), on=child_key, how="left_semi")


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None) -> DataFrame:
    """Distinct non-null child keys that no parent row has."""
    parents = parent.select(F.col(parent_key or child_key).alias(child_key)).distinct()
    return child.select(child_key).where(F.col(child_key).isNotNull()).distinct().join(parents, child_key, "left_anti")
