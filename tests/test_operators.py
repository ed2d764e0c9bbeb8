"""Generic operators on inline edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from churnlab.operators import (
    active_months,
    anti_orphans,
    daily_activity,
    first_per_key,
    orphan_keys,
    retention_flags,
    stage_flags,
)
from churnlab.sources.lookups import FUNNEL_STAGES, RETENTION_WINDOWS

D, T = dt.date, dt.datetime


def test_stage_flags(spark):
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id bigint")
    events = spark.createDataFrame(
        [
            (1, "signup_completed"),
            (1, "signup_completed"),  # repeated
            (1, "subscribed"),
            (2, "page_view"),  # type outside the funnel
            (9, "signup_completed"),  # unknown user
        ],
        "user_id bigint, event_type string",
    )
    out = {r.user_id: r for r in stage_flags(users, events, FUNNEL_STAGES).collect()}
    assert set(out) == {1, 2, 3}
    assert (out[1].reached_signup, out[1].reached_paid, out[1].reached_trial) == (1, 1, 0)
    for u in (2, 3):
        assert [out[u][f] for f in FUNNEL_STAGES] == [0] * 5


def test_first_per_key_ties_and_nulls(spark):
    subs = spark.createDataFrame(
        [
            (10, 1, T(2024, 1, 1)),
            (11, 1, T(2024, 1, 1)),  # same start: lowest id wins
            (20, 2, T(2024, 2, 1)),  # single row
            (30, 3, None),  # null start sorts last
            (31, 3, T(2024, 3, 5)),
        ],
        "subscription_id bigint, user_id bigint, started_at timestamp_ntz",
    )
    first = first_per_key(subs, ["user_id"], [F.col("started_at").asc_nulls_last(), F.col("subscription_id")])
    got = {r.user_id: r.subscription_id for r in first.collect()}
    assert got == {1: 10, 2: 20, 3: 31}


def test_first_per_key_uses_partial_group_limit(spark):
    subs = spark.range(100).select((F.col("id") % 7).alias("user_id"), F.col("id").alias("subscription_id"))
    plan = first_per_key(subs, ["user_id"], [F.col("subscription_id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_retention_flags_window_edges(spark):
    signup = D(2024, 1, 1)
    offsets = [6, 7, 13, 14, 29, 30, 59, 60]
    users = spark.createDataFrame([(i, signup) for i in range(len(offsets) + 1)], "user_id bigint, signup_date date")
    sessions = spark.createDataFrame(
        [(i, signup + dt.timedelta(days=o)) for i, o in enumerate(offsets)], "user_id bigint, session_date date"
    )
    got = {r.user_id: (r.retained_d7, r.retained_d30) for r in retention_flags(users, sessions, RETENTION_WINDOWS).collect()}
    expect = {0: (0, 0), 1: (1, 0), 2: (1, 0), 3: (0, 0), 4: (0, 0), 5: (0, 1), 6: (0, 1), 7: (0, 0), 8: (0, 0)}
    assert got == expect


def test_daily_activity_devices(spark):
    d = D(2024, 1, 1)
    sessions = spark.createDataFrame(
        [
            (1, d, 10, "tablet"),
            (1, d, 20, "mobile"),
            (1, d, 5, None),
            (2, d, 7, None),
            (2, d, 8, None),
        ],
        "user_id bigint, session_date date, duration_minutes int, device string",
    )
    got = {r.user_id: r for r in daily_activity(sessions).collect()}
    assert (got[1].session_count, got[1].total_minutes, got[1].devices_used, got[1].devices_list) == (
        3, 35, 2, "mobile,tablet")
    assert (got[2].devices_used, got[2].devices_list) == (0, None)


def test_active_months_edges(spark):
    rows = [
        (1, T(2024, 1, 31, 12), T(2024, 1, 31, 12)),  # end = start: one month
        (2, T(2024, 3, 10), T(2024, 1, 5)),  # end month before start month: none
        (3, T(2024, 10, 1), None),  # open: through as_of (cut by cap below)
        (4, T(2025, 3, 1), None),  # starts after the cap: none
        (5, T(2024, 1, 31), T(2024, 3, 1)),  # Jan 31 start: month starts
    ]
    df = spark.createDataFrame(rows, "id int, s timestamp_ntz, e timestamp_ntz")
    uncapped = active_months(df, "s", "e", as_of=D(2024, 12, 15))
    capped = active_months(df, "s", "e", as_of=D(2024, 12, 15), cap=D(2024, 11, 1))

    def months(out):
        got = {}
        for r in out.collect():
            got.setdefault(r.id, []).append(r.active_month)
        return {k: sorted(v) for k, v in got.items()}

    u, c = months(uncapped), months(capped)
    assert u[1] == [D(2024, 1, 1)]
    assert 2 not in u and 4 not in c
    assert u[3] == [D(2024, 10, 1), D(2024, 11, 1), D(2024, 12, 1)]
    assert c[3] == [D(2024, 10, 1), D(2024, 11, 1)]
    assert u[5] == [D(2024, 1, 1), D(2024, 2, 1), D(2024, 3, 1)]


@pytest.mark.parametrize("cap", [None, D(2024, 11, 1)])
def test_dealt_months_are_the_same_rows(spark, cap):
    spans = [(D(2023, m, 28), D(2024, n, 3)) for m in range(1, 13) for n in (1, 2, 6, 11, 12)]
    spans += [(D(2024, 2, 1), D(2024, 1, 31)), (D(2024, 2, 1), None), (None, D(2024, 2, 1)), (D(2025, 2, 1), None), (D(2024, 5, 1), D(2024, 5, 1))]
    df = spark.createDataFrame([(i, s, e) for i, (s, e) in enumerate(spans + spans)], "id int, s date, e date")
    plain, dealt = (active_months(df, "s", "e", as_of=D(2024, 12, 15), cap=cap, dealt=d) for d in (False, True))
    assert dealt.schema == plain.schema and plain.count() > 500
    assert sorted(map(tuple, dealt.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_anti_orphans(spark):
    parent = spark.createDataFrame([(1,), (2,)], "user_id bigint")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, None)], "sid bigint, user_id bigint")
    got = [r.sid for r in anti_orphans(child, parent, "user_id").collect()]
    assert got == [11]
    assert [r.user_id for r in orphan_keys(child, parent, "user_id").collect()] == [3]


def test_orphans_of_a_hot_unknown_key_are_joined_by_key(spark):
    parent = spark.createDataFrame([(1,), (2,)], "user_id bigint")
    child = spark.range(300).select(F.col("id").alias("sid"), F.when(F.col("id") % 3 == 0, 7).otherwise(1).cast("bigint").alias("user_id"))
    assert {r.sid for r in anti_orphans(child, parent, "user_id").collect()} == {i for i in range(300) if i % 3 == 0}
    keys = orphan_keys(child, parent, "user_id")
    assert [r.user_id for r in keys.collect()] == [7]
    # Keys are reduced to one row each before they are shuffled to the anti join.
    plan = keys._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftAnti") < plan.index("Aggregate [user_id")


def test_stage_flags_tell_every_stage_apart(spark):
    """One user per stage, with an event of only that stage."""
    users = spark.createDataFrame([(i,) for i in range(6)], "user_id bigint")
    events = spark.createDataFrame(list(enumerate(FUNNEL_STAGES.values())), "user_id bigint, event_type string")
    out = {r.user_id: [r[f] for f in FUNNEL_STAGES] for r in stage_flags(users, events, FUNNEL_STAGES).collect()}
    assert out == {i: [int(i == j) for j in range(5)] for i in range(6)}


def test_day_maps_against_sets_of_days(spark):
    """Windows over the borders of 64-day words, before 1970, longer than a word, empty."""
    import datetime as dt
    import random

    rng = random.Random(3)
    epoch = dt.date(1970, 1, 1)
    users = [(u, epoch + dt.timedelta(days=rng.choice([-70, -64, -1, 0, 63, 64, 127, 9000]))) for u in range(60)] + [(99, None)]
    days = [(u, a + dt.timedelta(days=rng.randint(-5, 300))) for u, a in users[:50] for _ in range(rng.randint(1, 6))] + [(3, None), (700, epoch)]
    windows = {"same": (0, 1), "week": (7, 14), "long": (1, 200), "word": (0, 64), "late": (64, 128), "none": (5, 5), "before": (-5, 0)}
    u = spark.createDataFrame(users, "user_id bigint, signup_date date")
    a = spark.createDataFrame(days * 2, "user_id bigint, session_date date")
    got = {r.user_id: {w: r[w] for w in windows} for r in retention_flags(u, a, windows).collect()}
    assert len(got) == len(users)
    for user, anchor in users:
        seen = [(d - anchor).days for v, d in days if v == user and d and anchor]
        assert got[user] == {w: int(any(low <= n < high for n in seen)) for w, (low, high) in windows.items()}, user


def test_day_maps_merge(spark):
    from churnlab.operators import activity_maps

    a = spark.sql("SELECT id % 5 AS user_id, date_add(DATE '1999-12-01', CAST(id * 7 % 200 AS INT)) AS session_date FROM range(300)")
    halves = [activity_maps(a.where(f"user_id % 2 = {i}").union(a.where("user_id = 4"))) for i in (0, 1)]
    merged = halves[0].union(halves[1]).groupBy("user_id", "word").agg(F.bit_or("bits").alias("bits"))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, activity_maps(a).collect()))
    days = merged.agg(F.sum(F.bit_count("bits"))).first()[0]
    assert days == a.distinct().count()
