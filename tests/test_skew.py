"""A user holding a third of all rows: results equal a brute-force pandas
computation, and the heavy aggregations combine map-side before shuffling."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from churnlab.operators import daily_activity, retention_flags, stage_flags
from churnlab.plans import models as M
from churnlab.sources.lookups import FUNNEL_STAGES, RETENTION_WINDOWS


def _sessions(spark, n=6000):
    base = dt.date(2024, 1, 1)
    rows = []
    for i in range(n):
        user = 0 if i % 3 == 0 else 1 + i % 97  # user 0 holds a third of the rows
        day = base + dt.timedelta(days=(i * 7) % 120)
        rows.append((user, day, 5 + i % 40, ["A", "N", "R", None][i % 4]))
    pdf = pd.DataFrame(rows, columns=["user_id", "session_date", "duration_minutes", "device"])
    df = spark.createDataFrame(
        rows, "user_id bigint, session_date date, duration_minutes int, device string"
    ).repartition(8)
    return df, pdf


def test_daily_activity_with_hot_user_matches_brute_force(spark):
    df, pdf = _sessions(spark)
    got = {(r.user_id, r.session_date): (r.session_count, r.total_minutes, r.devices_used, r.devices_list)
           for r in daily_activity(df).collect()}
    expect = {}
    for (u, d), g in pdf.groupby(["user_id", "session_date"]):
        devs = sorted(x for x in set(g["device"]) if x is not None)
        expect[(u, d)] = (len(g), int(g["duration_minutes"].sum()), len(devs), ",".join(devs) or None)
    assert got == expect
    plan = daily_activity(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_collect_set" in plan


def test_engagement_first_session_with_hot_user(spark):
    df, pdf = _sessions(spark)
    users = spark.createDataFrame([(u, "c", "x", "A") for u in range(98)],
                                  "user_id bigint, acquisition_channel string, country string, primary_device string")
    eng = M.mart_engagement(users, df)
    first = pdf.groupby("user_id")["session_date"].min().to_dict()
    got = {r.user_id: r.first_session_date for r in eng.select("user_id", "first_session_date").distinct().collect()}
    assert got == first
    assert eng.count() == pdf[["user_id", "session_date"]].drop_duplicates().shape[0]


def test_flags_and_retention_with_hot_user(spark):
    df, pdf = _sessions(spark)
    users = spark.createDataFrame([(u, dt.date(2023, 12, 25)) for u in range(98)], "user_id bigint, signup_date date")
    ret = {r.user_id: (r.retained_d7, r.retained_d30) for r in retention_flags(users, df, RETENTION_WINDOWS).collect()}
    profile = users.selectExpr("*", "cast(signup_date as timestamp_ntz) as signup_timestamp", "'c' as acquisition_channel", "'x' as country", "'A' as primary_device")
    no_subs = spark.createDataFrame([], "user_id bigint, converted_to_paid boolean, mrr decimal(8,2)")
    outcomes = M.user_outcomes(profile, no_subs, df).collect()
    assert {r.user_id: (r.retained_d7, r.retained_d30) for r in outcomes} == ret
    for u in range(98):
        days = {(d - dt.date(2023, 12, 25)).days for d in pdf.loc[pdf.user_id == u, "session_date"]}
        assert ret[u] == (int(any(7 <= x < 14 for x in days)), int(any(30 <= x < 60 for x in days)))
    events = df.select("user_id", F.when(F.col("device") == "A", "subscribed").otherwise("page_view").alias("event_type"))
    flags = stage_flags(users.select("user_id"), events, FUNNEL_STAGES)
    paid = {r.user_id for r in flags.where("reached_paid = 1").collect()}
    assert paid == set(pdf.loc[pdf.device == "A", "user_id"])
    plan = flags._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_hot_user_join_is_split_by_aqe(spark):
    import datetime as dt
    from decimal import Decimal

    from churnlab.settings import Settings
    from churnlab.sources.lookups import channel_cac_df, plans_df

    n = 30000
    subs = spark.createDataFrame(
        [(i, 0 if i % 3 == 0 else i, 1 + i % 4, "active", dt.datetime(2024, 1 + i % 6, 1), None, False, True,
          Decimal("7.99")) for i in range(n)],
        "subscription_id bigint, user_id bigint, plan_id int, status string, started_at timestamp_ntz, "
        "ended_at timestamp_ntz, is_trial boolean, converted_to_paid boolean, mrr decimal(8,2)",
    )
    users = spark.createDataFrame(
        [(i, "organic", "US", "A") for i in range(n)],
        "user_id bigint, acquisition_channel string, country string, primary_device string",
    )
    st = Settings(as_of=dt.date(2024, 6, 30))
    # Thresholds scaled down to kilobyte-sized test data (at scale the
    # defaults apply: a partition is skewed above 256 MB and 4x the median).
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        eco = M.mart_economics(subs, users, plans_df(spark), channel_cac_df(spark), st)
        total = eco.count()
        assert eco.where("user_id = 0").select("subscription_id").distinct().count() == n // 3
        df = eco.groupBy("user_id").count()
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString()
        assert "isSkewJoin=true" in final or "skew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    # same rows as without skew handling: every subscription x its months
    assert total == sum(6 - i % 6 for i in range(n))
