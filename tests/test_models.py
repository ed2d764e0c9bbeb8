"""Models on inline edge rows, and invariants on the sf0.001 test tables."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from churnlab.plans import models as M
from churnlab.settings import Settings
from churnlab.sources.lookups import channel_cac_df, plans_df

D, T = dt.date, dt.datetime

USERS = "user_id bigint, signup_date date, signup_timestamp timestamp_ntz, acquisition_channel string, " \
        "country string, primary_device string, age int, email string"
SUBS = "subscription_id bigint, user_id bigint, plan_id int, status string, started_at timestamp_ntz, " \
       "ended_at timestamp_ntz, is_trial boolean, converted_to_paid boolean, mrr decimal(8,2)"


def _users(spark):
    return spark.createDataFrame(
        [
            (1, D(2024, 1, 1), T(2024, 1, 1), "organic", "US", "mobile", 30, None),
            (2, D(2024, 1, 2), T(2024, 1, 2), "display", "CA", "tablet", 40, None),
            (3, D(2024, 1, 3), T(2024, 1, 3), "unknown_channel", "UK", "desktop", 50, None),
        ],
        USERS,
    )


def _subs(spark):
    return spark.createDataFrame(
        [
            (100, 1, 2, "active", T(2024, 1, 10), None, False, True, Decimal("12.99")),
            (101, 1, 1, "churned", T(2024, 3, 1), T(2024, 5, 15), False, True, Decimal("7.99")),
            (200, 3, 9, "churned", T(2024, 1, 31), T(2024, 2, 1), False, True, Decimal("5.00")),  # unknown plan
            (300, 9, 1, "active", T(2024, 2, 1), None, False, True, Decimal("7.99")),  # unknown user
            (400, 2, 4, "trial_expired", T(2024, 1, 5), T(2024, 1, 12), True, False, Decimal("0.00")),
        ],
        SUBS,
    )


def test_acquisition_edges(spark):
    events = spark.createDataFrame([(1, "subscribed")], "user_id bigint, event_type string")
    acq = M.mart_acquisition(_users(spark), events, _subs(spark), plans_df(spark), channel_cac_df(spark))
    rows = {r.user_id: r for r in acq.collect()}
    assert len(acq.columns) == 21 and set(rows) == {1, 2, 3}
    assert rows[1].plan_id == 2 and rows[1].plan_name == "Standard" and rows[1].reached_paid == 1
    assert rows[1].channel_cac == 0  # organic
    assert rows[2].channel_cac == 18 and rows[2].converted_to_paid is False
    assert rows[3].plan_id == 9 and rows[3].plan_name is None  # unknown plan: null plan columns
    assert rows[3].channel_cac == 0  # unknown channel defaults to 0


def test_user_without_subscription_has_null_sub_columns(spark):
    events = spark.createDataFrame([], "user_id bigint, event_type string")
    subs = _subs(spark).where(F.col("user_id") != 2)
    rows = {r.user_id: r for r in M.mart_acquisition(
        _users(spark), events, subs, plans_df(spark), channel_cac_df(spark)).collect()}
    r = rows[2]
    assert (r.plan_id, r.first_sub_started, r.converted_to_paid, r.first_sub_mrr, r.plan_name) == (None,) * 5


def test_economics_edges(spark):
    st = Settings(as_of=D(2024, 6, 15), cap=D(2024, 4, 1))
    eco = M.mart_economics(_subs(spark), _users(spark), plans_df(spark), channel_cac_df(spark), st)
    got = {}
    for r in eco.collect():
        got.setdefault(r.subscription_id, []).append((r.active_month, r.tenure_months, r.channel_cac))
    assert set(got) == {100, 101}  # unknown plan, unknown user and unpaid trial drop out
    assert [m for m, _, _ in sorted(got[100])] == [D(2024, m, 1) for m in (1, 2, 3, 4)]  # capped
    assert sorted(got[101])[-1][0] == D(2024, 4, 1)
    assert all(t >= 0 for v in got.values() for _, t, _ in v)
    uncapped = M.mart_economics(_subs(spark), _users(spark), plans_df(spark), channel_cac_df(spark), st, cap=None)
    assert uncapped.where("subscription_id = 100").count() == 6  # Jan..Jun (as_of)


def test_month_spine_and_range_join_agree(spark):
    st = Settings(as_of=D(2024, 6, 15), cap=D(2024, 4, 1))
    args = (_subs(spark), _users(spark), plans_df(spark))
    spine = [r.active_month for r in M.month_spine(*args, st).orderBy("active_month").collect()]
    assert spine == [D(2024, m, 1) for m in (1, 2, 3, 4)]
    rj = M.range_join_months(*args, channel_cac_df(spark), st)
    eco = M.mart_economics(*args, channel_cac_df(spark), st)
    assert sorted(map(tuple, rj.collect())) == sorted(
        map(tuple, eco.select("subscription_id", "active_month", "tenure_months").collect()))


def test_subscription_months_churn_flag(spark):
    st = Settings(as_of=D(2024, 6, 15))
    sm = M.subscription_months(_subs(spark), plans_df(spark), st)
    flags = {(r.subscription_id, r.active_month): r.churned_this_month for r in sm.collect()}
    assert flags[(101, D(2024, 5, 1))] == 1 and flags[(101, D(2024, 4, 1))] == 0
    assert flags[(200, D(2024, 2, 1))] == 1  # ends in its last month, still has the row
    assert (400, D(2024, 1, 1)) not in flags  # unconverted trials never appear


def test_experiments_edges(spark):
    exps = spark.createDataFrame(
        [("e1", "E1", "control_x", True), ("e1", "E1", "treatment_x", False)],
        "experiment_id string, experiment_name string, variant string, is_control boolean",
    )
    assign = spark.createDataFrame(
        [("e1", 1, "control_x", T(2024, 1, 1)), ("e1", 2, "undeclared", T(2024, 1, 2)),
         ("e1", 77, "treatment_x", T(2024, 1, 3))],
        "experiment_id string, user_id bigint, variant string, assigned_at timestamp_ntz",
    )
    sessions = spark.createDataFrame([], "user_id bigint, session_date date")
    outcomes = M.user_outcomes(_users(spark), _subs(spark), sessions)
    rows = {r.user_id: r for r in M.mart_experiments(assign, exps, outcomes).collect()}
    assert set(rows) == {1, 77}  # undeclared variant dropped by the inner join
    assert rows[1].converted == 1 and rows[1].sub_mrr == Decimal("12.99")
    assert rows[1].revenue_per_assigned == Decimal("12.99")
    assert rows[77].converted is None and rows[77].revenue_per_assigned is None


def test_invariants_on_test_tables(small_sources):
    s = small_sources
    acq = M.mart_acquisition(s.users, s.events, s.subscriptions, s.plans, s.channel_cac)
    assert acq.count() == acq.select("user_id").distinct().count() == s.users.count()
    eng = M.mart_engagement(s.users, s.sessions)
    known = s.sessions.join(s.users.select("user_id"), "user_id", "left_semi").count()
    assert eng.agg(F.sum("session_count")).first()[0] == known
    assert {r[0] for r in eng.select("engagement_tier").distinct().collect()} <= {"power_user", "regular", "casual"}
    eco = M.mart_economics(s.subscriptions, s.users, s.plans, s.channel_cac, s.settings)
    agg = eco.agg(F.min("tenure_months"), F.max("active_month")).first()
    assert agg[0] >= 0 and agg[1] <= s.settings.cap


def test_experiment_variants_and_eligibility(spark):
    from churnlab.plans.experiments import experiment_eligibility, experiment_variants
    from churnlab.sources.lookups import experiment_definitions_df

    definitions = [("x", "X", D(1995, 6, 1), D(1995, 12, 31), ["control_a", "b", "c"]),
                   ("y", "Y", D(1996, 1, 1), D(1996, 5, 31), ["control_y", "z"])]
    exps = experiment_variants(experiment_definitions_df(spark, definitions))
    rows = sorted((r.experiment_id, r.variant, r.is_control) for r in exps.collect())
    assert rows == [("x", "b", False), ("x", "c", False), ("x", "control_a", True), ("y", "control_y", True), ("y", "z", False)]
    users = spark.createDataFrame(
        [(1, D(1995, 6, 1), T(1995, 6, 1)), (2, D(1995, 12, 31), T(1995, 12, 31)),
         (3, D(1995, 12, 31), T(1995, 12, 31, 9)), (4, D(1995, 5, 31), T(1995, 5, 31, 23))],
        "user_id bigint, signup_date date, signup_timestamp timestamp_ntz",
    )
    got = sorted((r.experiment_id, r.user_id) for r in experiment_eligibility(users, exps).collect())
    # closed on timestamps: the last day counts only at midnight
    assert got == [("x", 1), ("x", 2)]


def test_three_variants_are_split_evenly(spark):
    from churnlab.plans.experiments import assign_variants

    exps = spark.createDataFrame([("x", v, v == "control") for v in ("control", "m", "n")], "experiment_id string, variant string, is_control boolean")
    eligible = spark.range(60_000).select(F.lit("x").alias("experiment_id"), F.col("id").alias("user_id"), F.lit(T(2024, 1, 1)).alias("signup_timestamp"))
    got = assign_variants(eligible, exps, inclusion_pct=100).groupBy("variant").count().collect()
    # 34/33/33 of a hundred buckets would be 400 off.
    assert len(got) == 3 and all(abs(r["count"] - 20_000) < 350 for r in got)


def test_range_join_equals_theta_join(small_sources):
    s = small_sources
    paid = M.paid_subscriptions(s.subscriptions, s.users, s.plans, s.channel_cac)
    spine = M.month_spine(s.subscriptions, s.users, s.plans, s.settings)
    last = F.trunc(F.coalesce(F.to_date("ended_at"), F.lit(str(s.settings.as_of)).cast("date")), "month")
    theta = paid.join(spine, (F.col("active_month") >= F.col("sub_start_month")) & (F.col("active_month") <= last))
    expected = theta.groupBy("subscription_id").count().collect()
    found = M.range_join_months(s.subscriptions, s.users, s.plans, s.channel_cac, s.settings).groupBy("subscription_id").count()
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in expected}


def test_first_day_flags(spark):
    days = [D(2024, 1, 30), D(2024, 1, 31), D(2024, 2, 1), D(2024, 2, 4), D(2024, 2, 14), D(2024, 2, 15)]
    sessions = spark.createDataFrame([(1, d, 5, "A") for d in days * 2] + [(2, days[3], 5, None)],
                                     "user_id bigint, session_date date, duration_minutes int, device string")
    rows = [r for r in M.engagement_days(sessions).sort("user_id", "session_date").collect() if r.user_id == 1]
    assert [r.first_of_session_month for r in rows] == [True, False, True, False, False, False]
    assert [r.first_of_session_week for r in rows] == [True, False, False, True, True, False]  # Sunday 4 Feb starts a week
    assert [r.first_of_retention_bucket for r in rows] == [True, True, False, False, True, False]  # D0, D1-6, D14-29
