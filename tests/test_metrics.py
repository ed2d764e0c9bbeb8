"""Metric edge cases: zero denominators, months without churn, z-test."""

import datetime as dt
import math
from decimal import Decimal

from churnlab.plans import metrics as MT

D = dt.date


def test_ltv_cac_null_for_zero_cac(spark):
    eco = spark.createDataFrame(
        [("organic", 1, Decimal("10.00"), 0), ("organic", 1, Decimal("10.00"), 0), ("display", 2, Decimal("5.00"), 18)],
        "acquisition_channel string, user_id bigint, mrr decimal(8,2), channel_cac int",
    )
    got = {r.acquisition_channel: r for r in MT.ltv_cac(eco).collect()}
    assert got["organic"].ltv == 20.0 and got["organic"].ltv_cac is None
    assert math.isclose(got["display"].ltv_cac, 5.0 / 18)


def test_churn_rate_month_without_churn(spark):
    sm = spark.createDataFrame(
        [(D(2024, 1, 1), 0), (D(2024, 1, 1), 0), (D(2024, 2, 1), 1), (D(2024, 2, 1), 0)],
        "active_month date, churned_this_month int",
    )
    got = {r.active_month: r for r in MT.churn_rate(sm, 0.05).collect()}
    assert got[D(2024, 1, 1)].churned_subs == 0 and got[D(2024, 1, 1)].churn_rate == 0.0
    assert got[D(2024, 2, 1)].churn_rate == 0.5 and got[D(2024, 2, 1)].above_benchmark


def test_experiment_results_lift_and_significance(spark):
    rows = []
    for i in range(100):
        rows.append(("e", "control", True, i, 1 if i < 20 else 0, 0, 0, Decimal("0.00")))
    for i in range(100, 200):
        rows.append(("e", "treatment", False, i, 1 if i < 140 else 0, 0, 0, Decimal("0.00")))
    rows.append(("e", "treatment", False, 999, None, None, None, None))  # unmatched user
    mart = spark.createDataFrame(
        rows,
        "experiment_id string, variant string, is_control boolean, user_id bigint, converted int, "
        "retained_d7 int, retained_d30 int, revenue_per_assigned decimal(12,2)",
    )
    res = MT.experiment_results(mart)
    by = {r.variant: r for r in res.collect()}
    assert by["treatment"].assigned_users == 101 and by["treatment"].measured_users == 100
    lift = MT.experiment_lift(res).first()
    assert math.isclose(lift.conversion_lift, 0.4 / 0.2 - 1)
    assert lift.d30_lift is None  # control D30 rate is 0
    sig = MT.experiment_significance(res).first()
    p = 0.3
    z = 0.2 / math.sqrt(p * (1 - p) * (2 / 100))
    assert math.isclose(sig.z_score, z) and sig.significant


def test_funnel_summary_rates(spark):
    acq = spark.createDataFrame(
        [(1, 1, 1, 1, 1), (1, 1, 0, 0, 0), (1, 0, 0, 0, 0), (0, 0, 0, 0, 0)],
        "reached_signup int, reached_trial int, reached_paywall int, reached_subscribe_click int, reached_paid int",
    )
    rows = MT.funnel_summary(acq).orderBy("stage_order").collect()
    assert [r.users for r in rows] == [3, 2, 1, 1, 1]
    assert [r.step_rate for r in rows] == [0.75, 2 / 3, 0.5, 1.0, 1.0]
    assert rows[-1].overall_rate == 0.25


def test_two_sided_p_and_holm(spark):
    from pyspark.sql import functions as F

    from churnlab.functions.scalar import two_sided_p
    from churnlab.plans.metrics import experiment_p_values

    zs = [0.0, 1e-9, -0.3, 1.0, -1.96, 2.5758, 4.0, 5.5, -7.9, 8.0, 40.0, None]
    got = [r[0] for r in spark.createDataFrame([(z,) for z in zs], "z double").select(two_sided_p(F.col("z"))).collect()]
    for z, p in zip(zs, got):
        assert p is None if z is None else abs(p - math.erfc(abs(z) / math.sqrt(2))) < 1e-12
    kind = "experiment_id string, variant string, is_control boolean, measured_users bigint, conversions bigint, conversion_rate double, d30_rate double"
    counts = [("x", "c", True, 1000, 100), ("x", "v1", False, 1000, 130), ("x", "v2", False, 1000, 128), ("x", "v3", False, 1000, 101), ("x", "v4", False, 0, 0)]
    results = spark.createDataFrame([(*r, r[4] / r[3] if r[3] else None, 0.0) for r in counts], kind)
    rows = {r.variant: r for r in experiment_p_values(results).collect()}
    p = [rows[v].p_value for v in ("v1", "v2", "v3")]
    assert p == sorted(p)
    holm = [3 * p[0], max(3 * p[0], 2 * p[1]), max(3 * p[0], 2 * p[1], p[2])]
    assert all(abs(rows[v].p_holm - min(1, h)) < 1e-8 for v, h in zip(("v1", "v2", "v3"), holm))
    assert rows["v1"].p_value < 0.05 <= rows["v1"].p_holm and rows["v1"].significant is False
    assert rows["v4"].p_value is None and rows["v4"].p_holm is None
