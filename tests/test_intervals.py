"""The interval join against the theta form."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from churnlab.operators.intervals import days, interval_join
from churnlab.plans import models as M
from churnlab.plans.experiments import experiment_eligibility


def both(spark, points, intervals, **options):
    p = spark.createDataFrame(points, "k long, p_id long, p long")
    i = spark.createDataFrame(intervals, "k long, i_id long, low long, high long")
    found = interval_join(p, i, "p", "low", "high", **options)
    return sorted((r["p_id"], r["i_id"]) for r in found.collect())


def plain(points, intervals, keyed):
    return sorted(
        (pi, ii) for pk, pi, p in points for ik, ii, low, high in intervals
        if None not in (p, low, high) and low <= p <= high and (not keyed or pk is not None and pk == ik)
    )


@pytest.mark.parametrize("width, bin_rows", [(1, 1000), (10, 1000), (10, 5), (100, 3), (10_000, 7)])
def test_equals_the_theta_join(spark, width, bin_rows):
    rng = random.Random(width)
    points = [(rng.randint(0, 2), n, rng.randint(-50, 200)) for n in range(150)]
    points += [(1, 1000 + n, 7) for n in range(60)] + [(None, 1, 7), (1, 2, None)]
    intervals = [(rng.randint(0, 2), n, low := rng.randint(-50, 200), low + rng.randint(-3, 60)) for n in range(60)]
    intervals += [(1, 900 + n, 0, 9) for n in range(30)] + [(1, 950, None, 9), (1, 951, 0, None), (None, 952, 0, 9)]
    assert both(spark, points, intervals, width=width, keys=["k"], bin_rows=bin_rows) == plain(points, intervals, True)
    p, i = [(0, *r[1:]) for r in points], [(0, *r[1:]) for r in intervals]
    assert both(spark, p, i, width=width, keys=["k"], bin_rows=bin_rows) == plain(p, i, True)


def test_a_full_bin_is_dealt_to_parts(spark):
    points = spark.range(6000).select(F.col("id").alias("p_id"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("p"))
    intervals = spark.range(40).select(F.col("id").alias("i_id"), F.lit(0).cast("long").alias("low"), F.lit(9).cast("long").alias("high"))
    found = interval_join(points, intervals, "p", "low", "high", width=10, bin_rows=100)
    assert found.count() == 40 * points.filter("p between 0 and 9").count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    dealt = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in dealt


def test_columns_on_both_sides_are_refused(spark):
    p = spark.createDataFrame([(1, 2)], "x long, p long")
    with pytest.raises(ValueError, match="x"):
        interval_join(p, spark.createDataFrame([(1, 0, 3)], "x long, low long, high long"), "p", "low", "high", width=1)


def test_times_are_compared_exactly(spark):
    at = [dt.datetime(2024, 1, 1, 23, 59), dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 3, 0, 1), dt.datetime(2024, 1, 2, 12)]
    p = spark.createDataFrame([(a,) for a in at], "p timestamp_ntz")
    i = spark.createDataFrame([(dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3))], "low timestamp_ntz, high timestamp_ntz")
    assert sorted(r["p"] for r in interval_join(p, i, "p", "low", "high", width=30, axis=days).collect()) == [at[3], at[1]]


def test_models_use_it_without_a_nested_loop(small_sources):
    s = small_sources
    months = M.range_join_months(s.subscriptions, s.users, s.plans, s.channel_cac, s.settings)
    series = M.mart_economics(s.subscriptions, s.users, s.plans, s.channel_cac, s.settings).select(*months.columns)
    assert months.exceptAll(series).count() == 0 == series.exceptAll(months).count()
    for df in (months, experiment_eligibility(s.users, s.experiments)):
        assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()
