"""Calendar and scalar functions: edge rows from the fixture notes."""

import datetime as dt

import duckdb
from pyspark.sql import functions as F

from churnlab.functions import bucketize, hash_bucket, month_diff, month_series, week_start
from churnlab.sources.lookups import ENGAGEMENT_TIERS, RETENTION_BUCKETS

D = dt.date


def test_week_start_sunday_and_monday(spark):
    df = spark.createDataFrame([(D(2024, 6, 2),), (D(2024, 6, 8),)], "d date")
    rows = df.select(
        "d", week_start("d", "sunday").alias("sun"), week_start("d", "monday").alias("mon")
    ).orderBy("d").collect()
    assert [(r.sun, r.mon) for r in rows] == [
        (D(2024, 6, 2), D(2024, 5, 27)),
        (D(2024, 6, 2), D(2024, 6, 3)),
    ]


def test_month_diff_counts_boundaries(spark):
    df = spark.createDataFrame([(D(2024, 1, 31), D(2024, 2, 1)), (D(2023, 12, 15), D(2025, 1, 1))], "a date, b date")
    got = [r.m for r in df.select(month_diff("b", "a").alias("m")).collect()]
    assert got == [1, 13]


def test_month_series_empty_when_reversed(spark):
    df = spark.createDataFrame(
        [(D(2024, 1, 31), D(2024, 3, 1)), (D(2024, 5, 1), D(2024, 3, 1)), (D(2024, 5, 1), None)],
        "lo date, hi date",
    )
    got = [r.s for r in df.select(month_series(F.col("lo"), F.col("hi")).alias("s")).collect()]
    assert got[0] == [D(2024, 1, 1), D(2024, 2, 1), D(2024, 3, 1)]
    assert got[1] is None and got[2] is None
    assert df.select(F.explode(month_series(F.col("lo"), F.col("hi")))).count() == 3


def test_retention_buckets_and_tiers(spark):
    days = [0, 1, 6, 7, 13, 14, 29, 30, 59, 60, 89, 90, 400]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    got = [r.b for r in df.select(bucketize(F.col("d"), RETENTION_BUCKETS).alias("b")).orderBy("d").collect()]
    assert got == ["D0", "D1-6", "D1-6", "D7-13", "D7-13", "D14-29", "D14-29", "D30-59", "D30-59",
                   "D60-89", "D60-89", "D90+", "D90+"]
    mins = spark.createDataFrame([(m,) for m in [0, 29, 30, 119, 120, 500]], "m bigint")
    tiers = [r.t for r in mins.select(bucketize(F.col("m"), ENGAGEMENT_TIERS).alias("t")).orderBy("m").collect()]
    assert tiers == ["casual", "casual", "regular", "regular", "power_user", "power_user"]


def test_bucketize_without_match_is_null(spark):
    df = spark.createDataFrame([(-1,)], "d int")
    assert df.select(bucketize(F.col("d"), RETENTION_BUCKETS).alias("b")).first().b is None


def test_hash_bucket_matches_duckdb(spark):
    keys = [f"exp_a:{i}" for i in range(50)] + ["trial:7", "exp_b:v:123"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    ours = {r.k: r.b for r in df.select("k", hash_bucket(F.col("k")).alias("b")).collect()}
    con = duckdb.connect()
    for k in keys:
        theirs = con.execute(f"SELECT CAST(('0x' || substr(md5('{k}'), 1, 8)) AS BIGINT) % 100").fetchone()[0]
        assert ours[k] == theirs
    assert all(0 <= v < 100 for v in ours.values())
