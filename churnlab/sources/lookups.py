"""Small inline lookup tables and value domains.

Every table here is a literal of a handful of rows: the planner knows its size.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DecimalType,
    StringType,
    StructField,
    StructType,
)

from churnlab.sources.schemas import SCHEMAS

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# Plans: plan_id, plan_name, price_monthly, billing_period, max_streams, resolution
PLANS = [
    (1, "Basic", "7.99", "monthly", 1, "HD"),
    (2, "Standard", "12.99", "monthly", 2, "HD"),
    (3, "Premium", "17.99", "monthly", 4, "4K"),
    (4, "Annual", "119.99", "annual", 4, "4K"),
]
# Channel acquisition cost seed: acquisition_channel, channel_cac
CHANNEL_CAC = [
    ("organic", 0),
    ("referral", 5),
    ("email", 3),
    ("affiliate", 12),
    ("display", 18),
    ("paid_social", 22),
    ("paid_search", 28),
]
# Accepted values declared by the data tests.
ACCEPTED_CHANNELS = ["organic", "paid_search", "paid_social", "email", "referral", "affiliate", "display"]
ACCEPTED_STATUSES = ["active", "churned", "trial_expired", "trialing"]
DEVICES = ["mobile", "desktop", "smart_tv", "tablet"]
# Funnel stage flag -> event type, in funnel order.
FUNNEL_STAGES = {
    "reached_signup": "signup_completed",
    "reached_trial": "trial_started",
    "reached_paywall": "paywall_view",
    "reached_subscribe_click": "subscribe_clicked",
    "reached_paid": "subscribed",
}
# Retention windows after signup, half-open day ranges [lo, hi).
RETENTION_WINDOWS = {"retained_d7": (7, 14), "retained_d30": (30, 60)}
# Days since first session -> retention bucket (closed ranges, first match).
RETENTION_BUCKETS = [
    ("D0", 0, 0),
    ("D1-6", 1, 6),
    ("D7-13", 7, 13),
    ("D14-29", 14, 29),
    ("D30-59", 30, 59),
    ("D60-89", 60, 89),
    ("D90+", 90, None),
]
# Minutes per user-day -> engagement tier (first match).
ENGAGEMENT_TIERS = [("power_user", 120, None), ("regular", 30, None), ("casual", None, None)]
# Trial lengths: default 14 or 7 days; the trial-length experiment's control
# gets 7 days and its treatment 14.
TRIAL_DAYS_LONG, TRIAL_DAYS_SHORT = 14, 7
# Experiment inclusion share of eligible users, in percent.
EXPERIMENT_INCLUSION_PCT = 80
# ---------------------------------------------------------------------------


def literal_table(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A small table built from literals: one generated row per literal row
    over a one-row range. No file scan, and its size is fixed by the literal.
    """
    if not rows:
        return spark.createDataFrame([], schema)

    def typed(value, f: StructField):
        if isinstance(f.dataType, ArrayType):
            return F.array(*[F.lit(v) for v in value]).cast(f.dataType).alias(f.name)
        return F.lit(value).cast(f.dataType).alias(f.name)

    structs = [F.struct(*[typed(v, f) for v, f in zip(row, schema.fields)]) for row in rows]
    out = spark.range(1).select(F.inline(F.array(*structs)))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def plans_df(spark: SparkSession) -> DataFrame:
    rows = [(i, n, Decimal(p), b, s, r) for i, n, p, b, s, r in PLANS]
    return literal_table(spark, rows, SCHEMAS["plans"])


def channel_cac_df(spark: SparkSession, rows: list[tuple[str, int]] | None = None) -> DataFrame:
    return literal_table(spark, rows if rows is not None else CHANNEL_CAC, SCHEMAS["channel_cac"])


EXPERIMENT_DEF_SCHEMA = StructType(
    [
        StructField("experiment_id", StringType(), False),
        StructField("experiment_name", StringType(), True),
        StructField("start_date", SCHEMAS["experiments"]["start_date"].dataType, True),
        StructField("end_date", SCHEMAS["experiments"]["end_date"].dataType, True),
        StructField("variants", ArrayType(StringType(), False), False),
    ]
)

EFFECT_SCHEMA = StructType(
    [
        StructField("experiment_id", StringType(), False),
        StructField("variant", StringType(), False),
        StructField("signup_lift", DecimalType(6, 3), False),
        StructField("d30_retention_lift", DecimalType(6, 3), False),
    ]
)


def experiment_definitions_df(spark: SparkSession, definitions: list[tuple]) -> DataFrame:
    """Nested experiment definitions: one row per experiment, variants as an array."""
    return literal_table(spark, definitions, EXPERIMENT_DEF_SCHEMA)


def experiment_effects_df(spark: SparkSession, effects: list[tuple]) -> DataFrame:
    """(experiment_id, variant) -> lifts; variants without a row have none."""
    return literal_table(spark, [(e, v, Decimal(a), Decimal(b)) for e, v, a, b in effects], EFFECT_SCHEMA)


# Lookups of our own for the driver's test tables (FIXTURES.md section 2): the
# acquisition channels there are the five customer market segments.
FIXTURE_CHANNELS = ["automobile", "building", "furniture", "household", "machinery"]
FIXTURE_CHANNEL_CAC = [
    ("automobile", 0),
    ("building", 7),
    ("furniture", 13),
    ("household", 31),
]
# experiment_id, name, first day, last day, variants
FIXTURE_EXPERIMENTS = [
    ("trial_weeks", "Weeks of trial", dt.date(1995, 3, 1), dt.date(1995, 9, 30), ["control_one", "four", "two"]),
    ("tile_order", "Order of home tiles", dt.date(1995, 8, 1), dt.date(1996, 4, 30), ["control_fixed", "shuffled"]),
    ("price_note", "Note beside the price", dt.date(1996, 2, 1), dt.date(1996, 6, 15), ["control_none", "long_note", "short_note"]),
]
# experiment_id, variant, lift of sign-ups, lift of day-30 retention
FIXTURE_EFFECTS = [
    ("trial_weeks", "two", "0.015", "0.040"),
    ("trial_weeks", "four", "0.035", "-0.010"),
    ("tile_order", "shuffled", "-0.020", "0.005"),
    ("price_note", "short_note", "0.070", "0.000"),
]
FIXTURE_TRIAL_EXPERIMENT = "trial_weeks"
