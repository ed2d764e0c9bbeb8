"""The composite models: intermediate tables, marts and prototype variants.

Each model is a function of DataFrames (its ``ref()`` inputs) and explicit
settings. Shared shapes:

* one shuffle key throughout - ``user_id`` - so funnel flags, first
  subscription, outcomes and users co-partition and later joins reuse it;
* plans, CAC and experiment variants are joined without hints: the planner
  broadcasts what it knows or measures to be small;
* subscription x month is a per-row generate, not a join against a spine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.functions.dates import (
    as_date,
    date_lit,
    day_diff,
    month_diff,
    month_series,
    month_start,
    week_start,
)
from churnlab.functions.scalar import bucketize
from churnlab.operators.core import (
    active_months,
    daily_activity,
    first_per_key,
    retention_flags,
    stage_flags,
)
from churnlab.operators.intervals import days, interval_join
from churnlab.settings import Settings
from churnlab.sources.lookups import (
    ENGAGEMENT_TIERS,
    FUNNEL_STAGES,
    RETENTION_BUCKETS,
    RETENTION_WINDOWS,
)

USER_CONTEXT = ["acquisition_channel", "country", "primary_device"]
FIRST_DAYS = ["first_of_session_week", "first_of_session_month", "first_of_retention_bucket"]


# --------------------------------------------------------------------------
# intermediate


def user_funnel(users: DataFrame, events: DataFrame, week: str = "sunday", stages=FUNNEL_STAGES) -> DataFrame:
    """One row per user: profile, sign-up month/week and 0/1 stage flags."""
    base = users.select(
        "user_id",
        "signup_date",
        "signup_timestamp",
        "acquisition_channel",
        "country",
        "primary_device",
        "age",
        month_start("signup_date").alias("signup_month"),
        week_start("signup_date", week).alias("signup_week"),
    )
    return stage_flags(base, events, stages)


def user_first_sub(subscriptions: DataFrame) -> DataFrame:
    """Earliest subscription per user; ties broken by subscription_id, null
    starts last."""
    first = first_per_key(
        subscriptions,
        ["user_id"],
        [F.col("started_at").asc_nulls_last(), F.col("subscription_id").asc()],
    )
    return first.select(
        "user_id",
        "plan_id",
        F.col("started_at").alias("first_sub_started"),
        "is_trial",
        "converted_to_paid",
        F.col("mrr").alias("first_sub_mrr"),
    )


def user_conversion(subscriptions: DataFrame) -> DataFrame:
    """Per user with any subscription: converted (ever paid) and the highest
    MRR (null MRR counts as 0)."""
    return subscriptions.groupBy("user_id").agg(
        F.max(F.when(F.col("converted_to_paid"), 1).otherwise(0)).alias("converted"),
        F.max(F.coalesce(F.col("mrr"), F.lit(0).cast("decimal(8,2)"))).alias("sub_mrr"),
    )


def user_outcomes(users: DataFrame, subscriptions: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row per user: conversion, max MRR, D7 (days 7-13) and D30 (days
    30-59) retention.

    Subscriptions are reduced to one conversion row per user and sessions to
    day maps before anything meets the users, so the two never multiply each
    other. Users, conversion rows and maps then join on ``user_id`` once - all
    three hash-partitioned on it - and the retention flags are aggregated per
    user on that same partitioning (no further shuffle, and the users table is
    shuffled once). ``sessions`` may be any (user_id, session_date) activity.
    """
    conv = user_conversion(subscriptions)
    base = users.select("user_id", "signup_date", "signup_timestamp", *USER_CONTEXT).join(conv, "user_id", "left")
    out = retention_flags(base, sessions, RETENTION_WINDOWS)
    return out.select(
        "user_id",
        "signup_date",
        "signup_timestamp",
        *USER_CONTEXT,
        F.coalesce("converted", F.lit(0)).alias("converted"),
        F.coalesce("sub_mrr", F.lit(0).cast("decimal(8,2)")).alias("sub_mrr"),
        *RETENTION_WINDOWS,
    )


def assigned_outcomes(
    assignments: DataFrame, users: DataFrame, subscriptions: DataFrame, sessions: DataFrame
) -> DataFrame:
    """Outcomes of the users that are in any experiment."""
    assigned = users.join(assignments.select("user_id").distinct(), "user_id", "left_semi")
    return user_outcomes(assigned, subscriptions, sessions)


def subscription_months(
    subscriptions: DataFrame, plans: DataFrame, settings: Settings, cap=None
) -> DataFrame:
    """Paid subscriptions x active months (inclusive at both ends), with the
    plan name and a churn flag for the month the subscription ended in.
    Uncapped by default, as the reference model is."""
    paid = subscriptions.where(F.col("converted_to_paid"))
    months = active_months(paid, "started_at", "ended_at", settings.as_of, cap)
    named = months.join(plans.select("plan_id", "plan_name"), "plan_id", "left")
    churned = (F.col("status") == "churned") & (month_start("ended_at") == F.col("active_month"))
    return named.select(
        "subscription_id",
        "user_id",
        "plan_id",
        "plan_name",
        "status",
        "mrr",
        "active_month",
        "ended_at",
        F.when(churned, 1).otherwise(0).alias("churned_this_month"),
    )


def user_first_session(sessions: DataFrame, week: str = "sunday") -> DataFrame:
    """First session date per user and its month / week (the cohort)."""
    first = sessions.groupBy("user_id").agg(F.min("session_date").alias("first_session_date"))
    return first.select(
        "user_id",
        "first_session_date",
        month_start("first_session_date").alias("cohort_month"),
        week_start("first_session_date", week).alias("cohort_week"),
    )


# --------------------------------------------------------------------------
# marts


def mart_acquisition(
    users: DataFrame,
    events: DataFrame,
    subscriptions: DataFrame,
    plans: DataFrame,
    channel_cac: DataFrame,
    week: str = "sunday",
) -> DataFrame:
    """User grain: funnel flags, first subscription, its plan, channel CAC
    (0 when the channel has none). 21 columns."""
    funnel = user_funnel(users, events, week)
    first = user_first_sub(subscriptions)
    out = funnel.join(first.drop("is_trial"), "user_id", "left")
    out = out.join(plans.select("plan_id", "plan_name", "billing_period"), "plan_id", "left")
    out = out.join(channel_cac, "acquisition_channel", "left")
    return out.select(
        *funnel.columns,
        "plan_id",
        "first_sub_started",
        "converted_to_paid",
        "first_sub_mrr",
        "plan_name",
        "billing_period",
        F.coalesce(F.col("channel_cac"), F.lit(0)).alias("channel_cac"),
    )


def acquisition_profile(users: DataFrame, events: DataFrame, channel_cac: DataFrame, week: str = "sunday") -> DataFrame:
    """The part of the acquisition mart that needs no subscription: funnel flags
    and channel CAC. What the acquisition metrics read."""
    out = user_funnel(users, events, week).join(channel_cac, "acquisition_channel", "left")
    return out.withColumn("channel_cac", F.coalesce(F.col("channel_cac"), F.lit(0)))


def engagement_days(sessions: DataFrame, week: str = "sunday") -> DataFrame:
    """Daily activity plus each user's first session date, and whether the day is
    the user's first of its week, its month and its retention bucket.

    All are windows over the user's day rows - at most one row per calendar day
    per user, one partitioning - so sessions are scanned once and a heavy user
    is spread over (user, day) keys in the first shuffle.
    """
    in_order = Window.partitionBy("user_id").orderBy("session_date")
    days = daily_activity(sessions).withColumn("first_session_date", F.min("session_date").over(in_order))
    since = day_diff("session_date", "first_session_date")
    days = days.select(
        "*",
        week_start("session_date", week).alias("session_week"),
        month_start("session_date").alias("session_month"),
        since.alias("days_since_first"),
        bucketize(since, RETENTION_BUCKETS).alias("retention_bucket"),
    )
    # In date order each of the three only ever moves on, so a day that differs
    # from the day before is the first one.

    def first_of(period: str) -> Column:
        return (~F.col(period).eqNullSafe(F.lag(period).over(in_order))).alias(f"first_of_{period}")

    return days.select("*", *[first_of(p) for p in ("session_week", "session_month", "retention_bucket")])


def mart_engagement(users: DataFrame, sessions: DataFrame, week: str = "sunday") -> DataFrame:
    """User-day grain: activity, user context, cohort (month/week of the first
    session), days since first session, retention bucket, engagement tier."""
    return user_days(users, sessions, week).drop(*FIRST_DAYS)


def user_days(users: DataFrame, sessions: DataFrame, week: str = "sunday") -> DataFrame:
    """The engagement mart with the first-day flags that active-user and cohort
    counts add up (see ``engagement_days``)."""
    days = engagement_days(sessions, week)
    out = days.join(users.select("user_id", *USER_CONTEXT), "user_id", "inner")
    return out.select(
        "user_id",
        "session_date",
        "session_week",
        "session_month",
        "session_count",
        "total_minutes",
        "devices_used",
        "devices_list",
        *USER_CONTEXT,
        "first_session_date",
        month_start("first_session_date").alias("cohort_month"),
        week_start("first_session_date", week).alias("cohort_week"),
        "days_since_first",
        "retention_bucket",
        bucketize(F.col("total_minutes"), ENGAGEMENT_TIERS).alias("engagement_tier"),
        *FIRST_DAYS,
    )


def paid_subscriptions(
    subscriptions: DataFrame, users: DataFrame, plans: DataFrame, channel_cac: DataFrame
) -> DataFrame:
    """Converted subscriptions of known users and plans, with user context,
    plan, start month and channel CAC (0 when missing)."""
    paid = subscriptions.where(F.col("converted_to_paid"))
    out = paid.join(users.select("user_id", *USER_CONTEXT), "user_id", "inner")
    out = out.join(plans.select("plan_id", "plan_name", "billing_period"), "plan_id", "inner")
    out = out.join(channel_cac, "acquisition_channel", "left")
    return out.select(
        "subscription_id",
        "user_id",
        "plan_id",
        "plan_name",
        "billing_period",
        *USER_CONTEXT,
        "started_at",
        "ended_at",
        "status",
        "mrr",
        F.coalesce(F.col("channel_cac"), F.lit(0)).alias("channel_cac"),
        month_start("started_at").alias("sub_start_month"),
    )


def mart_economics(
    subscriptions: DataFrame,
    users: DataFrame,
    plans: DataFrame,
    channel_cac: DataFrame,
    settings: Settings,
    cap="settings",
    dealt: bool = False,
) -> DataFrame:
    """Paid subscription x active month with MRR, CAC and tenure in months.

    Months run from the start month to the end month (or as_of), cut at the
    cap. Equal to the reference's range join against a global month spine:
    the spine starts at the earliest start month (never cuts a row's lower
    end) and its top is the larger of all end months capped, so only the cap
    binds - which the per-row series applies directly. ``dealt``: rebalanced for a
    table by month (``active_months``).
    """
    cap = settings.cap if cap == "settings" else cap
    ps = paid_subscriptions(subscriptions, users, plans, channel_cac)
    months = active_months(ps, "started_at", "ended_at", settings.as_of, cap, dealt=dealt)
    return months.select(
        "subscription_id",
        "user_id",
        "plan_id",
        "plan_name",
        "billing_period",
        *USER_CONTEXT,
        "started_at",
        "ended_at",
        "status",
        "mrr",
        "channel_cac",
        "sub_start_month",
        "active_month",
        month_diff("active_month", "sub_start_month").alias("tenure_months"),
    )


def month_spine(
    subscriptions: DataFrame,
    users: DataFrame,
    plans: DataFrame,
    settings: Settings,
    cap="settings",
) -> DataFrame:
    """One row per month from the earliest paid start month to the latest
    end month (or as_of), capped. A single global aggregate, then a generate."""
    cap = settings.cap if cap == "settings" else cap
    paid = (
        subscriptions.where(F.col("converted_to_paid"))
        .join(users.select("user_id"), "user_id", "left_semi")
        .join(plans.select("plan_id"), "plan_id", "left_semi")
    )
    top = month_start(F.max(F.coalesce(as_date("ended_at"), date_lit(settings.as_of))))
    if cap is not None:
        top = F.least(top, month_start(date_lit(cap)))
    bounds = paid.agg(month_start(F.min(as_date("started_at"))).alias("lo"), top.alias("hi"))
    return bounds.select(F.explode(month_series(F.col("lo"), F.col("hi"))).alias("active_month"))


def range_join_months(
    subscriptions: DataFrame,
    users: DataFrame,
    plans: DataFrame,
    channel_cac: DataFrame,
    settings: Settings,
    cap="settings",
) -> DataFrame:
    """Subscription x month where start month <= month <= end month: an interval join
    of the paid subscriptions with the month spine, as the prototype view has it.
    (subscription_id, active_month, tenure_months)

    The same months as the economics mart's, which generates them for each
    subscription; here neither side is bounded by the other.
    """
    paid = paid_subscriptions(subscriptions, users, plans, channel_cac)
    last = month_start(F.coalesce(as_date("ended_at"), date_lit(settings.as_of))).alias("last_month")
    spans = paid.select("subscription_id", "sub_start_month", last)
    spine = month_spine(subscriptions, users, plans, settings, cap)
    found = interval_join(spine, spans, "active_month", "sub_start_month", "last_month", width=366, axis=days)
    return found.select("subscription_id", "active_month", month_diff("active_month", "sub_start_month").alias("tenure_months"))


def mart_experiments(
    assignments: DataFrame,
    experiments: DataFrame,
    outcomes: DataFrame,
    week: str = "sunday",
) -> DataFrame:
    """Experiment x user: variant, control flag, assignment week/month and the
    user's outcomes. Outcomes stay null for users missing from the user table;
    revenue_per_assigned = coalesce(sub_mrr, 0) * converted."""
    exps = experiments.select("experiment_id", "variant", "experiment_name", "is_control")
    out = assignments.join(exps, ["experiment_id", "variant"])
    out = out.join(
        outcomes.select("user_id", "converted", "retained_d7", "retained_d30", "sub_mrr"), "user_id", "left"
    )
    revenue = (F.coalesce(F.col("sub_mrr"), F.lit(0).cast("decimal(8,2)")) * F.col("converted")).cast(
        "decimal(12,2)"
    )
    return out.select(
        "experiment_id",
        "experiment_name",
        "variant",
        "is_control",
        "user_id",
        "assigned_at",
        week_start(as_date("assigned_at"), week).alias("assigned_week"),
        month_start("assigned_at").alias("assigned_month"),
        "converted",
        "retained_d7",
        "retained_d30",
        "sub_mrr",
        revenue.alias("revenue_per_assigned"),
    )
