"""Subscription lifecycle rules as table operators: normalised MRR, status,
trial period, and the lifecycle event log derived from users and
subscriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.functions.dates import add_days_ts
from churnlab.functions.scalar import hash_bucket
from churnlab.sources.lookups import TRIAL_DAYS_LONG, TRIAL_DAYS_SHORT


def normalized_mrr_expr(price: F.Column, billing_period: F.Column, converted: F.Column) -> F.Column:
    """Monthly price, or price / 12 for annual plans, to 2 places (decimal);
    0 for subscriptions that never converted to paid."""
    monthly = F.when(billing_period == "annual", F.round(price / 12, 2)).otherwise(price).cast("decimal(8,2)")
    return F.when(converted, monthly).otherwise(F.lit(0).cast("decimal(8,2)"))


def normalized_mrr(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Per subscription: plan price, billing period, the MRR that the rule gives
    and whether the stored MRR is the same."""
    p = plans.select("plan_id", "price_monthly", "billing_period")
    j = subscriptions.select("subscription_id", "plan_id", "converted_to_paid", "mrr").join(p, "plan_id", "left")
    rule = normalized_mrr_expr(F.col("price_monthly"), F.col("billing_period"), F.col("converted_to_paid"))
    return j.select(
        "subscription_id",
        "plan_id",
        "billing_period",
        "price_monthly",
        "converted_to_paid",
        rule.alias("normalized_mrr"),
        (F.col("mrr") == rule).alias("mrr_matches"),
    )


def status_expr(converted: F.Column, ended_at: F.Column) -> F.Column:
    """trial_expired when never converted; churned when paid and ended;
    otherwise active."""
    return (
        F.when(~F.coalesce(converted, F.lit(False)), F.lit("trial_expired"))
        .when(ended_at.isNotNull(), F.lit("churned"))
        .otherwise(F.lit("active"))
    )


def subscription_status(subscriptions: DataFrame) -> DataFrame:
    """Stored status next to the status the lifecycle rule derives."""
    derived = status_expr(F.col("converted_to_paid"), F.col("ended_at"))
    return subscriptions.select(
        "subscription_id",
        "status",
        derived.alias("derived_status"),
        (F.col("status") == derived).alias("status_matches"),
    )


def trial_period(
    subscriptions: DataFrame,
    assignments: DataFrame,
    experiments: DataFrame,
    trial_experiment: str | None,
) -> DataFrame:
    """Trial length per subscription and the trial end.

    Users in ``trial_experiment`` get the short trial in its control variant
    and the long one otherwise; everyone else gets long or short by a stable
    50/50 md5 bucket of the user (the reference draws it at random). A user that
    is assigned more than once counts as control if any of them is. Raises
    without the experiment's name.
    """
    if trial_experiment is None:
        raise ValueError("trial_period needs the name of the trial-length experiment")
    arms = (
        assignments.where(F.col("experiment_id") == trial_experiment)
        .join(experiments.select("experiment_id", "variant", "is_control"), ["experiment_id", "variant"])
        .groupBy("user_id")
        .agg(F.bool_or("is_control").alias("is_control"))
    )
    j = subscriptions.select("subscription_id", "user_id", "started_at").join(arms, "user_id", "left")
    default_days = F.when(
        hash_bucket(F.concat(F.lit("trial:"), F.col("user_id").cast("string"))) < 50, F.lit(TRIAL_DAYS_LONG)
    ).otherwise(F.lit(TRIAL_DAYS_SHORT))
    days = (
        F.when(F.col("is_control").isNull(), default_days)
        .when(F.col("is_control"), F.lit(TRIAL_DAYS_SHORT))
        .otherwise(F.lit(TRIAL_DAYS_LONG))
    )
    return j.select(
        "subscription_id",
        "user_id",
        "started_at",
        days.alias("trial_days"),
        add_days_ts(F.col("started_at"), days).alias("trial_end"),
    )


def lifecycle_events(users: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Event log implied by users and subscriptions: signup_completed for every
    user at sign-up; trial_started at the start of the user's first
    subscription; subscribed at the start of the first paid one; churned at
    that one's end when it has ended. One generate per user, no union."""
    # Earliest by (start, id), null starts last; all from one aggregate per user.
    order = F.struct(F.col("started_at").isNull(), "started_at", "subscription_id")
    paid = F.when(F.col("converted_to_paid"), order)
    firsts = subscriptions.groupBy("user_id").agg(
        F.min_by("started_at", order).alias("trial_ts"),
        F.min_by("started_at", paid).alias("paid_ts"),
        F.min_by("ended_at", paid).alias("churn_ts"),
    )
    j = users.select("user_id", "signup_timestamp").join(firsts, "user_id", "left")

    def ev(name: str, ts: str) -> F.Column:
        return F.struct(F.lit(name).alias("event_type"), F.col(ts).alias("event_timestamp"))

    events = F.array(
        ev("signup_completed", "signup_timestamp"),
        ev("trial_started", "trial_ts"),
        ev("subscribed", "paid_ts"),
        ev("churned", "churn_ts"),
    )
    return (
        j.select("user_id", F.explode(events).alias("e"))
        .where(F.col("e.event_timestamp").isNotNull())
        .select("user_id", "e.event_type", "e.event_timestamp")
    )
