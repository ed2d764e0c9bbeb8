"""Experiment table rules: variant rows, eligibility, stable assignment, effects.

The reference draws the 80% sample and the variant with a seeded random
generator in one process. Here both come from md5 buckets of the
(experiment, user) pair, so assignment is stable, needs no coordination
between tasks, and can be recomputed by any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.functions.scalar import hash_bucket, hash_value
from churnlab.operators.intervals import days, interval_join
from churnlab.sources.lookups import EXPERIMENT_INCLUSION_PCT


def experiment_variants(definitions: DataFrame) -> DataFrame:
    """Nested definitions (one row per experiment, ``variants`` array) -> one
    row per variant; ``is_control`` from the 'control' name prefix."""
    return definitions.select(
        "experiment_id",
        "experiment_name",
        F.explode("variants").alias("variant"),
        "start_date",
        "end_date",
    ).select(
        "experiment_id",
        "experiment_name",
        "variant",
        "start_date",
        "end_date",
        F.col("variant").startswith("control").alias("is_control"),
    )


def _experiment_windows(experiments: DataFrame) -> DataFrame:
    return experiments.groupBy("experiment_id").agg(
        F.min("start_date").alias("start_date"),
        F.max("end_date").alias("end_date"),
    )


def experiment_eligibility(users: DataFrame, experiments: DataFrame) -> DataFrame:
    """(experiment_id, user_id, signup_timestamp) for users who signed up in
    the experiment window.

    The window is closed on timestamps: start date at midnight up to *end date
    at midnight*, so sign-ups later on the last day fall out, as in the
    reference. An interval join with bins of a quarter: neither the windows nor
    the sign-ups in one are bounded.
    """
    windows = _experiment_windows(experiments).select(
        "experiment_id",
        F.col("start_date").cast("timestamp_ntz").alias("_from"),
        F.col("end_date").cast("timestamp_ntz").alias("_to"),
    )
    signups = users.select("user_id", "signup_timestamp")
    found = interval_join(signups, windows, "signup_timestamp", "_from", "_to", width=91, axis=days)
    return found.select("experiment_id", "user_id", "signup_timestamp")


def assign_variants(
    eligible: DataFrame,
    experiments: DataFrame,
    inclusion_pct: int = EXPERIMENT_INCLUSION_PCT,
) -> DataFrame:
    """Stable inclusion and even variant split.

    A user is in the experiment when md5 bucket of 'experiment:user' is below
    ``inclusion_pct``; the variant index is the 32-bit md5 value of
    'experiment:v:user' modulo the number of variants (an even split for any
    number), controls first. ``assigned_at`` = sign-up time.
    """
    # Controls sort first: false before true.
    place = F.struct((~F.col("is_control")).alias("other"), "variant")
    variants = experiments.groupBy("experiment_id").agg(F.sort_array(F.collect_list(place)).alias("variants"))
    uid, eid = F.col("user_id").cast("string"), F.col("experiment_id")
    index = hash_value(F.concat(eid, F.lit(":v:"), uid)) % F.size("variants")
    included = eligible.where(hash_bucket(F.concat(eid, F.lit(":"), uid)) < F.lit(inclusion_pct))
    return included.join(variants, "experiment_id").select(
        "experiment_id",
        "user_id",
        F.element_at("variants", (index + 1).cast("int"))["variant"].alias("variant"),
        F.col("signup_timestamp").alias("assigned_at"),
    )


def experiment_effects(users: DataFrame, assignments: DataFrame, effects: DataFrame | None) -> DataFrame:
    """Per user: summed signup and D30 retention lifts over all experiments the
    user is in; 0 for users in none. Lifts are decimals, so sums are exact.
    Raises without an effects table: no effects given is not "no effect"."""
    if effects is None:
        raise ValueError("experiment_effects needs a table of effects (experiment_id, variant, signup_lift, d30_retention_lift)")
    per_user = (
        assignments.select("experiment_id", "variant", "user_id")
        .join(effects, ["experiment_id", "variant"])
        .groupBy("user_id")
        .agg(
            F.sum("signup_lift").alias("signup_lift"),
            F.sum("d30_retention_lift").alias("d30_retention_lift"),
        )
    )
    out = users.select("user_id").join(per_user, "user_id", "left")
    zero = F.lit(0).cast("decimal(16,3)")
    return out.select(
        "user_id",
        F.coalesce(F.col("signup_lift"), zero).cast("decimal(16,3)").alias("signup_lift"),
        F.coalesce(F.col("d30_retention_lift"), zero).cast("decimal(16,3)").alias("d30_retention_lift"),
    )
