"""Dashboard metrics computed from the marts.

The reference names these metrics but computes them in its BI tool, so the
formulas are fixed here (docstrings). Every metric stays a DataFrame. Totals
come from scalar subqueries (planned once, no cross join); shares within a
period use a window partitioned by the period over already-aggregated rows.
Ratios use exact integer/decimal sums divided once as doubles, so they do not
depend on summation order; a zero denominator gives null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlab.functions.dates import month_start
from churnlab.functions.scalar import ratio, two_sided_p
from churnlab.sources.lookups import FUNNEL_STAGES

STAGE_NAMES = ["signup", "trial", "paywall", "subscribe_click", "paid"]


def funnel_summary(acquisition: DataFrame) -> DataFrame:
    """Users per funnel stage, in funnel order.

    step_rate = users at this stage / users at the previous stage (the first
    stage divides by all users); overall_rate = users / all users.
    """
    flags = list(FUNNEL_STAGES)
    agg = acquisition.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.sum(f).cast("bigint").alias(f) for f in flags],
    )
    rows = []
    prev = F.col("_total")
    for i, (flag, name) in enumerate(zip(flags, STAGE_NAMES), start=1):
        rows.append(
            F.struct(
                F.lit(i).alias("stage_order"),
                F.lit(name).alias("stage"),
                F.col(flag).alias("users"),
                ratio(F.col(flag), prev).alias("step_rate"),
                ratio(F.col(flag), F.col("_total")).alias("overall_rate"),
            )
        )
        prev = F.col(flag)
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def channel_performance(acquisition: DataFrame) -> DataFrame:
    """Per channel: sign-ups, paid users (reached the 'subscribed' stage),
    conversion, CAC, spend = sign-ups x CAC, cost per paid user."""
    g = acquisition.groupBy("acquisition_channel").agg(
        F.count(F.lit(1)).alias("signups"),
        F.sum("reached_paid").cast("bigint").alias("paid_users"),
        F.max("channel_cac").alias("channel_cac"),
    )
    spend = (F.col("signups") * F.col("channel_cac")).cast("bigint")
    return g.select(
        "acquisition_channel",
        "signups",
        "paid_users",
        ratio(F.col("paid_users"), F.col("signups")).alias("conversion_rate"),
        "channel_cac",
        spend.alias("spend"),
        ratio(spend, F.col("paid_users")).alias("cost_per_paid"),
    )


def signups_over_time(acquisition: DataFrame) -> DataFrame:
    """(grain, period_start, channel): sign-ups and paid users per sign-up month
    and per sign-up week."""
    counts = [F.count(F.lit(1)).alias("signups"), F.sum("reached_paid").cast("bigint").alias("paid_users")]
    # Week and channel first; month and week do not nest, so both are grouped sets.
    g = acquisition.groupingSets(
        [["signup_month", "acquisition_channel"], ["signup_week", "acquisition_channel"]],
        "signup_month", "signup_week", "acquisition_channel",
    ).agg(*counts, F.grouping("signup_month").alias("_by_week"))
    by_week = F.col("_by_week") == 1
    return g.select(
        F.when(by_week, F.lit("week")).otherwise(F.lit("month")).alias("grain"),
        F.when(by_week, F.col("signup_week")).otherwise(F.col("signup_month")).alias("period_start"),
        "acquisition_channel",
        "signups",
        "paid_users",
    )


def geo_distribution(acquisition: DataFrame) -> DataFrame:
    """Per country: users, paid users, share of all users, conversion. The total
    is a window over the few country rows."""
    g = acquisition.groupBy("country").agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("reached_paid").cast("bigint").alias("paid_users"),
    )
    total = F.sum("users").over(Window.partitionBy(F.lit(1)))
    return g.select(
        "country",
        "users",
        "paid_users",
        ratio(F.col("users"), total).alias("user_share"),
        ratio(F.col("paid_users"), F.col("users")).alias("conversion_rate"),
    )


def _flagged(flag: str) -> Column:
    return F.count_if(F.col(flag))


def cohort_retention(user_days: DataFrame) -> DataFrame:
    """Cohort month x retention bucket: distinct active users, cohort size (users
    whose first session is in the month), and their ratio.

    A user's first day in a bucket stands for the user, and its first day of all
    for its place in the cohort: map-side sums over the mart, which is scanned
    once. Sessions of users missing from the user table are in neither number,
    as the mart leaves them out.
    """
    g = user_days.groupBy("cohort_month", "retention_bucket").agg(_flagged("first_of_retention_bucket").alias("active_users"))
    first = F.when(F.col("retention_bucket") == "D0", F.col("active_users"))
    size = F.max(first).over(Window.partitionBy("cohort_month"))
    return g.select(
        "cohort_month",
        "retention_bucket",
        "active_users",
        size.alias("cohort_size"),
        ratio(F.col("active_users"), size).alias("retention_rate"),
    )


def active_users(user_days: DataFrame) -> DataFrame:
    """(grain, period_start, active_users) for day, week and month grains.

    The mart is one row per user-day and flags each user's first day of a week
    and month, so distinct users are sums of flags per day (map-side combined),
    and weeks and months are sums of their days.
    """
    days = user_days.groupBy("session_date", "session_week", "session_month").agg(
        F.count(F.lit(1)).alias("day"),
        _flagged("first_of_session_week").alias("week"),
        _flagged("first_of_session_month").alias("month"),
    )
    periods = {"day": "session_date", "week": "session_week", "month": "session_month"}
    rows = F.array(*[F.struct(F.lit(g).alias("grain"), F.col(c).alias("period_start"), F.col(g).alias("n")) for g, c in periods.items()])
    each = days.select(F.explode(rows).alias("r")).select("r.*")
    return each.groupBy("grain", "period_start").agg(F.sum("n").alias("active_users"))


def stickiness(user_days: DataFrame) -> DataFrame:
    """Per month: MAU, mean DAU over the days with activity, DAU/MAU, all from
    one row per day (see ``active_users``)."""
    days = user_days.groupBy("session_month", "session_date").agg(
        F.count(F.lit(1)).alias("dau"), _flagged("first_of_session_month").alias("new")
    )
    g = days.groupBy("session_month").agg(
        F.sum("dau").alias("_user_days"), F.count(F.lit(1)).alias("active_days"), F.sum("new").alias("mau")
    )
    avg_dau = ratio(F.col("_user_days"), F.col("active_days"))
    return g.select(
        "session_month",
        "mau",
        "active_days",
        avg_dau.alias("avg_dau"),
        (avg_dau / F.col("mau").cast("double")).alias("stickiness"),
    )


def engagement_tiers(engagement: DataFrame) -> DataFrame:
    """User-days per month and tier, and the tier's share of the month."""
    g = engagement.groupBy("session_month", "engagement_tier").agg(F.count(F.lit(1)).alias("user_days"))
    month_total = F.sum("user_days").over(Window.partitionBy("session_month"))
    return g.select(
        "session_month",
        "engagement_tier",
        "user_days",
        ratio(F.col("user_days"), month_total).alias("share"),
    )


def device_mix(sessions: DataFrame) -> DataFrame:
    """Sessions and minutes per month and device."""
    return sessions.groupBy(month_start("session_date").alias("session_month"), "device").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("duration_minutes").cast("bigint").alias("total_minutes"),
    )


def mrr_trend(economics: DataFrame) -> DataFrame:
    """Per active month: active subscriptions, MRR, new (tenure 0) and churned
    (ended that month with status churned) subscriptions."""
    churned = (F.col("status") == "churned") & (month_start("ended_at") == F.col("active_month"))
    return economics.groupBy("active_month").agg(
        F.count(F.lit(1)).alias("active_subs"),
        F.sum("mrr").cast("decimal(18,2)").alias("mrr"),
        F.count_if(F.col("tenure_months") == 0).alias("new_subs"),
        F.count_if(churned).alias("churned_subs"),
    )


def ltv_cac(economics: DataFrame) -> DataFrame:
    """Per channel: revenue = MRR summed over subscription-months; LTV =
    revenue / distinct paying users; LTV/CAC, null when CAC is 0."""
    g = economics.groupBy("acquisition_channel").agg(
        F.count_distinct("user_id").alias("paid_users"),
        F.count(F.lit(1)).alias("subscription_months"),
        F.sum("mrr").cast("decimal(18,2)").alias("revenue"),
        F.max("channel_cac").alias("channel_cac"),
    )
    ltv = ratio(F.col("revenue"), F.col("paid_users"))
    return g.select(
        "acquisition_channel",
        "paid_users",
        "subscription_months",
        "revenue",
        ltv.alias("ltv"),
        "channel_cac",
        F.try_divide(ltv, F.nullif(F.col("channel_cac"), F.lit(0)).cast("double")).alias("ltv_cac"),
    )


def churn_rate(subscription_months: DataFrame, benchmark: float) -> DataFrame:
    """Per month: active and churned subscriptions, churn rate, and whether it
    is above ``benchmark``."""
    g = subscription_months.groupBy("active_month").agg(
        F.count(F.lit(1)).alias("active_subs"),
        F.sum("churned_this_month").cast("bigint").alias("churned_subs"),
    )
    rate = ratio(F.col("churned_subs"), F.col("active_subs"))
    return g.select(
        "active_month",
        "active_subs",
        "churned_subs",
        rate.alias("churn_rate"),
        (rate > F.lit(benchmark)).alias("above_benchmark"),
    )


def plan_mix(economics: DataFrame) -> DataFrame:
    """Per month and plan: subscriptions and MRR, and their shares of the month."""
    g = economics.groupBy("active_month", "plan_name").agg(
        F.count(F.lit(1)).alias("subs"),
        F.sum("mrr").cast("decimal(18,2)").alias("mrr"),
    )
    w = Window.partitionBy("active_month")
    return g.select(
        "active_month",
        "plan_name",
        "subs",
        "mrr",
        ratio(F.col("subs"), F.sum("subs").over(w)).alias("subs_share"),
        ratio(F.col("mrr"), F.sum("mrr").over(w)).alias("mrr_share"),
    )


def revenue_retention(economics: DataFrame) -> DataFrame:
    """Start-month cohort x tenure: active subs, MRR, the cohort's month-0 MRR
    and MRR retention = MRR / month-0 MRR."""
    g = economics.groupBy("sub_start_month", "tenure_months").agg(
        F.count(F.lit(1)).alias("active_subs"),
        F.sum("mrr").cast("decimal(18,2)").alias("mrr"),
    )
    base = F.max(F.when(F.col("tenure_months") == 0, F.col("mrr"))).over(Window.partitionBy("sub_start_month"))
    return g.select(
        "sub_start_month",
        "tenure_months",
        "active_subs",
        "mrr",
        base.alias("base_mrr"),
        ratio(F.col("mrr"), base).alias("mrr_retention"),
    )


def experiment_results(experiments_mart: DataFrame) -> DataFrame:
    """Per experiment and variant: assigned users, users with outcomes,
    conversions and rates (over users with outcomes), revenue per assigned."""
    g = experiments_mart.groupBy("experiment_id", "variant", "is_control").agg(
        F.count(F.lit(1)).alias("assigned_users"),
        F.count("converted").alias("measured_users"),
        F.sum("converted").cast("bigint").alias("conversions"),
        F.sum("retained_d7").cast("bigint").alias("retained_d7_users"),
        F.sum("retained_d30").cast("bigint").alias("retained_d30_users"),
        F.sum("revenue_per_assigned").cast("decimal(18,2)").alias("revenue"),
    )
    return g.select(
        "experiment_id",
        "variant",
        "is_control",
        "assigned_users",
        "measured_users",
        "conversions",
        ratio(F.col("conversions"), F.col("measured_users")).alias("conversion_rate"),
        ratio(F.col("retained_d7_users"), F.col("measured_users")).alias("d7_rate"),
        ratio(F.col("retained_d30_users"), F.col("measured_users")).alias("d30_rate"),
        ratio(F.col("revenue"), F.col("measured_users")).alias("revenue_per_assigned"),
    )


def _with_control(results: DataFrame) -> DataFrame:
    """Non-control variant rows with their experiment's control figures beside
    them: a window over the few variant rows of each experiment (no self
    join, so the results are computed once). Experiments without a control
    variant have nothing to compare with and give no rows."""
    w = Window.partitionBy("experiment_id")

    def control(col: str) -> Column:
        return F.max(F.when(F.col("is_control"), F.col(col))).over(w)

    out = results.select(
        "*",
        F.max(F.col("is_control").cast("int")).over(w).alias("_has_control"),
        control("measured_users").alias("control_users"),
        control("conversions").alias("control_conversions"),
        control("conversion_rate").alias("control_conversion_rate"),
        control("d30_rate").alias("control_d30_rate"),
    )
    return out.where(~F.col("is_control") & (F.col("_has_control") == 1)).drop("_has_control")


def experiment_lift(results: DataFrame) -> DataFrame:
    """Per non-control variant: its rate / the control's rate - 1 for
    conversion and D30 retention (null when the control rate is 0)."""
    j = _with_control(results)
    return j.select(
        "experiment_id",
        "variant",
        "conversion_rate",
        "control_conversion_rate",
        (F.try_divide(F.col("conversion_rate"), F.col("control_conversion_rate")) - 1).alias("conversion_lift"),
        "d30_rate",
        "control_d30_rate",
        (F.try_divide(F.col("d30_rate"), F.col("control_d30_rate")) - 1).alias("d30_lift"),
    )


def experiment_significance(results: DataFrame, z_crit: float = 1.96) -> DataFrame:
    """Two-proportion pooled z-test of conversion, variant vs control.

    p = conversions / measured users; pooled = (x1 + x2) / (n1 + n2);
    se = sqrt(pooled * (1 - pooled) * (1/n1 + 1/n2)); z = (p2 - p1) / se;
    significant when |z| >= z_crit. (A flag, not a p-value.)
    """
    j = _with_control(results)
    n1, n2 = F.col("control_users").cast("double"), F.col("measured_users").cast("double")
    x1, x2 = F.col("control_conversions").cast("double"), F.col("conversions").cast("double")
    pooled = F.try_divide(x1 + x2, n1 + n2)
    se = F.sqrt(pooled * (F.lit(1.0) - pooled) * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    z = F.try_divide(F.col("conversion_rate") - F.col("control_conversion_rate"), se)
    return j.select(
        "experiment_id",
        "variant",
        F.col("control_users").alias("n_control"),
        F.col("measured_users").alias("n_variant"),
        F.col("control_conversion_rate").alias("p_control"),
        F.col("conversion_rate").alias("p_variant"),
        pooled.alias("pooled_rate"),
        z.alias("z_score"),
        (F.abs(z) >= F.lit(z_crit)).alias("significant"),
    )


def experiment_p_values(results: DataFrame, alpha: float = 0.05) -> DataFrame:
    """The z-tests of ``experiment_significance`` as probabilities, adjusted for the
    number of variants that are compared with one control.

    p_value is two-sided. p_holm is Holm's step-down: of m variants, the one with
    the k-th smallest p_value has the greatest (m - i + 1) * p_i of i <= k, at most 1;
    significant below ``alpha``. Variants without a z-score have nulls and do not
    count. A window over the few variants of an experiment.
    """
    tested = experiment_significance(results).select("experiment_id", "variant", "z_score", two_sided_p(F.col("z_score")).alias("p_value"))
    in_order = Window.partitionBy("experiment_id").orderBy(F.col("p_value").asc_nulls_last(), "variant")
    m = F.count("p_value").over(Window.partitionBy("experiment_id"))
    step = tested.withColumn("_step", (m - F.row_number().over(in_order) + 1) * F.col("p_value"))
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    holm = F.when(F.col("p_value").isNotNull(), F.least(F.lit(1.0), F.max("_step").over(upto)))
    return step.withColumn("p_holm", holm).select(
        "experiment_id",
        "variant",
        F.round("z_score", 9).alias("z_score"),
        F.round("p_value", 9).alias("p_value"),
        F.round("p_holm", 9).alias("p_holm"),
        (F.col("p_holm") < alpha).alias("significant"),
    )


def kpi_tiles(acquisition: DataFrame, economics: DataFrame, user_days: DataFrame) -> DataFrame:
    """One row: users, paid users, conversion, the last active month's MRR and
    subscriptions, and the last activity month's MAU.

    Each mart is reduced once to a small aggregate (one row, or one row per
    month, then the latest month) and read through a single struct-valued
    scalar subquery, so every mart is scanned once for all of its tiles.
    """
    acq = acquisition.select(
        F.struct(
            F.count(F.lit(1)).alias("users"), F.sum("reached_paid").cast("bigint").alias("paid")
        )
    ).scalar()
    monthly = economics.groupBy("active_month").agg(
        F.sum("mrr").cast("decimal(18,2)").alias("mrr"), F.count(F.lit(1)).alias("subs")
    )
    eco = (
        monthly.orderBy(F.col("active_month").desc())
        .limit(1)
        .select(F.struct("active_month", "mrr", "subs"))
        .scalar()
    )
    mau = user_days.groupBy("session_month").agg(_flagged("first_of_session_month").alias("mau"))
    eng = mau.orderBy(F.col("session_month").desc()).limit(1).select(F.struct("session_month", "mau")).scalar()
    # Each subquery appears once; the tiles are read from its struct after.
    tiles = acquisition.sparkSession.range(1).select(acq.alias("a"), eco.alias("e"), eng.alias("g"))
    return tiles.select(
        F.col("a.users").alias("total_users"),
        F.col("a.paid").alias("paid_users"),
        ratio(F.col("a.paid"), F.col("a.users")).alias("conversion_rate"),
        F.col("e.active_month").alias("last_active_month"),
        F.col("e.mrr").alias("mrr_last_month"),
        F.col("e.subs").alias("active_subs_last_month"),
        F.col("g.session_month").alias("last_session_month"),
        F.col("g.mau").alias("mau_last_month"),
    )
