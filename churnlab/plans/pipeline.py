"""Build everything: staging views, materialised marts, metrics, quality report.

The run follows the warehouse layout: staging and intermediate models stay
lazy views; marts are written whole and published as a new version of their
table (readers see the old one until then), monthly grains partitioned by month
so dashboards prune by month; metrics and the data-quality report read the
*written* marts. Writing the marts cuts their
lineage: a lost executor recomputes from the mart files, not from the raw
sources, and each mart is computed once even though several metrics use it.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from churnlab.plans import checks as C
from churnlab.plans import metrics as MT
from churnlab.plans import models as M
from churnlab.session import ensure_checkpoint_dir
from churnlab.sources.fixtures import Sources
from churnlab.sources.io import conform, register_views
from churnlab.sources.lookups import ACCEPTED_STATUSES
from churnlab.sources.publish import publish_table, read_published

# Mart -> partition columns of its table (months where the grain has one).
MART_PARTITIONS: dict[str, tuple[str, ...]] = {
    "mart_acquisition": (),
    "user_days": ("session_month",),
    "mart_economics": ("active_month",),
    "mart_experiments": (),
}
# Marts whose rows come rebalanced by month.
MART_DEALT = ("mart_economics",)


@dataclass
class PipelineResult:
    output_dir: str
    marts: dict[str, DataFrame] = field(default_factory=dict)
    metrics: dict[str, DataFrame] = field(default_factory=dict)
    quality: DataFrame | None = None


def build_marts(s: Sources, user_days: DataFrame) -> dict[str, DataFrame]:
    """The four marts. The engagement mart is the written user-days without their
    flags; retention for the experiments mart reads their (user_id,
    session_date) rows instead of scanning all sessions again."""
    week = s.settings.week_start
    outcomes = M.assigned_outcomes(s.experiment_assignments, s.users, s.subscriptions, user_days)
    return {
        "mart_acquisition": M.mart_acquisition(s.users, s.events, s.subscriptions, s.plans, s.channel_cac, week),
        "mart_engagement": user_days.drop(*M.FIRST_DAYS),
        "mart_economics": M.mart_economics(s.subscriptions, s.users, s.plans, s.channel_cac, s.settings, dealt=True),
        "mart_experiments": M.mart_experiments(s.experiment_assignments, s.experiments, outcomes, week),
    }


def build_metrics(s: Sources, marts: Mapping[str, DataFrame], user_days: DataFrame) -> dict[str, DataFrame]:
    acq, eng = marts["mart_acquisition"], marts["mart_engagement"]
    eco, exp = marts["mart_economics"], marts["mart_experiments"]
    results = MT.experiment_results(exp)
    return {
        "funnel_summary": MT.funnel_summary(acq),
        "channel_performance": MT.channel_performance(acq),
        "signups_over_time": MT.signups_over_time(acq),
        "geo_distribution": MT.geo_distribution(acq),
        "cohort_retention": MT.cohort_retention(user_days),
        "active_users": MT.active_users(user_days),
        "stickiness": MT.stickiness(user_days),
        "engagement_tiers": MT.engagement_tiers(eng),
        "device_mix": MT.device_mix(s.sessions),
        "mrr_trend": MT.mrr_trend(eco),
        "ltv_cac": MT.ltv_cac(eco),
        "churn_rate": MT.churn_rate(
            M.subscription_months(s.subscriptions, s.plans, s.settings, cap=s.settings.cap),
            s.settings.churn_benchmark,
        ),
        "plan_mix": MT.plan_mix(eco),
        "revenue_retention": MT.revenue_retention(eco),
        "experiment_results": results,
        "experiment_lift": MT.experiment_lift(results),
        "experiment_significance": MT.experiment_significance(results),
        "kpi_tiles": MT.kpi_tiles(acq, eco, user_days),
    }


def _published(df: DataFrame, path: str, fmt: str, partition_by=(), dealt: bool = False) -> DataFrame:
    publish_table(df, path, fmt=fmt, partition_by=partition_by, dealt=dealt)
    return read_published(df.sparkSession, path)


def run_pipeline(
    s: Sources,
    output_dir: str | None = None,
    accepted_channels=None,
    accepted_statuses=None,
    fmt: str = "parquet",
) -> PipelineResult:
    """Write marts, then metrics and the quality report computed from them.

    ``output_dir`` defaults to a folder under the session's shared checkpoint
    folder. Re-running publishes a new version of every table, so a second run over
    the same inputs gives the same rows (``read_published``).
    """
    spark: SparkSession = s.spark
    if output_dir is None:
        output_dir = os.path.join(ensure_checkpoint_dir(spark), "churnlab-pipeline", spark.sparkContext.applicationId)
    res = PipelineResult(output_dir=output_dir)

    staging = {f"stg_{t}": conform(df, t) for t, df in s.tables().items()}
    register_views(staging)

    def materialise(name: str, df: DataFrame) -> DataFrame:
        return _published(df, os.path.join(output_dir, name), fmt, MART_PARTITIONS[name], name in MART_DEALT)

    # User-days first: the engagement mart is a view of them, and retention and
    # the active-user metrics read them.
    user_days = materialise("user_days", M.user_days(s.users, s.sessions, s.settings.week_start))
    for name, df in build_marts(s, user_days).items():
        res.marts[name] = df if name == "mart_engagement" else materialise(name, df)
    register_views(res.marts)

    for name, df in build_metrics(s, res.marts, user_days).items():
        res.metrics[name] = _published(df, os.path.join(output_dir, "metrics", name), fmt)

    tables = dict(staging)
    tables.update(res.marts)
    tables["channel_cac"] = s.channel_cac
    suite = C.full_suite(accepted_channels or s.accepted_channels, accepted_statuses or ACCEPTED_STATUSES)
    res.quality = _published(C.quality_report(tables, suite), os.path.join(output_dir, "quality_report"), fmt)
    return res
