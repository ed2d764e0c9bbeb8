"""Named queries over a source catalog: one per model, check, metric and rule.

``QUERIES[name](sources) -> DataFrame``. Every query reads the source
tables (which the fixture adapters derive from the test tables), so its work
grows with them. Only the queries named in ``SINKS`` run jobs when called: they
write a table and read it back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.operators.core import anti_orphans
from churnlab.plans import checks as C
from churnlab.plans import content as CT
from churnlab.plans import lifecycle as L
from churnlab.plans import metrics as MT
from churnlab.plans import models as M
from churnlab.plans.experiments import assign_variants, experiment_effects, experiment_eligibility
from churnlab.session import ensure_checkpoint_dir
from churnlab.sources.csv import inferred_types
from churnlab.sources.fixtures import Sources, odd_titles_from, raw_subscriptions_from
from churnlab.sources.gate import Gated, load_gate, read_raw
from churnlab.sources.io import conform, load_audit, missing, read_csv_table, register_views, write_table
from churnlab.sources.lookups import ACCEPTED_STATUSES, DEVICES
from churnlab.sources.publish import publish_table, read_published
from churnlab.sources.schemas import SCHEMAS, SOURCE_TABLES


def _acq(s: Sources, week: str | None = None) -> DataFrame:
    return M.mart_acquisition(
        s.users, s.events, s.subscriptions, s.plans, s.channel_cac, week or s.settings.week_start
    )


def _profile(s: Sources) -> DataFrame:
    return M.acquisition_profile(s.users, s.events, s.channel_cac, s.settings.week_start)


def _eng(s: Sources, week: str | None = None) -> DataFrame:
    return M.mart_engagement(s.users, s.sessions, week or s.settings.week_start)


def _days(s: Sources) -> DataFrame:
    return M.user_days(s.users, s.sessions, s.settings.week_start)


def _eco(s: Sources, cap="settings", dealt: bool = False) -> DataFrame:
    return M.mart_economics(s.subscriptions, s.users, s.plans, s.channel_cac, s.settings, cap, dealt)


def _outcomes(s: Sources) -> DataFrame:
    return M.user_outcomes(s.users, s.subscriptions, s.sessions)


def _exp(s: Sources, week: str | None = None) -> DataFrame:
    outcomes = M.assigned_outcomes(s.experiment_assignments, s.users, s.subscriptions, s.sessions)
    return M.mart_experiments(s.experiment_assignments, s.experiments, outcomes, week or s.settings.week_start)


def _table_folder(s: Sources, name: str) -> str:
    return f"{ensure_checkpoint_dir(s.spark).rstrip('/')}/churnlab-tables/{name}-{uuid.uuid4().hex}"


def _csv_round_trip(s: Sources, df: DataFrame, name: str) -> DataFrame:
    """Write as CSV with a header and read back with the declared types."""
    folder = _table_folder(s, name)
    write_table(df, folder, fmt="csv")
    return read_csv_table(s.spark, folder, schema=df.schema)


def _raw_subscriptions(s: Sources) -> DataFrame:
    """The export with planted faults, written as CSV and read as a table of text (the
    gate looks at it several times; its files are cut into records once)."""
    folder = _table_folder(s, "raw_subscriptions")
    write_table(raw_subscriptions_from(conform(s.subscriptions, "subscriptions")), f"{folder}/csv", fmt="csv")
    write_table(read_raw(s.spark, f"{folder}/csv", "subscriptions"), f"{folder}/text")
    return s.spark.read.parquet(f"{folder}/text")


def _gated_subscriptions(s: Sources) -> Gated:
    # The test tables' ids are numbers; text ids are as the declared schema has them.
    return load_gate(_raw_subscriptions(s), "subscriptions")


def _load_rejects(s: Sources) -> DataFrame:
    rejects = _gated_subscriptions(s).rejects
    return rejects.select("subscription_id", "user_id", "status", F.array_join("reasons", ",").alias("reasons"), "n_rows")


def _seed_costs(s: Sources) -> DataFrame:
    """The CAC seed as a CSV file, read with its declared schema: what the users of each
    channel have cost."""
    folder = _table_folder(s, "channel_cac")
    write_table(s.channel_cac, folder, fmt="csv")
    seed = read_csv_table(s.spark, folder, "channel_cac")
    users = s.users.groupBy("acquisition_channel").agg(F.count(F.lit(1)).alias("users"))
    cost = (F.col("users") * F.col("channel_cac")).alias("cost")
    return users.join(seed, "acquisition_channel").select("acquisition_channel", "users", "channel_cac", cost)


def _staging_views(s: Sources) -> DataFrame:
    """Events of each channel's users, read through staging views by SQL."""
    register_views({"stg_users": conform(s.users, "users"), "stg_events": conform(s.events, "events")})
    return s.spark.sql(
        "SELECT u.acquisition_channel, e.event_type, count(*) AS events, count(DISTINCT e.user_id) AS users "
        "FROM stg_events e JOIN stg_users u ON e.user_id = u.user_id GROUP BY u.acquisition_channel, e.event_type"
    )


def _present_sources(s: Sources) -> DataFrame:
    """Every declared source: whether its folder of the load step is there, and its rows
    (null where it is missing)."""
    folder = _table_folder(s, "present")
    kept = {"users": s.users, "subscriptions": s.subscriptions}
    stored = {n: f"{folder}/{n}" for n in kept}
    for n, path in stored.items():
        write_table(kept[n], path)
    paths = {n: stored.get(n, f"{folder}/{n}") for n in SOURCE_TABLES}
    there = set(paths) - set(missing(s.spark, paths))
    counts = load_audit({n: s.spark.read.parquet(paths[n]) for n in sorted(there)})
    names = s.spark.createDataFrame([(n, n in there) for n in SOURCE_TABLES], "table_name string, present boolean")
    return names.join(counts, "table_name", "left")


def _written_economics(s: Sources) -> DataFrame:
    """The economics mart as a published table by month."""
    path = _table_folder(s, "mart_economics")
    publish_table(_eco(s, dealt=True), path, partition_by=["active_month"], dealt=True)
    return read_published(s.spark, path)


def staging(s: Sources) -> dict[str, DataFrame]:
    return {f"stg_{t}": conform(df, t) for t, df in s.tables().items()}


def all_tables(s: Sources) -> dict[str, DataFrame]:
    """Staging models, marts and the CAC seed by name (input to the checks)."""
    t = staging(s)
    t.update(
        mart_acquisition=_acq(s),
        mart_engagement=_eng(s),
        mart_economics=_eco(s),
        mart_experiments=_exp(s),
        channel_cac=s.channel_cac,
    )
    return t


def _quality(s: Sources) -> DataFrame:
    return C.quality_report(all_tables(s), C.full_suite(s.accepted_channels, ACCEPTED_STATUSES))


QUERIES: dict[str, Callable[[Sources], DataFrame]] = {
    # staging (typed column selection per source)
    "stg_users": lambda s: conform(s.users, "users"),
    "stg_subscriptions": lambda s: conform(s.subscriptions, "subscriptions"),
    "stg_sessions": lambda s: conform(s.sessions, "sessions"),
    "stg_events": lambda s: conform(s.events, "events"),
    "stg_content_catalog": lambda s: conform(s.content_catalog, "content_catalog"),
    "stg_content_views": lambda s: conform(s.content_views, "content_views"),
    "stg_experiment_assignments": lambda s: conform(s.experiment_assignments, "experiment_assignments"),
    # intermediate
    "user_funnel": lambda s: M.user_funnel(s.users, s.events, s.settings.week_start),
    "user_first_sub": lambda s: M.user_first_sub(s.subscriptions),
    "user_outcomes": _outcomes,
    "subscription_months": lambda s: M.subscription_months(s.subscriptions, s.plans, s.settings),
    "user_first_session": lambda s: M.user_first_session(s.sessions, s.settings.week_start),
    "daily_activity": lambda s: M.daily_activity(s.sessions),
    # marts
    "mart_acquisition": _acq,
    "mart_engagement": _eng,
    "mart_economics": _eco,
    "month_spine": lambda s: M.month_spine(s.subscriptions, s.users, s.plans, s.settings),
    "mart_experiments": _exp,
    # prototype views: Monday weeks; economics without the cap
    "vw_acquisition": lambda s: _acq(s, "monday"),
    "vw_engagement": lambda s: _eng(s, "monday"),
    "vw_economics": lambda s: _eco(s, None),
    "vw_experiments": lambda s: _exp(s, "monday"),
    # plain operator families
    "load_audit": lambda s: load_audit(s.tables()),
    "csv_users": lambda s: _csv_round_trip(s, conform(s.users, "users"), "users"),
    "csv_quoted_titles": lambda s: _csv_round_trip(s, odd_titles_from(s.content_catalog), "titles"),
    "csv_subscriptions_inferred": lambda s: inferred_types(_raw_subscriptions(s), SCHEMAS["subscriptions"]),
    "load_rejects": _load_rejects,
    "load_accepted": lambda s: _gated_subscriptions(s).accepted,
    "seed_channel_costs": _seed_costs,
    "present_sources": _present_sources,
    "staging_views": _staging_views,
    "written_economics": _written_economics,
    "range_join_months": lambda s: M.range_join_months(s.subscriptions, s.users, s.plans, s.channel_cac, s.settings),
    "orphan_keys": lambda s: anti_orphans(s.subscriptions.select("subscription_id", "user_id"), s.users, "user_id"),
    # Paying user ids are de-duplicated (map-side) before the semi join, so a
    # user with very many subscriptions is one row on the probe side.
    "users_with_paid_sub": lambda s: s.users.select("user_id", "signup_date", "acquisition_channel").join(
        s.subscriptions.where("converted_to_paid").select("user_id").distinct(), "user_id", "left_semi"
    ),
    # data-quality checks
    "check_unique": lambda s: C.check_unique(
        raw_subscriptions_from(conform(s.subscriptions, "subscriptions")), "subscription_id"
    ),
    "check_composite_key": lambda s: C.check_unique(s.experiment_assignments, ["experiment_id", "user_id"]),
    "check_not_null": lambda s: C.check_not_null(conform(s.users, "users")),
    "check_accepted_values": lambda s: C.check_accepted_values(s.sessions, "device", DEVICES),
    "check_relationship": lambda s: C.check_relationship(s.subscriptions, "user_id", s.users, "user_id"),
    "load_constraints": lambda s: C.load_constraints(s.tables() | {"channel_cac": s.channel_cac}),
    "quality_report": _quality,
    # dashboard metrics
    "funnel_summary": lambda s: MT.funnel_summary(_profile(s)),
    "channel_performance": lambda s: MT.channel_performance(_profile(s)),
    "signups_over_time": lambda s: MT.signups_over_time(_profile(s)),
    "geo_distribution": lambda s: MT.geo_distribution(_profile(s)),
    "cohort_retention": lambda s: MT.cohort_retention(_days(s)),
    "active_users": lambda s: MT.active_users(_days(s)),
    "stickiness": lambda s: MT.stickiness(_days(s)),
    "engagement_tiers": lambda s: MT.engagement_tiers(_eng(s)),
    "device_mix": lambda s: MT.device_mix(s.sessions),
    "mrr_trend": lambda s: MT.mrr_trend(_eco(s)),
    "ltv_cac": lambda s: MT.ltv_cac(_eco(s)),
    "churn_rate": lambda s: MT.churn_rate(
        M.subscription_months(s.subscriptions, s.plans, s.settings, cap=s.settings.cap), s.settings.churn_benchmark
    ),
    "plan_mix": lambda s: MT.plan_mix(_eco(s)),
    "revenue_retention": lambda s: MT.revenue_retention(_eco(s)),
    "experiment_results": lambda s: MT.experiment_results(_exp(s)),
    "experiment_lift": lambda s: MT.experiment_lift(MT.experiment_results(_exp(s))),
    "experiment_significance": lambda s: MT.experiment_significance(MT.experiment_results(_exp(s))),
    "experiment_p_values": lambda s: MT.experiment_p_values(MT.experiment_results(_exp(s))),
    "kpi_tiles": lambda s: MT.kpi_tiles(_profile(s), _eco(s), _days(s)),
    # table rules from the generator
    "experiment_eligibility": lambda s: experiment_eligibility(s.users, s.experiments),
    "assign_variants": lambda s: assign_variants(experiment_eligibility(s.users, s.experiments), s.experiments),
    "normalized_mrr": lambda s: L.normalized_mrr(s.subscriptions, s.plans),
    "subscription_status": lambda s: L.subscription_status(s.subscriptions),
    "trial_period": lambda s: L.trial_period(
        s.subscriptions, s.experiment_assignments, s.experiments, s.trial_experiment
    ),
    "lifecycle_events": lambda s: L.lifecycle_events(s.users, s.subscriptions),
    "experiment_effects": lambda s: experiment_effects(s.users, s.experiment_assignments, s.experiment_effects),
    "content_completion": lambda s: CT.content_completion(s.content_views, s.content_catalog),
    "retention_by_segment": lambda s: CT.retention_by_segment(_outcomes(s), s.content_views, s.content_catalog),
}

# Queries that write when they are called.
SINKS = (
    "csv_users",
    "csv_quoted_titles",
    "csv_subscriptions_inferred",
    "load_rejects",
    "load_accepted",
    "seed_channel_costs",
    "present_sources",
    "written_economics",
)
