"""Plan shape guards for every registered query: no cartesian products or
nested-loop joins, no Python evaluation, scans prune columns, nothing runs
while a query is built, and metrics scan only what they need."""

import re

import pytest

import __spark_entry__ as E
from churnlab.plans.registry import QUERIES as REGISTERED
from churnlab.plans.registry import SINKS
from tests.conftest import SF_SMALL

QUERIES = {name: E.queries()[name] for name in REGISTERED}
# CSV files are cut into records by Arrow batches of lines (churnlab.sources.csv).
ARROW = ("csv_users", "csv_quoted_titles", "seed_channel_costs")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow")


@pytest.fixture(autouse=True, scope="module")
def whole_paths(spark):
    """Plans name their files in full."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan: str, table: str) -> int:
    return len(re.findall(rf"FileScan parquet [^\n]*/{table}[\],]", plan))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_quadratic_join_or_python(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_SMALL))
    for op in FORBIDDEN:
        assert op not in plan or (op == "MapInArrow" and name in ARROW), f"{name}: {op}"


def test_no_job_runs_while_a_query_is_built(spark):
    from churnlab.sources.fixtures import loaded_sources

    tracker = spark.sparkContext.statusTracker()
    sources = loaded_sources(spark, SF_SMALL)
    for name in sorted(set(REGISTERED) - set(SINKS)):
        spark.sparkContext.setJobGroup(f"plan-{name}", name)
        try:
            REGISTERED[name](sources)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert not tracker.getJobIdsForGroup(f"plan-{name}"), name


def test_scans_read_only_needed_columns(spark):
    plan = plan_text(QUERIES["device_mix"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas
    for schema in schemas:
        columns = {c.split(":")[0] for c in schema.split(",")}
        assert columns <= {"line_date", "l_quantity", "l_returnflag"}


@pytest.mark.parametrize("name", ["funnel_summary", "channel_performance", "signups_over_time", "geo_distribution"])
def test_acquisition_metrics_read_users_once_and_no_subscriptions(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_SMALL))
    assert scans(plan, "subscriptions") == 0 and scans(plan, "users") == 1


@pytest.mark.parametrize("name", ["active_users", "stickiness", "cohort_retention"])
def test_activity_metrics_scan_sessions_once_and_expand_nothing(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_SMALL))
    assert scans(plan, "lines") == 1 and "Expand" not in plan


def test_month_partitions_are_written_by_few_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from churnlab.sources.io import write_table

    df = spark.range(0, 20_000, 1, 16).withColumn("month", F.col("id") % 12)
    write_table(df, str(tmp_path / "t"), partition_by=["month"])
    files = list((tmp_path / "t").glob("month=*/*.parquet"))
    assert len(files) < 3 * 12  # not 16 tasks x 12 months
