"""Published versions: what readers see while a table is rebuilt."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from churnlab.plans import registry
from churnlab.sources import publish
from churnlab.sources.fixtures import SourcesOnDemand
from churnlab.sources.publish import NotPublishedError, publish_table, read_published, versions
from tests.conftest import SF_SMALL


def test_a_run_that_fails_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "mart")
    with pytest.raises(NotPublishedError):
        read_published(spark, path)
    publish_table(spark.range(5).withColumn("month", F.col("id") % 2), path, partition_by=["month"])
    assert read_published(spark, path).columns == ["id", "month"] and read_published(spark, path).count() == 5

    bad = spark.range(9).withColumn("month", F.when(F.col("id") == 8, F.raise_error(F.lit("broken")).cast("long")).otherwise(0))
    with pytest.raises(PySparkException):
        publish_table(bad, path, partition_by=["month"])
    assert read_published(spark, path).count() == 5

    def dies(*_):
        raise RuntimeError("killed between write and publish")

    with monkeypatch.context() as m:
        m.setattr(publish, "_swap", dies)
        with pytest.raises(RuntimeError):
            publish_table(spark.range(7).withColumn("month", F.lit(1)), path)
    assert read_published(spark, path).count() == 5 and versions(spark, path).count() == 1


def test_readers_keep_the_version_they_resolved(spark, tmp_path):
    path = str(tmp_path / "mart")
    publish_table(spark.range(5), path)
    old = read_published(spark, path)
    publish_table(spark.range(3).withColumn("more", F.lit("x")), path, fmt="json")
    assert old.count() == 5
    now = read_published(spark, path)
    assert now.count() == 3 and now.columns == ["id", "more"]
    # A rebuild may read the version that it replaces.
    publish_table(now.union(now), path)
    assert read_published(spark, path).count() == 6
    assert sorted(r["version"] for r in versions(spark, path).collect()) == [1, 2, 3]


def test_empty_table_and_runs_at_the_same_time(spark, tmp_path):
    path = str(tmp_path / "mart")
    publish_table(spark.range(0), path)
    assert read_published(spark, path).count() == 0
    latest = publish._latest(spark, path)
    for run, n in (("a", 4), ("f" * 33, 6)):
        spark.range(n).write.parquet(f"{path}/versions/{run}")
        line = [(latest["version"] + 1, run, latest["schema"], "parquet")]
        spark.createDataFrame(line, publish.MANIFEST).write.mode("append").json(f"{path}/manifest")
    assert read_published(spark, path).count() == 6


def test_economics_by_month_shuffles_no_row_for_each_month(spark, monkeypatch):
    plans = []

    def write(df, folder, dealt=False, **more):
        plans.append((df if dealt else df.hint("rebalance", *more["partition_by"]))._jdf.queryExecution().optimizedPlan().toString())
        write_table(df, folder, dealt=dealt, **more)

    write_table = publish.write_table
    monkeypatch.setattr(publish, "write_table", write)
    rows = registry.QUERIES["written_economics"](SourcesOnDemand(spark, SF_SMALL))
    assert rows.count() == registry.QUERIES["mart_economics"](SourcesOnDemand(spark, SF_SMALL)).count()
    # The months are made above the one shuffle of the write.
    (plan,) = plans
    assert plan.count("RebalancePartitions") == 1
    assert "Generate" in plan[: plan.index("RebalancePartitions")]
