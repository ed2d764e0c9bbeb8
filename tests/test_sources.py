"""Scans and sinks: CSV with declared schema, inference, missing input, audit."""

import os
import tempfile

import pytest

from churnlab.sources.io import MissingSourceError, conform, load_audit, load_sources, read_csv_table, write_table
from churnlab.sources.schemas import SCHEMAS


def test_csv_roundtrip_with_declared_schema(spark):
    folder = tempfile.mkdtemp(prefix="churnlab-csv-")
    path = os.path.join(folder, "subscriptions.csv")
    with open(path, "w") as f:
        f.write("subscription_id,user_id,plan_id,status,started_at,ended_at,is_trial,converted_to_paid,mrr\n")
        f.write("s_0000001,u_0000001,2,active,2024-06-03 10:00:00,,False,True,12.99\n")
        f.write("s_0000002,u_0000002,4,churned,2024-06-04 11:30:00,2025-06-04 11:30:00,False,True,10.00\n")
    df = read_csv_table(spark, path, "subscriptions")
    assert df.schema == SCHEMAS["subscriptions"] or [f.dataType for f in df.schema] == [
        f.dataType for f in SCHEMAS["subscriptions"]]
    rows = df.orderBy("subscription_id").collect()
    assert rows[0].ended_at is None and rows[0].converted_to_paid is True and str(rows[0].mrr) == "12.99"
    out = os.path.join(folder, "out_csv")
    write_table(df, out, fmt="csv")
    back = read_csv_table(spark, out, "subscriptions")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    inferred = read_csv_table(spark, path, infer_schema=True)
    assert inferred.count() == 2


def test_missing_source_fails_loudly(spark):
    folder = tempfile.mkdtemp(prefix="churnlab-missing-")
    with pytest.raises(MissingSourceError) as exc:
        load_sources(spark, folder, ["users", "plans"])
    assert "users.csv" in str(exc.value) and "plans.csv" in str(exc.value)


def test_conform_and_load_audit(small_sources):
    tables = small_sources.tables()
    assert conform(tables["users"], "users").columns[:3] == ["user_id", "signup_timestamp", "signup_date"]
    audit = {r.table_name: r.row_count for r in load_audit(tables).collect()}
    assert audit["plans"] == 4 and audit["users"] == small_sources.users.count()
    assert set(audit) == set(tables)


def test_sources_are_loaded_anew_when_files_change(spark, tmp_path):
    import shutil

    import pyarrow.parquet as pq

    from churnlab.sources.fixtures import TEST_TABLES, loaded_sources
    from tests.conftest import SF_SMALL

    for name in TEST_TABLES:
        shutil.copyfile(f"{SF_SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    first = loaded_sources(spark, str(tmp_path))
    assert loaded_sources(spark, str(tmp_path)) is first
    pq.write_table(pq.read_table(f"{SF_SMALL}/events.parquet").slice(0, 10), tmp_path / "events.parquet")
    second = loaded_sources(spark, str(tmp_path), reload=True)
    assert (first.events.count(), second.events.count()) == (1000, 10)


def test_a_query_loads_only_the_tables_it_reads(spark, tmp_path):
    import shutil

    from churnlab.plans.registry import QUERIES
    from churnlab.sources.fixtures import TEST_TABLES, WRITTEN, SourcesOnDemand, _load, loaded_sources
    from tests.conftest import SF_SMALL

    for name in TEST_TABLES:
        shutil.copyfile(f"{SF_SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    done = _load(spark, str(tmp_path)).written
    for name, more in (("device_mix", {"lines"}), ("content_completion", {"content_catalog"}), ("stg_sessions", set()), ("csv_subscriptions_inferred", {"subscriptions"}), ("written_economics", {"users"})):
        before = set(done)
        assert QUERIES[name](SourcesOnDemand(spark, str(tmp_path))).count() > 0
        assert done - before == more, name
    whole = loaded_sources(spark, str(tmp_path))
    assert done == set(WRITTEN) and loaded_sources(spark, str(tmp_path)) is whole


def test_lines_are_shuffled_once_before_they_are_written(spark, monkeypatch, tmp_path):
    from pyspark.sql import DataFrame

    from churnlab.sources import fixtures
    from tests.conftest import SF_SMALL

    asked = []
    hint = DataFrame.hint
    monkeypatch.setattr(DataFrame, "hint", lambda self, name, *a: asked.append(name) or hint(self, name, *a))
    src = fixtures.load_fixture_sources(spark, SF_SMALL)
    out, seconds = fixtures.write_sources(src, str(tmp_path), ["lines"])
    assert not asked and set(seconds) == {"lines"}
    ids = lambda s: sorted(r[0] for r in s.sessions.select("session_id").collect())
    assert ids(out) == ids(src) and ids(out)[0].count("-") == 3
