"""The load gate against a plain version, on rows with every fault."""

import hashlib
from collections import Counter

from churnlab.sources.gate import RECORD, gated, load_gate, read_raw, text_schema
from churnlab.sources.schemas import KEYS, LENGTHS, SCHEMAS

HEADER = ",".join(SCHEMAS["subscriptions"].names)
LINES = [
    "s1,u1,2,active,2024-06-03 10:00:00,,False,True,12.99",
    "s2,u1,2,active,2024-06-03 10:00:00,,False,True,12.99",
    "s2,u1,2,active,2024-06-03 10:00:00,,False,True,12.99",
    "s3,u1,two,active,2024-06-03 10:00:00,,False,True,12.99",
    's4,u1,2,"a status, longer than twenty",2024-06-03 10:00:00,,False,True,12.99',
    "s5,,2,active,2024-06-03,2024-06-03 25:00:00,maybe,True,1234567.00",
    "s6,u1,2,active,2024-06-03 10:00:00,,False,True",
    's7,u1,2,"line\nbreak",2024-06-03 10:00:00,,,,',
    "s8,u1,2,active,2024-06-03 10:00:00,,False,True,1.00",
    "s8,u2,2,active,2024-06-03 10:00:00,,False,True,2.00",
    "s8,u2,2,active,2024-06-03 10:00:00,,False,True,2.00",
    "s8,u2,two,active,2024-06-03 10:00:00,,False,True,2.00",
    ",u1,2,active,2024-06-03 10:00:00,,False,True,1.00",
]


def test_every_fault_has_its_reason(spark, tmp_path):
    path = tmp_path / "subscriptions.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    raw = read_raw(spark, str(path), "subscriptions")
    found = load_gate(raw, "subscriptions")
    assert [f.dataType for f in found.accepted.schema] == [f.dataType for f in SCHEMAS["subscriptions"]]
    rejects = Counter()
    for r in found.rejects.collect():
        rejects[r["subscription_id"], tuple(r["reasons"])] += r["n_rows"]
    key = ("key:subscription_id",)
    assert rejects == {
        ("s2", key): 1,
        ("s3", ("type:plan_id",)): 1,
        ("s4", ("length:status",)): 1,
        ("s5", ("null:user_id", "type:started_at", "type:ended_at", "type:is_trial", "type:mrr")): 1,
        ("s6", ("record",)): 1,
        ("s8", key): 2,
        ("s8", ("type:plan_id",)): 1,
        (None, ("null:subscription_id",)): 1,
    }
    accepted = {r["subscription_id"]: r for r in found.accepted.collect()}
    assert set(accepted) == {"s1", "s2", "s7", "s8"} and found.accepted.count() == 4
    assert accepted["s7"]["status"] == "line\nbreak"

    def hashed(line):
        return hashlib.md5("|".join("=" + v if v else "" for v in line.split(",")).encode()).hexdigest()

    assert accepted["s8"]["user_id"] == min(LINES[8:10], key=hashed).split(",")[1]


def test_keys_are_compared_as_values(spark):
    schema = SCHEMAS["plans"]
    raw = spark.createDataFrame([("7", "a", "1", "m", "1", "HD"), ("07", "b", "1", "m", "1", "HD"), ("8", "c", "1", "m", "1", "HD")], text_schema("plans"))
    found = gated(raw, schema, KEYS["plans"], LENGTHS["plans"])
    assert found.accepted.count() == 2 and found.rejects.count() == 1


def test_hot_key_and_hot_row(spark):
    raw = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS a", "CAST(id % 2 AS STRING) AS b")
    found = gated(raw, raw.schema, ["a"])
    assert found.accepted.count() == 2001
    assert sum(r["n_rows"] for r in found.rejects.collect()) == 999 and found.rejects.count() == 2


def test_no_rows_no_key_no_record_column(spark):
    empty = spark.createDataFrame([], text_schema("users"))
    found = load_gate(empty, "users")
    assert found.accepted.count() == 0 == found.rejects.count() and RECORD not in found.rejects.columns
    assert gated(spark.createDataFrame([("x",), ("x",), (None,)], "a string"), spark.createDataFrame([], "a string").schema).accepted.count() == 3
