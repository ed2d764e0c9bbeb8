"""CSV with quotes, line breaks and blanks: any split of the files, any writer."""

import csv
import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from churnlab.sources.csv import inferred_types, read_records, records
from churnlab.sources.io import read_csv_table, write_table
from tests.conftest import SF_SMALL

SCHEMA = StructType([StructField("id", IntegerType()), StructField("a", StringType()), StructField("b", StringType())])
TEXTS = [
    "plain", "a,b", 'He said "hi"', "line\nbreak", "cr\rx", "crlf\r\nx", " pad ", "", None, '"', '""', "\\", '\\"', "tab\t", "#c", "NaN",
    " ", 'x"\ny"\n', "\n", "\n\n", ",", "a\\,b", "\r", "é🙂", '"\n"', "end\\", '"a" b', ' "q" ', "'", "null",
]
ROWS = [(i, a, TEXTS[(i * 7) % len(TEXTS)]) for i, a in enumerate(TEXTS * 2)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(params=[None, 16, 70, 300])
def split_bytes(request, spark):
    """The size of the files' splits."""
    if request.param:
        spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_sink_and_scan_give_rows_back(spark, tmp_path, split_bytes):
    folder = str(tmp_path / "out")
    write_table(spark.createDataFrame(ROWS, SCHEMA).repartition(3), folder, fmt="csv")
    back = read_csv_table(spark, folder, schema=SCHEMA)
    assert rows_of(back) == sorted(ROWS, key=str)
    if split_bytes:
        assert spark.read.text(folder).rdd.getNumPartitions() > 3


@pytest.mark.parametrize("end, quoting", list(itertools.product(["\n", "\r\n"], [csv.QUOTE_ALL, csv.QUOTE_NONNUMERIC])))
def test_files_of_another_writer(spark, tmp_path, split_bytes, end, quoting):
    rows = [r for r in ROWS if None not in r]
    for n, part in enumerate((rows[:20], rows[20:])):
        with open(tmp_path / f"{n}.csv", "w", newline="", encoding="utf-8") as f:
            writer = csv.writer(f, lineterminator=end, quoting=quoting)
            writer.writerow(SCHEMA.names)
            writer.writerows(part)
    assert rows_of(read_records(spark, str(tmp_path), SCHEMA)) == sorted(rows, key=str)


def test_random_files_against_a_plain_reader(spark, tmp_path):
    rng = random.Random(11)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 37)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        for n in range(4):
            rows = [(i, *("".join(rng.choices('ab ,"\n\r', k=rng.randint(0, 60))) for _ in range(2))) for i in range(25)]
            path = tmp_path / f"r{n}.csv"
            with open(path, "w", newline="", encoding="utf-8") as f:
                writer = csv.writer(f, lineterminator="\n", quoting=csv.QUOTE_NONNUMERIC)
                writer.writerow(SCHEMA.names)
                writer.writerows(rows)
            assert rows_of(read_records(spark, str(path), SCHEMA)) == sorted(rows, key=str)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_whole_documents_survive(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.withColumn("text", F.concat(F.lit(' "'), "text", F.lit('",\n')))
    folder = str(tmp_path / "docs")
    write_table(docs, folder, fmt="csv")
    back = read_csv_table(spark, folder, schema=docs.schema)
    assert back.exceptAll(docs).count() == 0 == docs.exceptAll(back).count()


def test_faults_are_loud(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('id,a,b\n1,x,y\n2,only\nz,"q,\n",w\n\n3,a,b,c\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_records(spark, str(path), SCHEMA).collect()
    kept = read_records(spark, str(path), SCHEMA, corrupt="_record").collect()
    assert {r["_record"] for r in kept} == {None, "2,only", 'z,"q,\n",w', "3,a,b,c"}
    path.write_text("id,b,a\n1,x,y\n")
    with pytest.raises(Exception, match="header"):
        read_records(spark, str(path), SCHEMA).collect()
    assert read_records(spark, str(path), SCHEMA, check_header=False).count() == 1


def test_no_rows_blank_lines_and_open_quotes(spark, tmp_path):
    for n, text in enumerate(["", "id,a,b\n", "id,a,b", '﻿id,a,b\n\n\n']):
        (tmp_path / f"{n}.csv").write_text(text)
    assert read_records(spark, str(tmp_path), SCHEMA, check_header=False).count() == 0
    path = tmp_path / "open.csv"
    path.write_text('id,a,b\n1,x,"never closed\n2,y,z\n')
    assert [r["record"] for r in records(spark, str(path)).collect()] == ['1,x,"never closed\n2,y,z']


def test_inferred_types_say_which_values_decide(spark):
    names = ["i", "big", "dec", "real", "day", "time", "flag", "text", "none"]
    rows = [
        ("1", "3000000000", "1.5", "1e300", "2024-01-02", "2024-01-02 10:00:00", "True", "7", None),
        ("-2", "5", "2", "2.5", "2024-02-29", "2024-01-02 10:00:01", "false", "x", None),
        ("3", None, "3", None, None, None, None, "8", None),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    got = {r["column_name"]: (r["inferred_type"], r["n_values"], r["n_deciding"]) for r in inferred_types(df, df.schema).collect()}
    assert got == {
        "i": ("int", 3, 3), "big": ("bigint", 2, 1), "dec": ("decimal(38,18)", 3, 1), "real": ("double", 2, 1), "day": ("date", 2, 2),
        "time": ("timestamp_ntz", 2, 2), "flag": ("boolean", 2, 0), "text": ("string", 3, 1), "none": (None, 0, 0),
    }
