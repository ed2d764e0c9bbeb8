"""Scans and sinks: CSV sources with declared schemas, table materialisation,
temp views, and the load audit."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnlab.operators.core import union_all
from churnlab.sources.csv import READ, WRITE, read_records
from churnlab.sources.schemas import SCHEMAS, SOURCE_TABLES, STAGING_COLUMNS


class MissingSourceError(FileNotFoundError):
    """A source file or folder named in the load list does not exist."""


def missing(spark: SparkSession, paths: Mapping[str, str]) -> list[str]:
    """The names whose path Spark cannot read. Uses the reader itself, so it works for
    any store and kind of session; only listings are read."""
    found = []
    for name, path in paths.items():
        try:
            spark.read.text(path)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            found.append(name)
    return found


def require(spark: SparkSession, paths: Iterable[str]) -> None:
    """Raise MissingSourceError naming every path that Spark cannot read."""
    if found := missing(spark, {p: p for p in paths}):
        raise MissingSourceError("missing source files: " + ", ".join(found))


def read_csv_table(
    spark: SparkSession,
    path: str,
    table: str | None = None,
    infer_schema: bool = False,
    schema: StructType | None = None,
) -> DataFrame:
    """Header CSV -> DataFrame.

    With ``table`` the declared schema is applied (types, no inference pass),
    with ``schema`` that one; ``infer_schema=True`` samples the file instead, as the warehouse load did.
    Empty fields read as null, quoted empty ones as empty texts; quoted fields keep
    separators, doubled quotes, line breaks and blanks, and files that have them are
    read in splits (``churnlab.sources.csv``). A header or record that does not fit
    fails the read.
    """
    if infer_schema:
        return spark.read.options(**READ).option("header", True).option("mode", "FAILFAST").option("inferSchema", True).csv(path)
    if table is None and schema is None:
        raise ValueError("give a table name for its declared schema, a schema, or infer_schema=True")
    return read_records(spark, path, schema or SCHEMAS[table])


def load_sources(
    spark: SparkSession,
    folder: str,
    tables: Iterable[str] = SOURCE_TABLES,
    fmt: str = "csv",
) -> dict[str, DataFrame]:
    """Load the named source tables from ``folder/<table>.<fmt>``.

    Checks every path before reading any, and fails loudly listing all that
    are missing. Returns a name -> DataFrame catalog (the ``source()`` lookup).
    """
    tables = list(tables)
    paths = {t: os.path.join(folder, f"{t}.{fmt}") for t in tables}
    require(spark, paths.values())
    if fmt == "csv":
        return {t: read_csv_table(spark, p, t) for t, p in paths.items()}
    return {t: spark.read.parquet(p) for t, p in paths.items()}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Staging model: the declared columns of ``table`` in staging order."""
    return df.select(*STAGING_COLUMNS[table])


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Iterable[str] | None = None,
    header: bool = True,
    dealt: bool = False,
) -> None:
    """Materialise ``df`` whole, replacing what was there (idempotent rebuild).

    CSV output carries a header row and reads back as it was (``read_csv_table``);
    parquet is the default sink. Monthly grains
    pass ``partition_by`` so later reads prune by month; rows are then rebalanced
    by those columns first, so that a month is written by few tasks (a large
    one is split) and not by all; with ``dealt`` they are so already.
    """
    partition_by = list(partition_by or ())
    writer = (df.hint("rebalance", *partition_by) if partition_by and not dealt else df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.options(**WRITE).option("header", header).csv(path)
    else:
        writer.format(fmt).save(path)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Materialise as view: lazy, recomputed by each query that reads it."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def load_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table: one (table_name, row_count) row per table."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    return union_all(counts)
