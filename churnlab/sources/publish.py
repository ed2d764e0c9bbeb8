"""Published tables: a rebuild writes a new version beside the old one and then
publishes it by one small manifest file, so readers see the old rows or the new
ones, never none or some, and a run that fails leaves the old version in place.

    <path>/versions/<run>/   the rows of one run
    <path>/manifest/         one line of JSON for each published version

A manifest line is written by Spark as one file, which the commit of that job makes
visible in one move; the version with the highest number counts. Only Spark's own
readers and writers are used, so any store does that they can write to.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from churnlab.sources.io import write_table

MANIFEST = "version long, run string, schema string, format string"


class NotPublishedError(FileNotFoundError):
    """Nothing has been published at this path."""


def versions(spark: SparkSession, path: str) -> DataFrame:
    """The published versions of a table: (version, run, schema, format)."""
    folder = f"{path.rstrip('/')}/manifest"
    try:
        return spark.read.schema(MANIFEST).json(folder)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def _latest(spark: SparkSession, path: str):
    # Two runs that published at the same time have one number: the later name counts.
    return versions(spark, path).orderBy(F.desc("version"), F.desc("run")).first()


def _swap(spark: SparkSession, path: str, run: str, schema: str, fmt: str) -> None:
    """Publish a written version: one line, one file, one move."""
    now = _latest(spark, path)
    line = [((now["version"] if now else 0) + 1, run, schema, fmt)]
    spark.createDataFrame(line, MANIFEST).coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/manifest")


def publish_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Iterable[str] | None = None, dealt: bool = False) -> str:
    """Write ``df`` as a new version of the table at ``path`` and publish it; returns the
    version's folder. ``df`` may read the version that it replaces. ``dealt``: see
    ``write_table``."""
    spark, run = df.sparkSession, uuid.uuid4().hex
    folder = f"{path.rstrip('/')}/versions/{run}"
    write_table(df, folder, fmt=fmt, partition_by=partition_by, dealt=dealt)
    _swap(spark, path, run, df.schema.json(), fmt)
    return folder


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The latest published version, with the columns and types it was written with. A
    reader keeps the version that it has resolved while later ones are published."""
    now = _latest(spark, path)
    if now is None:
        raise NotPublishedError(f"nothing is published at {path}")
    schema = StructType.fromJson(json.loads(now["schema"]))
    rows = spark.read.schema(schema).format(now["format"]).load(f"{path.rstrip('/')}/versions/{now['run']}")
    return rows.select(*schema.names)
