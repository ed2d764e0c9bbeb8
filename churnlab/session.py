"""SparkSession construction and the shared checkpoint folder.

Operators never create a session; callers pass one in. ``build_session`` is
for tests, the bench and local runs. On a cluster the session comes from the
platform and only ``ensure_checkpoint_dir`` is used.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every session should carry: adaptive execution re-plans joins and
# coalesces partitions from runtime sizes, splits skewed join partitions, and
# timestamps are interpreted in UTC so results match the oracle.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # Split a hot join partition even when that costs an extra shuffle later:
    # a key may hold a third of a table, and one task must not take it all.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # Skip recording the Python call site of every DataFrame/Column call (a
    # debugging aid for error messages): it costs several JVM round trips per
    # call and dominates the time to build large plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "churnlab",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the base configuration.

    ``shuffle_partitions`` defaults to twice the local core count; with AQE on
    it is an upper bound that gets coalesced at runtime. On a cluster size it
    to (shuffle bytes / ~128 MB).
    """
    master = master or os.environ.get("CHURNLAB_MASTER", "local[*]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    if shuffle_partitions is None:
        shuffle_partitions = max(8, 2 * (os.cpu_count() or 4))
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("CHURNLAB_DRIVER_MEMORY", "8g"))
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder for written tables: the one that spark.checkpoint.dir names.

    The session's setting always wins. Where it is unset, ``fallback`` (tests
    give one) or else a folder inside the session's warehouse, which a cluster
    shares as well, is used and recorded in the session, so later calls agree.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = fallback or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/churnlab-checkpoints"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder
