"""Source catalog from exported files: the nine raw CSV tables and the CAC seed.

This is the production entry point: files in the layout the raw export uses
(``<folder>/<table>.csv`` with a header row, ``True``/``False`` booleans,
``yyyy-MM-dd HH:mm:ss`` timestamps, empty field = null), read with the
declared schemas - no inference pass over the data.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from churnlab.settings import Settings
from churnlab.sources.fixtures import Sources
from churnlab.sources.io import load_sources, read_csv_table, require


def sources_from_files(
    spark: SparkSession,
    folder: str,
    settings: Settings,
    seed_path: str | None = None,
    fmt: str = "csv",
    effects: DataFrame | None = None,
    trial_experiment: str | None = None,
) -> Sources:
    """Load all nine source tables from ``folder`` and the CAC seed from
    ``seed_path`` (by default ``<folder>/channel_cac.csv``); fails listing every
    missing file. The exports hold no table of engineered experiment effects nor
    the name of the trial-length experiment: the rules that need them raise
    unless they are given here."""
    tables = load_sources(spark, folder, fmt=fmt)
    seed_path = seed_path or os.path.join(folder, "channel_cac.csv")
    require(spark, [seed_path])
    cac = read_csv_table(spark, seed_path, "channel_cac")
    return Sources(
        spark=spark,
        users=tables["users"],
        plans=tables["plans"],
        subscriptions=tables["subscriptions"],
        events=tables["events"],
        sessions=tables["sessions"],
        content_catalog=tables["content_catalog"],
        content_views=tables["content_views"],
        experiments=tables["experiments"].select(
            "experiment_id", "experiment_name", "variant", "start_date", "end_date", "is_control"
        ),
        experiment_assignments=tables["experiment_assignments"],
        channel_cac=cac,
        experiment_effects=effects,
        settings=settings,
        trial_experiment=trial_experiment,
    )
