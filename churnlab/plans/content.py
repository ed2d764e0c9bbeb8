"""Content metrics: completion by genre/type and retention by segment.

The catalog is never assumed small: views are aggregated per title first, so
a very popular title becomes a handful of partial rows before it meets the
catalog, and AQE picks the join from the measured bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlab.functions.scalar import ratio
from churnlab.operators.core import first_per_key


def content_completion(views: DataFrame, catalog: DataFrame) -> DataFrame:
    """Per genre and content type: views, completed views (watch >= 90%),
    completion rate and mean watch share.

    Views are aggregated per title, joined with the catalog and summed again.
    Watch shares are summed as wide decimals, exact for any number of views.
    """
    cat = catalog.select("content_id", "genre", "content_type")
    per_title = views.groupBy("content_id").agg(
        F.count(F.lit(1)).alias("views"),
        F.count_if(F.col("completed")).alias("completed_views"),
        F.sum(F.col("watch_percentage").cast("decimal(28,2)")).alias("watch_sum"),
        F.count("watch_percentage").alias("watch_n"),
    )
    g = per_title.join(cat, "content_id", "inner").groupBy("genre", "content_type").agg(
        *[F.sum(c).alias(c) for c in ("views", "completed_views", "watch_sum", "watch_n")]
    )
    return g.select(
        "genre",
        "content_type",
        "views",
        "completed_views",
        ratio(F.col("completed_views"), F.col("views")).alias("completion_rate"),
        ratio(F.col("watch_sum"), F.col("watch_n")).alias("avg_watch_percentage"),
    )


def top_genre(views: DataFrame, catalog: DataFrame) -> DataFrame:
    """Most-watched genre per user (most views; ties to the first genre name).
    Views are aggregated to (user, title) before they meet the catalog."""
    per_title = views.groupBy("user_id", "content_id").agg(F.count(F.lit(1)).alias("n"))
    per_genre = (
        per_title.join(catalog.select("content_id", "genre"), "content_id", "inner")
        .groupBy("user_id", "genre")
        .agg(F.sum("n").alias("views"))
    )
    top = first_per_key(per_genre, ["user_id"], [F.col("views").desc(), F.col("genre").asc()])
    return top.select("user_id", F.col("genre").alias("top_genre"))


def retention_by_segment(outcomes: DataFrame, views: DataFrame, catalog: DataFrame) -> DataFrame:
    """D7 and D30 retention rates by primary device and by each user's
    most-watched genre: (segment_type, segment, users, d7_rate, d30_rate).

    One pass over the outcomes: each user carries its top genre (null when it
    watched nothing), and grouping sets count by device and by genre at once.
    Users without a top genre are left out of the genre rows only.
    """
    o = outcomes.select("user_id", "primary_device", "retained_d7", "retained_d30").join(
        top_genre(views, catalog), "user_id", "left"
    )
    g = o.groupingSets([["primary_device"], ["top_genre"]], "primary_device", "top_genre").agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("retained_d7").cast("bigint").alias("_d7"),
        F.sum("retained_d30").cast("bigint").alias("_d30"),
        F.grouping("primary_device").alias("_by_genre"),
    )
    by_genre = F.col("_by_genre") == 1
    g = g.where(~by_genre | F.col("top_genre").isNotNull())
    return g.select(
        F.when(by_genre, F.lit("top_genre")).otherwise(F.lit("primary_device")).alias("segment_type"),
        F.when(by_genre, F.col("top_genre")).otherwise(F.col("primary_device")).alias("segment"),
        "users",
        ratio(F.col("_d7"), F.col("users")).alias("d7_rate"),
        ratio(F.col("_d30"), F.col("users")).alias("d30_rate"),
    )
