"""Adapters from the driver's test tables to the nine source tables.

The test tables are a star schema (customer, nation, orders, lineitem, part)
plus an event log, not subscription data. Each source is derived from them
with plain column expressions, over the *whole* input tables, so work grows
with the data. Keys stay bigint. Some rows depart from the rules on purpose, so
that operators which differ also differ in results (FIXTURES.md section 2).

users          customer join nation (one row per customer)
subscriptions  orders (one per order; some of users that do not exist)
events         events (event types mapped onto the funnel's, by user)
sessions       lineitem join orders (one per line)
content_views  lineitem join orders (one per line)
content_catalog part
plans, channel_cac, experiments  inline lookups
experiment_assignments  users x experiment windows, md5 inclusion + split
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.functions.dates import add_days, add_days_ts, date_lit, day_diff
from churnlab.plans.experiments import assign_variants, experiment_eligibility, experiment_variants
from churnlab.session import ensure_checkpoint_dir
from churnlab.settings import FIXTURE_SETTINGS, Settings
from churnlab.sources.lookups import (
    ACCEPTED_CHANNELS,
    FIXTURE_CHANNEL_CAC,
    FIXTURE_CHANNELS,
    FIXTURE_EFFECTS,
    FIXTURE_EXPERIMENTS,
    FIXTURE_TRIAL_EXPERIMENT,
    channel_cac_df,
    experiment_definitions_df,
    experiment_effects_df,
    plans_df,
)

# ---------------------------------------------------------------------------
# Fixed values of the adapters (FIXTURES.md section 2).
SIGNUP_EPOCH = "1995-01-01"      # sign-up dates start here
SIGNUP_SPREAD_DAYS = 540         # ... spread over this many days by (custkey*37)
SESSION_EPOCH = "1995-01-01"     # session dates are folded into
SESSION_SPAN_DAYS = 547          # ... this many days from the epoch
DEVICE_BY_MOD3 = ("A", "N", "R")  # primary device by custkey % 3 (the line return flags)
ORDER_STATUS = {"F": "churned", "O": "active", "P": "trial_expired"}
# test event type -> (funnel event type, n, r): events of users with
# user_id % n = r are page views instead, so each stage has its own users.
EVENT_STAGE = {
    "signup": ("signup_completed", 1, 1),
    "view": ("trial_started", 7, 0),
    "error": ("paywall_view", 4, 1),
    "click": ("subscribe_clicked", 3, 2),
    "purchase": ("subscribed", 2, 1),
}
UNKNOWN_USER = (50, 7)   # orders with o_orderkey % 50 = 7 belong to user -o_custkey
STALE_STATUS = (23, 0)   # ended ones with o_orderkey % 23 = 0 are stored as active
LOWER_MRR = (19, 3)      # paid ones with o_orderkey % 19 = 3 pay one less
LOGGED_TWICE = (83, 5)   # assignments of users with user_id % 83 = 5 stand twice
# Faults planted in the raw subscriptions, by subscription_id % RAW_FAULTS.
RAW_FAULTS = 97
# ---------------------------------------------------------------------------


TEST_TABLES = ("customer", "nation", "orders", "lineitem", "part", "events")


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _falls(key, rule: tuple[int, int]):
    return key % rule[0] == rule[1]


def _case(col: str, mapping: dict[str, str]):
    expr = None
    for k, v in mapping.items():
        cond = F.col(col) == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr


def users_from(customer: DataFrame, nation: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    signup_date = add_days(date_lit(SIGNUP_EPOCH), ((key * 37) % SIGNUP_SPREAD_DAYS).cast("int"))
    device = F.element_at(F.array(*[F.lit(d) for d in DEVICE_BY_MOD3]), (key % 3).cast("int") + 1)
    nations = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name"))
    return customer.join(nations, "c_nationkey").select(
        key.alias("user_id"),
        signup_date.alias("signup_date"),
        signup_date.cast("timestamp_ntz").alias("signup_timestamp"),
        F.lower("c_mktsegment").alias("acquisition_channel"),
        F.col("n_name").alias("country"),
        device.alias("primary_device"),
        (F.lit(16) + key % 60).cast("int").alias("age"),
        F.lit(None).cast("string").alias("email"),
    )


def subscriptions_from(orders: DataFrame, plans: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    started = F.col("o_orderdate").cast("timestamp_ntz")
    ended = (
        F.when(st == "F", add_days_ts(started, F.lit(30) * (F.lit(1) + key % 24)))
        .when(st == "P", add_days_ts(started, 7))
    )
    listed = (
        F.when(F.col("billing_period") == "annual", F.round(F.col("price_monthly") / 12, 2))
        .otherwise(F.col("price_monthly"))
        .cast("decimal(8,2)")
    )
    price = F.when(_falls(F.col("subscription_id"), LOWER_MRR), listed - 1).otherwise(listed).cast("decimal(8,2)")
    status = F.when((st == "F") & _falls(key, STALE_STATUS), F.lit("active")).otherwise(_case("o_orderstatus", ORDER_STATUS))
    base = orders.select(
        key.alias("subscription_id"),
        F.when(_falls(key, UNKNOWN_USER), -F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("user_id"),
        (F.lit(1) + key % 4).cast("int").alias("plan_id"),
        status.alias("status"),
        started.alias("started_at"),
        ended.alias("ended_at"),
        (st == "P").alias("is_trial"),
        (st != "P").alias("converted_to_paid"),
    )
    priced = base.join(plans.select("plan_id", "price_monthly", "billing_period"), "plan_id", "left")
    return priced.select(
        "subscription_id",
        "user_id",
        "plan_id",
        "status",
        "started_at",
        "ended_at",
        "is_trial",
        "converted_to_paid",
        F.when(F.col("converted_to_paid"), price).otherwise(F.lit(0).cast("decimal(8,2)")).alias("mrr"),
    )


def events_from(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    for name, (stage, n, r) in EVENT_STAGE.items():
        seen = F.when(_falls(F.col("user_id"), (n, r)), F.lit("page_view")).otherwise(F.lit(stage))
        kind = F.when(F.col("event_type") == name, seen).otherwise(kind)
    return events.select("event_id", "user_id", kind.alias("event_type"), F.col("ts").cast("timestamp_ntz").alias("event_timestamp"))


def lines_from(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """lineitem with its order's customer and the folded session date."""
    epoch = date_lit(SESSION_EPOCH)
    folded = add_days(epoch, day_diff(F.col("l_shipdate"), epoch) % SESSION_SPAN_DAYS)
    own = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag")
    lines = lineitem.select(*own, folded.alias("line_date"))  # the day is less to shuffle than the time
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"))
    return lines.join(o, "l_orderkey", "inner").select("user_id", "line_date", *own)


def line_id() -> Column:
    """A line's id; made where it is read, as its parts take less room in a table than the text."""
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def sessions_from(lines: DataFrame) -> DataFrame:
    return lines.select(
        line_id().alias("session_id"),
        "user_id",
        F.col("line_date").alias("session_date"),
        F.col("line_date").cast("timestamp_ntz").alias("session_start"),
        (F.col("l_quantity") * 4).cast("int").alias("duration_minutes"),
        F.col("l_returnflag").alias("device"),
    )


def content_views_from(lines: DataFrame) -> DataFrame:
    pct = (F.col("l_discount") * 10).cast("decimal(4,2)")
    return lines.select(
        line_id().alias("view_id"),
        "user_id",
        line_id().alias("session_id"),
        F.col("l_partkey").alias("content_id"),
        F.col("line_date").alias("view_date"),
        pct.alias("watch_percentage"),
        (pct >= F.lit(0.9).cast("decimal(4,2)")).alias("completed"),
    )


def content_catalog_from(part: DataFrame) -> DataFrame:
    key = F.col("p_partkey")
    return part.select(
        key.alias("content_id"),
        F.col("p_name").alias("title"),
        F.when(key % 2 == 0, F.lit("movie")).otherwise(F.lit("series")).alias("content_type"),
        F.col("p_type").alias("genre"),
        (F.lit(2018) + key % 8).cast("int").alias("release_year"),
        F.col("p_size").cast("int").alias("duration_minutes"),
        (key % 3 == 0).alias("is_original"),
    )


def raw_subscriptions_from(subscriptions: DataFrame) -> DataFrame:
    """Subscriptions as an export would hold them, all text, with planted faults by
    remainder: 1 a plan that is no number, 2 a status too long, 3 no user, 4 stands
    twice, 5 stands twice with another status, 6 no start time and an amount out of
    range, 7 an amount with too many digits."""
    key = F.col("subscription_id").cast("long") % RAW_FAULTS
    texts = {f.name: F.col(f.name).cast("string") for f in subscriptions.schema}
    for c in ("started_at", "ended_at"):
        texts[c] = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    for c in ("is_trial", "converted_to_paid"):
        texts[c] = F.initcap(F.col(c).cast("string"))
    texts["plan_id"] = F.when(key == 1, F.concat(F.lit("x"), texts["plan_id"])).otherwise(texts["plan_id"])
    texts["user_id"] = F.when(key != 3, texts["user_id"])
    texts["started_at"] = F.when(key == 6, F.lit("yesterday")).otherwise(texts["started_at"])
    texts["mrr"] = F.when(key == 6, F.lit("1e99")).when(key == 7, F.lit("12345678.90")).otherwise(texts["mrr"])
    time = F.explode(F.when(key.isin(4, 5), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("time")
    late = F.concat("status", F.lit(' since the "twentieth" of the month'))
    status = F.when(F.col("fault") == 2, late).when((F.col("fault") == 5) & (F.col("time") == 2), F.lit('paused, "for now"'))
    rows = subscriptions.select(*[c.alias(n) for n, c in texts.items()], key.alias("fault"), time)
    return rows.withColumn("status", F.coalesce(status, F.col("status"))).select(*texts)


def odd_titles_from(content_catalog: DataFrame) -> DataFrame:
    """(content_id, title): titles with all that a CSV field may hold, by content_id:
    doubled quotes, separators, line breaks of both kinds, outer blanks, an empty text
    and null."""
    key, title = F.col("content_id").cast("long") % 7, F.col("title")
    odd = (
        F.when(key == 0, F.concat(F.lit('The "'), title, F.lit('", again')))
        .when(key == 1, F.concat(title, F.lit(',\n"part two"\n')))
        .when(key == 2, F.concat(F.lit("  "), title, F.lit(" ")))
        .when(key == 3, F.concat(title, F.lit('\r\n"')))
        .when(key == 4, F.lit(""))
        .when(key == 5, F.lit(None).cast("string"))
        .otherwise(title)
    )
    return content_catalog.select("content_id", odd.alias("title"))


@dataclass
class Sources:
    """The source catalog handed to the models (``source()`` / ``ref()``)."""

    spark: SparkSession
    users: DataFrame
    plans: DataFrame
    subscriptions: DataFrame
    events: DataFrame
    sessions: DataFrame
    content_catalog: DataFrame
    content_views: DataFrame
    experiments: DataFrame
    experiment_assignments: DataFrame
    channel_cac: DataFrame
    experiment_effects: DataFrame | None  # None: not given (see experiment_effects)
    settings: Settings = FIXTURE_SETTINGS
    accepted_channels: list[str] = field(default_factory=lambda: list(ACCEPTED_CHANNELS))
    trial_experiment: str | None = None
    lines: DataFrame | None = None  # of the test tables: what sessions and views are projections of

    def tables(self) -> dict[str, DataFrame]:
        return {
            "users": self.users,
            "plans": self.plans,
            "content_catalog": self.content_catalog,
            "subscriptions": self.subscriptions,
            "sessions": self.sessions,
            "events": self.events,
            "content_views": self.content_views,
            "experiments": self.experiments,
            "experiment_assignments": self.experiment_assignments,
        }


def load_fixture_sources(spark: SparkSession, sf_dir: str, settings: Settings = FIXTURE_SETTINGS) -> Sources:
    """All sources, derived lazily from the test tables in ``sf_dir``; nothing runs."""
    raw = {t: read_test_table(spark, sf_dir, t) for t in TEST_TABLES}
    plans = plans_df(spark)
    users = users_from(raw["customer"], raw["nation"])
    experiments = experiment_variants(experiment_definitions_df(spark, FIXTURE_EXPERIMENTS))
    assignments = assign_variants(experiment_eligibility(users, experiments), experiments)
    times = F.when(_falls(F.col("user_id"), LOGGED_TWICE), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    assignments = assignments.withColumn("time", F.explode(times)).drop("time")
    lines = lines_from(raw["lineitem"], raw["orders"])
    return Sources(
        spark=spark,
        users=users,
        plans=plans,
        subscriptions=subscriptions_from(raw["orders"], plans),
        events=events_from(raw["events"]),
        lines=lines,
        sessions=sessions_from(lines),
        content_catalog=content_catalog_from(raw["part"]),
        content_views=content_views_from(lines),
        experiments=experiments,
        experiment_assignments=assignments,
        channel_cac=channel_cac_df(spark, FIXTURE_CHANNEL_CAC),
        experiment_effects=experiment_effects_df(spark, FIXTURE_EFFECTS),
        settings=settings,
        accepted_channels=list(FIXTURE_CHANNELS),
        trial_experiment=FIXTURE_TRIAL_EXPERIMENT,
    )


# Derived tables that the load step writes; lookups stay literal, sessions and
# content views stay projections of the lines.
WRITTEN = ("users", "subscriptions", "events", "lines", "content_catalog", "experiment_assignments")


def write_sources(src: Sources, folder: str, names: Iterable[str] = WRITTEN) -> tuple[Sources, dict[str, float]]:
    """Write the named derived tables below ``folder`` and read them back, like loading
    raw files into warehouse tables before modelling; also the seconds that each
    took. Rows are written where they are derived: splits of the input, or the
    partitions of the join with orders, which AQE sizes and splits where a key is hot."""
    spark = src.spark
    done: dict[str, DataFrame] = {}
    seconds = {}
    for name in names:
        start = time.perf_counter()
        df = getattr(src, name)
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}")
        done[name] = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
        seconds[name] = round(time.perf_counter() - start, 3)
    if "lines" in done:
        done |= {"sessions": sessions_from(done["lines"]), "content_views": content_views_from(done["lines"])}
    return replace(src, **done), seconds


@dataclass
class _Load:
    """What an application has loaded of a folder: tables that are not in ``written``
    are still derived from the test tables."""

    sources: Sources
    folder: str
    written: set[str] = field(default_factory=set)


_LOADED: dict[tuple, _Load] = {}


def _load(spark: SparkSession, sf_dir: str, reload: bool = False) -> _Load:
    key = (spark.sparkContext.applicationId, sf_dir)
    if reload or key not in _LOADED:
        folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/churnlab-tables/sources-{uuid.uuid4().hex}"
        _LOADED[key] = _Load(load_fixture_sources(spark, sf_dir), folder)
    return _LOADED[key]


def _write_missing(load: _Load, names: Iterable[str]) -> Sources:
    if missing := [n for n in names if n not in load.written]:
        load.sources, _ = write_sources(load.sources, load.folder, missing)
        load.written |= set(missing)
    return load.sources


def loaded_sources(spark: SparkSession, sf_dir: str, reload: bool = False) -> Sources:
    """The sources of ``sf_dir`` as tables, written once for an application into the
    shared folder (spark.checkpoint.dir): the load step. ``reload``
    loads them anew, as after a change of the input files."""
    return _write_missing(_load(spark, sf_dir, reload), WRITTEN)


class SourcesOnDemand(Sources):
    """The tables of ``loaded_sources``, each loaded when it is first asked for, so that
    a query waits for the tables that it reads and for no others."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._loading = _load(spark, sf_dir)

    def __getattribute__(self, name: str):
        if name not in Sources.__dataclass_fields__:
            return super().__getattribute__(name)
        table = "lines" if name in ("sessions", "content_views") else name
        return getattr(_write_missing(self._loading, [table] if table in WRITTEN else []), name)
