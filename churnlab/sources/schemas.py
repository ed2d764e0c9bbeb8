"""Declared schemas of the nine source tables and the CAC seed.

Types follow the reference's table declarations: NUMERIC(8,2) -> decimal(8,2),
TIMESTAMP without zone -> timestamp_ntz, VARCHAR -> string. ``REQUIRED`` lists the
NOT NULL columns, ``KEYS`` the primary keys, ``LENGTHS`` the longest texts; they
feed the data-quality checks and the load gate.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

S, I, D, TS, B = StringType(), IntegerType(), DateType(), TimestampNTZType(), BooleanType()


def _schema(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# Names, types, order, keys and staging columns of the tables.
SCHEMAS: dict[str, StructType] = {
    "plans": _schema(
        ("plan_id", I, False),
        ("plan_name", S, False),
        ("price_monthly", DecimalType(8, 2), False),
        ("billing_period", S, False),
        ("max_streams", I, False),
        ("resolution", S, False),
    ),
    "content_catalog": _schema(
        ("content_id", S, False),
        ("title", S, True),
        ("content_type", S, True),
        ("genre", S, True),
        ("release_year", I, True),
        ("duration_minutes", I, True),
        ("is_original", B, True),
    ),
    "users": _schema(
        ("user_id", S, False),
        ("signup_date", D, False),
        ("signup_timestamp", TS, False),
        ("acquisition_channel", S, False),
        ("country", S, False),
        ("primary_device", S, False),
        ("age", I, True),
        ("email", S, True),
    ),
    # CSV column order differs from the declaration order (name before variant).
    "experiments": _schema(
        ("experiment_id", S, False),
        ("experiment_name", S, True),
        ("variant", S, False),
        ("start_date", D, True),
        ("end_date", D, True),
        ("is_control", B, True),
    ),
    "experiment_assignments": _schema(
        ("experiment_id", S, False),
        ("user_id", S, False),
        ("variant", S, False),
        ("assigned_at", TS, False),
    ),
    "subscriptions": _schema(
        ("subscription_id", S, False),
        ("user_id", S, False),
        ("plan_id", I, False),
        ("status", S, False),
        ("started_at", TS, False),
        ("ended_at", TS, True),
        ("is_trial", B, True),
        ("converted_to_paid", B, True),
        ("mrr", DecimalType(8, 2), True),
    ),
    "events": _schema(
        ("event_id", S, False),
        ("user_id", S, False),
        ("event_type", S, False),
        ("event_timestamp", TS, False),
    ),
    "sessions": _schema(
        ("session_id", S, False),
        ("user_id", S, False),
        ("session_date", D, False),
        ("session_start", TS, False),
        ("duration_minutes", I, False),
        ("device", S, True),
    ),
    "content_views": _schema(
        ("view_id", S, False),
        ("user_id", S, False),
        ("session_id", S, False),
        ("content_id", S, False),
        ("view_date", D, False),
        ("watch_percentage", DecimalType(4, 2), True),
        ("completed", B, True),
    ),
    "channel_cac": _schema(
        ("acquisition_channel", S, False),
        ("channel_cac", I, False),
    ),
}

SOURCE_TABLES = (
    "users",
    "plans",
    "content_catalog",
    "subscriptions",
    "sessions",
    "events",
    "content_views",
    "experiments",
    "experiment_assignments",
)

KEYS: dict[str, tuple[str, ...]] = {
    "plans": ("plan_id",),
    "content_catalog": ("content_id",),
    "users": ("user_id",),
    "experiments": ("experiment_id", "variant"),
    "experiment_assignments": ("experiment_id", "user_id"),
    "subscriptions": ("subscription_id",),
    "events": ("event_id",),
    "sessions": ("session_id",),
    "content_views": ("view_id",),
    "channel_cac": ("acquisition_channel",),
}

REQUIRED: dict[str, tuple[str, ...]] = {
    name: tuple(f.name for f in schema.fields if not f.nullable) for name, schema in SCHEMAS.items()
}

# The declared lengths of text columns, in characters.
LENGTHS: dict[str, dict[str, int]] = {
    "plans": {"plan_name": 20, "billing_period": 10, "resolution": 10},
    "content_catalog": {"content_id": 10, "title": 200, "content_type": 20, "genre": 30},
    "users": {"user_id": 15, "acquisition_channel": 30, "country": 5, "primary_device": 20, "email": 200},
    "experiments": {"experiment_id": 30, "experiment_name": 100, "variant": 50},
    "experiment_assignments": {"experiment_id": 30, "user_id": 15, "variant": 50},
    "subscriptions": {"subscription_id": 15, "user_id": 15, "status": 20},
    "events": {"event_id": 15, "user_id": 15, "event_type": 40},
    "sessions": {"session_id": 20, "user_id": 15, "device": 20},
    "content_views": {"view_id": 20, "user_id": 15, "session_id": 20, "content_id": 10},
}

# Columns each staging model passes through, in the staging models' order.
STAGING_COLUMNS: dict[str, tuple[str, ...]] = {
    "users": (
        "user_id",
        "signup_timestamp",
        "signup_date",
        "acquisition_channel",
        "country",
        "primary_device",
        "age",
        "email",
    ),
    "plans": ("plan_id", "plan_name", "price_monthly", "billing_period", "max_streams", "resolution"),
    "subscriptions": (
        "subscription_id",
        "user_id",
        "plan_id",
        "status",
        "started_at",
        "ended_at",
        "is_trial",
        "converted_to_paid",
        "mrr",
    ),
    "sessions": ("session_id", "user_id", "session_date", "session_start", "duration_minutes", "device"),
    "events": ("event_id", "user_id", "event_type", "event_timestamp"),
    "content_catalog": (
        "content_id",
        "title",
        "content_type",
        "genre",
        "release_year",
        "duration_minutes",
        "is_original",
    ),
    "content_views": (
        "view_id",
        "user_id",
        "session_id",
        "content_id",
        "view_date",
        "watch_percentage",
        "completed",
    ),
    "experiments": ("experiment_id", "experiment_name", "variant", "start_date", "end_date", "is_control"),
    "experiment_assignments": ("experiment_id", "user_id", "variant", "assigned_at"),
}
