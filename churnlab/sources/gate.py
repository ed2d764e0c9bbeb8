"""Load gate: rows of text that break the declared types, lengths, NOT NULL columns
or keys of a table leave with their reasons, all others go on with their types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from churnlab.sources.csv import read_records
from churnlab.sources.schemas import KEYS, LENGTHS, REQUIRED, SCHEMAS

SHAPES = {"date": r"^\d{4}-\d{2}-\d{2}$", "timestamp_ntz": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"}
#: Column of records that do not have the table's fields.
RECORD = "_record"


@dataclass(frozen=True)
class Gated:
    accepted: DataFrame  # the table's columns, typed
    rejects: DataFrame  # its columns as text, (record,) reasons array<string>, n_rows


def readable(text: Column, kind: str) -> Column:
    """Whether a text is a value of the type, written the way exports write it.
    Numbers out of range are not; further decimals are rounded, as on a warehouse load."""
    fits = text.try_cast(kind).isNotNull()
    return fits & text.rlike(SHAPES[kind]) if kind in SHAPES else fits


def text_schema(table: str) -> StructType:
    return StructType([StructField(f.name, StringType()) for f in SCHEMAS[table]])


def read_raw(spark, path: str, table: str) -> DataFrame:
    """The CSV files of a table as columns of text; records without its fields stand
    whole in ``_record``."""
    return read_records(spark, path, text_schema(table), corrupt=RECORD)


def broken_rules(schema: StructType, lengths: Mapping[str, int], required: Sequence[str], has_record: bool = False) -> Column:
    """The reasons why a row of text is rejected, but for its key: record, then null:,
    type: and length: with the column, in the order of the columns."""
    reasons = []
    for f in schema:
        kind, c = f.dataType.simpleString(), F.col(f"`{f.name}`")
        if f.name in required:
            reasons.append(F.when(c.isNull(), F.lit(f"null:{f.name}")))
        if kind != "string":
            reasons.append(F.when(c.isNotNull() & ~readable(c, kind), F.lit(f"type:{f.name}")))
        elif f.name in lengths:
            reasons.append(F.when(F.length(c) > lengths[f.name], F.lit(f"length:{f.name}")))
    found = F.filter(F.array(*reasons), lambda r: r.isNotNull())
    if not has_record:
        return found
    return F.when(F.col(RECORD).isNotNull(), F.array(F.lit("record"))).otherwise(found)


def row_print(columns: Sequence[str]) -> Column:
    """Hash of a row by which one row of a key is elected."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`")), F.lit("")) for c in columns]))


def gated(
    raw: DataFrame,
    schema: StructType,
    key: Sequence[str] = (),
    lengths: Mapping[str, int] | None = None,
    required: Sequence[str] = (),
) -> Gated:
    """Split rows of text (the columns of ``schema``, and ``_record`` if there are records
    that could not be read) into those to load and those rejected.

    Of rows without other faults that share a key, the one with the smallest hash is
    loaded, once; the others, its own copies too, are rejected with reason ``key:``.
    Rejected rows that are equal are one row with their number. A null key part is
    ``null:`` where the column is required, and else no key at all.

    Only keys and hashes are shuffled to find keys that occur twice (summed before, so a
    key of a third of all rows is a few rows); whole rows are only where keys do.
    """
    columns, has_record = schema.names, RECORD in raw.columns
    kept = columns + [RECORD] * has_record
    tested = raw.select(*kept, broken_rules(schema, lengths or {}, required, has_record).alias("reasons"))
    sound = F.size("reasons") == 0
    typed = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema]

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*kept, "reasons").agg(F.count(F.lit(1)).alias("n_rows"))

    broken = counted(tested.filter(~sound))
    if not key:
        return Gated(tested.filter(sound).select(*typed), broken)
    has_key = F.lit(True)
    for c in key:
        has_key = has_key & F.col(f"`{c}`").isNotNull()
    # Keys are equal as values, not as texts: 7 and 07 are one number.
    kinds = {f.name: f.dataType for f in schema}
    of = [F.when(sound & has_key, F.col(f"`{c}`").cast(kinds[c])).alias(f"_key{i}") for i, c in enumerate(key)]
    names = [f"_key{i}" for i in range(len(key))]
    keyed = tested.select("*", row_print(columns).alias("_print"), *of)
    twice = keyed.filter(F.col(names[0]).isNotNull()).groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), F.min("_print").alias("_elected"))
    marked = keyed.join(twice.filter("_n > 1").drop("_n"), names, "left")
    alone = marked.filter(sound & F.col("_elected").isNull())
    rivals = marked.filter(sound & F.col("_elected").isNotNull()).groupBy(*kept, "_print", "_elected").agg(F.count(F.lit(1)).alias("n_rows"))
    wins = (F.col("_print") == F.col("_elected")).cast("long")
    lost = rivals.withColumn("n_rows", F.col("n_rows") - wins).filter("n_rows > 0")
    reason = F.array(F.lit("key:" + ",".join(key))).alias("reasons")
    return Gated(
        alone.select(*typed).unionByName(rivals.filter(wins == 1).select(*typed)),
        broken.unionByName(lost.select(*kept, reason, "n_rows")),
    )


def load_gate(raw: DataFrame, table: str, schema: StructType | None = None) -> Gated:
    """The gate of a declared table (``schema``: with other types for its columns)."""
    return gated(raw, schema or SCHEMAS[table], KEYS[table], LENGTHS.get(table, {}), REQUIRED[table])
