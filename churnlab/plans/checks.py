"""Declarative data-quality checks.

Each check returns a DataFrame of violations - pass means 0 rows - the way
generic warehouse tests do:

unique           duplicated key values with their row count (nulls ignored)
not_null         (column_name, violations) for columns that have nulls
accepted_values  values outside the list with their row count
range            rows with a value below or above the bounds
relationship     child rows whose non-null key has no parent

``quality_report`` compiles a list of checks into one scan of each table and one
shuffle for all of them, and returns one (table_name, column_name, check_name,
violations) row per check; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.operators.core import anti_orphans, union_all
from churnlab.sources.schemas import KEYS, REQUIRED


def check_unique(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Key values that occur more than once (rows with a null key part are
    ignored). Composite keys pass several columns."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    not_null = F.lit(True)
    for c in cols:
        not_null = not_null & F.col(c).isNotNull()
    return (
        df.where(not_null)
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, violations) for every listed column, from one scan."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in cols])
    return agg.select(F.explode(pairs).alias("p")).select("p.column_name", "p.violations")


def check_not_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns holding nulls, with their null count (all columns by default)."""
    cols = list(cols or df.columns)
    return null_counts(df, cols).where(F.col("violations") > 0)


def check_accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Non-null values outside ``values`` with their row count."""
    c = F.col(col)
    return (
        df.where(c.isNotNull() & ~c.isin(list(values)))
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def check_relationship(child: DataFrame, col: str, parent: DataFrame, parent_col: str | None = None) -> DataFrame:
    """Child key values (one row per child row) with no parent row."""
    return anti_orphans(child.select(col), parent, col, parent_col)


@dataclass(frozen=True)
class Check:
    table: str
    column: str | tuple[str, ...]
    kind: str  # unique | not_null | accepted_values | range | relationship
    values: tuple = ()
    parent: str | None = None
    parent_column: str | None = None
    low: object = None
    high: object = None

    @property
    def column_name(self) -> str:
        return ",".join(self.column) if isinstance(self.column, tuple) else self.column


@dataclass
class CheckSuite:
    checks: list[Check] = field(default_factory=list)

    def add(self, table: str, column, *kinds: str, **kw) -> "CheckSuite":
        for k in kinds:
            self.checks.append(Check(table, column, k, **kw))
        return self


def _key(columns: Sequence[Column]) -> Column:
    """Key values as one text, different for different keys."""
    texts = [c.cast("string") for c in columns]
    if len(texts) == 1:
        return texts[0]
    return F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts])


@dataclass(frozen=True)
class _Says:
    """What a row of a table says to a check when ``condition`` holds: its key, and
    whether it is one of the checked rows or of the parents. Most rows have a key to
    say, few a fault."""

    table: str
    condition: Column
    key: Column
    number: int
    is_fault: bool = True
    is_parent: bool = False

    def row(self) -> Column:
        own, parents = F.lit(0 if self.is_parent else 1), F.lit(1 if self.is_parent else 0)
        said = F.struct(F.lit(self.number).alias("check"), self.key.alias("key"), own.alias("own"), parents.alias("parents"))
        return F.when(self.condition, said)


def _says(number: int, chk: Check) -> list[_Says]:
    columns = [F.col(c) for c in (chk.column if isinstance(chk.column, tuple) else (chk.column,))]
    c, no_key = columns[0], F.lit("")
    present = F.lit(True)
    for part in columns:
        present = present & part.isNotNull()
    if chk.kind == "unique":
        return [_Says(chk.table, present, _key(columns), number, is_fault=False)]
    if chk.kind == "not_null":
        return [_Says(chk.table, c.isNull(), no_key, number)]
    if chk.kind == "accepted_values":
        return [_Says(chk.table, present & ~c.isin(list(chk.values)), _key(columns), number)]
    if chk.kind == "range":
        outside = F.lit(False)
        if chk.low is not None:
            outside = outside | (c < F.lit(chk.low))
        if chk.high is not None:
            outside = outside | (c > F.lit(chk.high))
        return [_Says(chk.table, present & outside, no_key, number)]
    if chk.kind == "relationship":
        parent = F.col(chk.parent_column or chk.column)
        own = _Says(chk.table, present, _key(columns), number, is_fault=False)
        return [own, _Says(chk.parent, parent.isNotNull(), _key([parent]), number, is_fault=False, is_parent=True)]
    raise ValueError(f"unknown check {chk.kind!r}")


def _said_rows(df: DataFrame, says: Sequence[_Says]) -> DataFrame:
    """One scan: rows (check, key, own, parents) of all that the table's rows say."""
    keys, faults = [x for x in says if not x.is_fault], [x for x in says if x.is_fault]
    faulty = F.lit(False)
    for x in faults:
        faulty = faulty | F.coalesce(x.condition, F.lit(False))
    everything = F.array(*[x.row() for x in [*keys, *faults]])
    if not keys:
        rows = df.where(faulty).select(F.explode(everything).alias("said"))
    else:
        said = F.when(faulty, everything).otherwise(F.array(*[x.row() for x in keys])) if faults else everything
        rows = df.select(F.explode(said).alias("said"))
    return rows.where("said IS NOT NULL").select("said.*")


def quality_report(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: (table_name, column_name, check_name, violations).

    violations counts what the failing-rows query returns: duplicated key
    values (unique), null rows (not_null), distinct unaccepted values
    (accepted_values), rows out of bounds (range), orphan rows (relationship).

    Every table is scanned once: a row says (check, key) for each check that it
    has a say in - its keys to unique checks and relationships, as child or
    parent, faults only to the others. What all tables say is counted by check
    and key in one shuffle, summed in the tasks before, so a hot key or a column
    full of nulls is one row a task; the counts make the report. Keys are compared
    as text. A table may have any number of unique keys.
    """
    checks = list(dict.fromkeys(checks))
    says: dict[str, list[_Says]] = {}
    for number, chk in enumerate(checks):
        for x in _says(number, chk):
            says.setdefault(x.table, []).append(x)
    rows = [_said_rows(tables[table], x) for table, x in says.items()]
    by_key = union_all(rows).groupBy("check", "key").agg(F.sum("own").alias("own"), F.sum("parents").alias("parents"))
    orphans = F.when(F.col("parents") == 0, F.col("own")).otherwise(0)
    by_check = by_key.groupBy("check").agg(
        F.count_if(F.col("own") > 1).alias("unique"),
        F.sum("own").alias("rows"),
        F.count(F.lit(1)).alias("values"),
        F.sum(orphans).alias("orphans"),
    )
    counted = {"unique": "unique", "not_null": "rows", "accepted_values": "values", "range": "rows", "relationship": "orphans"}
    said = [(i, c.table, c.column_name, c.kind) for i, c in enumerate(checks)]
    listed = tables[checks[0].table].sparkSession.createDataFrame(said, "check int, table_name string, column_name string, check_name string")
    violations = F.coalesce(*[F.when(F.col("check_name") == kind, F.col(name)) for kind, name in counted.items()], F.lit(0))
    return listed.join(by_check, "check", "left").select("table_name", "column_name", "check_name", violations.cast("bigint").alias("violations"))


# The declared column tests.
def reference_suite(accepted_channels: Sequence[str], accepted_statuses: Sequence[str]) -> list[Check]:
    """The 37 column tests declared for the staging models, marts and seed."""
    s = CheckSuite()
    s.add("stg_users", "user_id", "unique", "not_null")
    s.add("stg_users", "acquisition_channel", "accepted_values", values=tuple(accepted_channels))
    s.add("stg_users", "signup_date", "not_null")
    s.add("stg_plans", "plan_id", "unique", "not_null")
    s.add("stg_subscriptions", "subscription_id", "unique", "not_null")
    s.add("stg_subscriptions", "user_id", "not_null")
    s.add("stg_subscriptions", "user_id", "relationship", parent="stg_users", parent_column="user_id")
    s.add("stg_subscriptions", "status", "accepted_values", values=tuple(accepted_statuses))
    s.add("stg_sessions", "session_id", "unique", "not_null")
    s.add("stg_sessions", "user_id", "not_null")
    s.add("stg_content_catalog", "content_id", "unique", "not_null")
    s.add("stg_events", "event_id", "unique", "not_null")
    s.add("stg_content_views", "view_id", "unique", "not_null")
    s.add("stg_experiments", "experiment_id", "not_null")
    s.add("stg_experiments", "is_control", "not_null")
    s.add("stg_experiment_assignments", "user_id", "not_null")
    s.add("stg_experiment_assignments", "experiment_id", "not_null")
    s.add("mart_acquisition", "user_id", "unique", "not_null")
    s.add("mart_acquisition", "acquisition_channel", "not_null")
    s.add("mart_engagement", "user_id", "not_null")
    s.add("mart_engagement", "cohort_month", "not_null")
    s.add("mart_economics", "subscription_id", "not_null")
    s.add("mart_economics", "active_month", "not_null")
    s.add("mart_experiments", "user_id", "not_null")
    s.add("mart_experiments", "experiment_id", "not_null")
    s.add("mart_experiments", "is_control", "not_null")
    s.add("channel_cac", "acquisition_channel", "unique", "not_null")
    s.add("channel_cac", "channel_cac", "not_null")
    return s.checks


def key_suite() -> list[Check]:
    """Declared keys of more than one column."""
    return [Check(f"stg_{table}", key, "unique") for table, key in KEYS.items() if len(key) > 1]


def full_suite(accepted_channels: Sequence[str], accepted_statuses: Sequence[str]) -> list[Check]:
    return reference_suite(accepted_channels, accepted_statuses) + key_suite()


def load_constraints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Violations of the declared keys and NOT NULL columns of the source tables
    (and seed), which files cannot enforce: one row per key and column."""
    checks = [Check(t, KEYS[t], "unique") for t in tables]
    checks += [Check(t, c, "not_null") for t in tables for c in REQUIRED[t]]
    return quality_report(tables, checks)
