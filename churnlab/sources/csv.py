"""CSV as exports write it: quoted fields with doubled quotes, separators, line
breaks and outer blanks, from files that stay splittable.

A line break is the end of a record where the number of quotes before it is even
(a doubled quote counts two). One scan counts the quotes of each split of a file;
their running sum tells every split whether it starts inside quotes. A second
scan then cuts each split into records. What is left open at the borders of
splits, at most two fragments a split, is put together by file and place.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: How fields are written and read: quotes inside quotes are doubled, an empty
#: field is null, an empty text is "", blanks belong to the text.
DIALECT = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "dateFormat": "yyyy-MM-dd",
}
# The reader tells an empty field from an empty text ("") only by a null mark of its
# own, which no text may be.
READ = DIALECT | {"multiLine": "true", "nullValue": "\0\0null"}
WRITE = DIALECT | {"emptyValue": '""', "lineSep": "\n"}

_PIECES = pa.schema([("file", pa.int64()), ("start", pa.int64()), ("part", pa.int32()), ("kind", pa.string()), ("record", pa.string())])
PIECES = "file long, start long, part int, kind string, record string"


def _joined(lines: pa.Array, ends: list[int]) -> pa.Array:
    """Lines put together up to each of the ends (exclusive)."""
    lists = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), lines.slice(0, ends[-1]))
    return pc.binary_join(lists, "\n")


class _Split:
    """The records of one split, line after line."""

    def __init__(self, file: int, start: int, inside: bool):
        self.file, self.start, self.inside = file, start, inside
        self.continues = inside  # the record at hand began in an earlier split
        self.held: list[pa.Array] = []
        self.first = start == 0

    def rows(self, records: pa.Array, kinds: list[str], part: int) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(self.file, pa.int64()), n), pa.repeat(pa.scalar(self.start, pa.int64()), n), pa.repeat(pa.scalar(part, pa.int32()), n), pa.array(kinds, pa.string()), records.cast(pa.string())],
            schema=_PIECES,
        )

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        quotes = pc.cumulative_sum(pc.count_substring(lines, '"').cast(pa.int64())).to_numpy()
        ends = ((((quotes + self.inside) % 2) == 0).nonzero()[0] + 1).tolist()
        self.inside = bool((quotes[-1] + self.inside) % 2)
        if not ends:
            self.held.append(lines)
            return
        records = _joined(lines, ends)
        if self.held:
            whole = pa.concat_arrays([*self.held, records.slice(0, 1)])
            records = pa.concat_arrays([_joined(whole, [len(whole)]), records.slice(1)])
        self.held = [lines.slice(ends[-1])] if ends[-1] < len(lines) else []
        if self.continues:
            yield self.rows(records.slice(0, 1), ["head"], 0)
            self.continues, records = False, records.slice(1)
        if len(records):
            kinds = ["header" if self.first and i == 0 else "whole" for i in range(len(records))]
            self.first = False
            yield self.rows(records, kinds, 0)

    def end(self) -> Iterator[pa.RecordBatch]:
        """What is still open belongs to a record that goes on in the next split."""
        if self.held:
            lines = pa.concat_arrays(self.held)
            kind = "middle" if self.continues else "tail"
            yield self.rows(_joined(lines, [len(lines)]), [kind], 0 if self.continues else 1)


def _cut(batches) -> Iterator[pa.RecordBatch]:
    split: _Split | None = None
    for batch in batches:
        files, starts, inside = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
        at = 0
        while at < batch.num_rows:
            same = (files[at:] == files[at]) & (starts[at:] == starts[at])
            stop = batch.num_rows if same.all() else at + int(same.argmin())
            if inside[at] is None:
                raise ValueError("a file was split in another way than when its quotes were counted: read it again")
            if split is None or (split.file, split.start) != (files[at], starts[at]):
                if split:
                    yield from split.end()
                split = _Split(int(files[at]), int(starts[at]), bool(inside[at]))
            yield from split.add(batch.column(0).slice(at, stop - at))
            at = stop
    if split:
        yield from split.end()


def records(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """One row (record) for each record of the CSV files at ``path``, without blank
    lines and each file's first record, the header; with ``header`` every file's
    must be that one (quotes aside), else reading fails. A record is the text
    between two line breaks outside of quotes; line breaks in quotes are kept.

    The parity of splits is joined as one row for each split of a file, far fewer
    than its rows. Quotes that are never closed leave their text as one record.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select("value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    odd = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    state = odd.select("file", "start", "odd", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    placed = lines.join(F.broadcast(state), ["file", "start"], "left").select("value", "file", "start", "inside", "odd")

    whole = placed.drop("odd").mapInArrow(_cut, PIECES).filter(F.col("kind").isin("whole", "header"))
    # Only splits that start or end inside quotes have fragments.
    at_border = placed.filter("inside or odd = 1").drop("odd").mapInArrow(_cut, PIECES).filter(~F.col("kind").isin("whole", "header"))
    in_order = Window.partitionBy("file").orderBy("start", "part")
    numbered = at_border.withColumn("nth", F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(in_order))
    parts = F.array_sort(F.collect_list(F.struct("start", "part", "record")))
    stitched = numbered.groupBy("file", "nth").agg(F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"))

    text = F.regexp_replace("record", "\r$", "")
    keep = F.col("kind") == "whole"
    if header is not None:
        wrong = F.raise_error(F.concat(F.lit(f"header should be {header}: "), text)).cast("boolean")
        keep = F.when(keep, True).when(F.replace(text, F.lit('"')) == header, False).otherwise(wrong)
    found = whole.filter(keep).select(text.alias("record")).unionByName(stitched.select(text.alias("record")))
    return found.filter("record <> ''")


def read_records(spark: SparkSession, path: str, schema: StructType, corrupt: str | None = None, check_header: bool = True) -> DataFrame:
    """The records of the CSV files at ``path`` with the columns of ``schema``.

    A record that does not fit fails the read; with ``corrupt`` (the name of a column
    to add) it is kept there, and columns that could not be read are null."""
    found = records(spark, path, ",".join(schema.names) if check_header else None)
    options = READ | {"mode": "PERMISSIVE" if corrupt else "FAILFAST"}
    # Fields of declared NOT NULL columns may be empty in a file: checks find them.
    fields = [StructField(f.name, f.dataType) for f in schema]
    if corrupt:
        options["columnNameOfCorruptRecord"] = corrupt
        fields.append(StructField(corrupt, StringType()))
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return found.select(F.from_csv("record", kind, options).alias("r")).select("r.*")


#: Types from narrow to wide, as inference tries them; text fits all.
LATTICE = ("boolean", "int", "bigint", "decimal(38,18)", "double", "date", "timestamp_ntz")


def inferred_types(df: DataFrame, declared: StructType) -> DataFrame:
    """Rows (column_name, declared_type, inferred_type, n_values, n_deciding) for columns
    of text: the narrowest type that all values of a column can be read as (null: no
    values), and how many values the next narrower type that was ruled out cannot hold
    (of the one that the fewest values speak against; 0: none was ruled out).

    One aggregate over all columns (a count for each column and type), so partial
    results merge in any order."""
    columns = declared.names
    fails = {(c, t): f"{i}_{j}" for i, c in enumerate(columns) for j, t in enumerate(LATTICE)}
    counts = [F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)]
    for (c, t), name in fails.items():
        bad = F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()
        if t == "boolean":
            bad = F.col(c).isNotNull() & ~F.lower(c).isin("true", "false")
        if t in ("date", "timestamp_ntz"):
            # Casts take years alone and the like; exports write whole dates and times.
            shape = r"^\d{4}-\d{2}-\d{2}$" if t == "date" else r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
            bad = F.col(c).isNotNull() & (F.col(c).try_cast(t).isNull() | ~F.col(c).rlike(shape))
        counts.append(F.count_if(bad).alias(name))
    one = df.agg(*counts)
    rows = []
    for i, f in enumerate(declared):
        inferred, deciding = F.lit("string"), F.least(*[F.col(fails[f.name, t]) for t in LATTICE])
        for j in reversed(range(len(LATTICE))):
            fits = F.col(fails[f.name, LATTICE[j]]) == 0
            inferred = F.when(fits, F.lit(LATTICE[j])).otherwise(inferred)
            ruled_out = [F.col(fails[f.name, t]) for t in LATTICE[:j]]
            deciding = F.when(fits, F.least(*ruled_out) if len(ruled_out) > 1 else ruled_out[0] if ruled_out else F.lit(0)).otherwise(deciding)
        n = F.col(f"n_{i}")
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("declared_type"),
                F.when(n > 0, inferred).alias("inferred_type"),
                n.alias("n_values"),
                F.when(n > 0, deciding).otherwise(0).cast("long").alias("n_deciding"),
            )
        )
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
