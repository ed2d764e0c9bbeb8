"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import math
import uuid
from collections.abc import Iterable
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlab.session import ensure_checkpoint_dir

# The white space of the contracts, [\x20\x09-\x0D].
WHITE_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run below the folder named by spark.checkpoint.dir."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def mounted(folder: str) -> str:
    """The path by which workers open files in a shared folder.

    Workers write archives and map model files themselves, so the shared folder
    has to be mounted on every machine (a ``file:`` URL or a plain path).
    """
    parts = urlparse(folder)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{folder}: workers need a shared folder that is mounted as a file system")
    return unquote(parts.path) if parts.scheme else folder


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: a lost executor is made good from these files.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of jobs that are done and not referred to:
    it does so when the collectors of Python and the driver have run, which without
    need they seldom do."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def whole_text(name: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a variant of it that no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named input columns, under the operator's own names.

    Operators work on these, so that further columns of the input (whatever
    they are called) cannot clash with the names used inside.
    """
    return df.select(*[F.col(f"`{source}`").alias(own) for own, source in columns.items()])


def _edge_print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected(edges: DataFrame) -> DataFrame:
    """Connected components of the graph with the given edges (a, b).

    Returns (node, component): every node that has an edge to another node, and
    the smallest node that it reaches. Alternates the large-star and small-star
    steps until the edges no longer change (Kiveris et al., "Connected
    Components in MapReduce and Beyond", 2014); the driver sees two numbers a
    round, each round's edges are a written table. Minima are aggregated before
    they are joined back to the edges, so no node's edges meet in one task.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _edge_print(now)
    while before[0]:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a <> b").distinct()
        # All edges of ``large`` lead from a larger node a to a smaller b.
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", "low"), F.struct(F.col("b").alias("a"), "low"))).alias("e"))
        now = written(small.select("e.a", F.col("e.low").alias("b")).filter("a <> b").distinct(), "edges")
        after = _edge_print(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def split_points(df: DataFrame, key: str, parts: int) -> list:
    """About ``parts`` values of ``key`` that deal the rows out evenly, in order."""
    ranged = df.select(key).repartitionByRange(parts, key).groupBy(F.spark_partition_id().alias("p")).agg(F.min(key).alias("low"))
    return sorted({r["low"] for r in ranged.collect() if r["low"] is not None})


def _place_among(points: list, key: str, kind: str) -> Column:
    """How many of the sorted points are at most the key: among every step-th
    first, then among those up to the next."""
    step = max(1, math.isqrt(len(points)))

    def array(values: list) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")

    def reached(values: Column) -> Column:
        return F.size(F.filter(values, lambda p: p <= F.col(key)))

    coarse = reached(array(points[step - 1 :: step])) * step
    return coarse + reached(F.slice(array(points), coarse + 1, F.lit(step)))


def neighbour_runs(df: DataFrame, key: str, parts: int, wrap: bool = False, both_sides: bool = False) -> DataFrame:
    """Deal rows into sorted runs that also hold their neighbours from other runs.

    Adds ``run`` and ``place``. A run holds consecutive keys (place 0) and, at
    place 1, a copy of all rows of the key that comes next, with ``both_sides``
    at place -1 those of the key before. Sorted by run, place and key, a run shows
    every row next to its neighbours, however the rows were dealt out. With
    ``wrap`` the first key follows the last. The driver sees two keys per run.
    Runs are dealt by range of their number: they never share keys, and a run is
    never split. Keys must not be null.
    """
    points = split_points(df, key, parts)
    kind = df.schema[key].dataType
    dealt = df.withColumn("run", _place_among(points[1:], key, kind.simpleString()))
    ends = sorted(tuple(r) for r in dealt.groupBy("run").agg(F.min(key), F.max(key)).collect())
    copies = [(b[1], a[0], 1) for a, b in zip(ends, ends[1:])]
    if both_sides:
        copies += [(a[2], b[0], -1) for a, b in zip(ends, ends[1:])]
    if wrap and ends:
        copies.append((ends[0][1], ends[-1][0], 1))
    rows = dealt.withColumn("place", F.lit(0))
    if copies:
        to: dict[object, list] = {}
        for value, run, place in copies:
            to.setdefault(value, []).append(F.struct(F.lit(run).alias("run"), F.lit(place).alias("place")))
        goes = F.create_map(*[x for value, where in to.items() for x in (F.lit(value).cast(kind), F.array(*where))])
        again = dealt.filter(F.col(key).isin(list(to))).drop("run").withColumn("to", F.explode(F.element_at(goes, F.col(key))))
        rows = rows.unionByName(again.select(*df.columns, "to.run", "to.place"))
    return rows.repartitionByRange(max(1, len(points)), "run")


def chunks(batches: Iterable, rows: int):
    """Slices of at most ``rows`` rows of Arrow batches."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
