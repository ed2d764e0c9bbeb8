"""Exact dedup by progressive refinement, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlab.llm.common import WHITE_SPACE, free_name, picked, whole_text, written

PREFIX_CHARS = 256


def without_white_space(text: Column) -> Column:
    return F.translate(text, WHITE_SPACE, "")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Groups of documents whose texts are equal without white space.

    Texts are refined step by step: first by the length of the normalised text,
    then by a hash of its first ``prefix_chars`` characters, then by the SHA-256
    of all of it. Every step works on the rows that still share their key with
    another row; only for those is the full text read again and hashed. Of a
    group the row with the most code points in its own text stays, then the one
    with the smallest id.

    Returns one row per document that has a partner: id, keep_id, group_size,
    kept, text_sha256 and copies (how many input rows have this id and text).
    Null texts count as empty, and equal each other. A null id comes after all
    others when ties are broken. Rows that repeat an id with the same text are
    one output row with ``copies`` above one and count in group_size.

    Equal keys are counted with map-side aggregation and the counts joined back,
    so no group of copies meets in one task. Lists of rows that grow with the
    data are never broadcast: the plan is the same at every size.
    """
    rows = picked(docs, id=id_col, text=text_col).withColumn("text", whole_text("text"))
    squeezed = without_white_space(F.col("text"))
    # Step 1 and 2: narrow keys from one scan; the text itself is not kept.
    keys = written(rows.select("id", F.length(squeezed).alias("len"), F.xxhash64(F.substring(squeezed, 1, prefix_chars)).alias("prefix")), "exact-keys")
    lengths = keys.groupBy("len").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("len")
    same_length = keys.join(lengths, "len", "left_semi")
    prefixes = same_length.groupBy("len", "prefix").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("len", "prefix")
    survivors = same_length.join(prefixes, ["len", "prefix"], "left_semi").select("id").distinct().hint("merge")
    # Step 3: full content of the survivors only.
    full = rows.join(survivors, rows["id"].eqNullSafe(survivors["id"]), "left_semi").select(
        "id", F.length("text").alias("n_chars"), F.sha2(squeezed.cast("binary"), 256).alias("text_sha256")
    )
    full = written(full.groupBy("id", "text_sha256").agg(F.max("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies")), "exact-hashes")
    best = F.struct("n_chars", F.col("id").isNotNull().alias("known"), F.bitwise_not("id").alias("order"))
    groups = full.groupBy("text_sha256").agg(F.max(best).alias("best"), F.sum("copies").alias("group_size")).filter("group_size > 1")
    groups = groups.select("text_sha256", F.bitwise_not("best.order").alias("keep_id"), F.col("group_size").cast("long").alias("group_size"))
    return full.join(groups, "text_sha256").select("id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "copies")


def exact_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Rows without a partner keep themselves. Of rows that repeat the kept id with
    the same text, one is kept.
    """
    groups = exact_groups(docs, id_col, text_col).withColumnRenamed("text_sha256", "sha")
    rows = picked(docs, id=id_col, text=text_col).select("id", F.sha2(without_white_space(whole_text("text")).cast("binary"), 256).alias("text_sha256"))
    rows = rows.groupBy("id", "text_sha256").agg(F.count(F.lit(1)).alias("rows"))
    grouped = groups.select(F.col("id").alias("g_id"), "sha", "keep_id", "group_size", "kept")
    joined = rows.join(grouped, rows["id"].eqNullSafe(F.col("g_id")) & (F.col("text_sha256") == F.col("sha")), "left")
    joined = joined.select(
        "id",
        F.when(F.col("sha").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce("kept", F.lit(True)).alias("kept"),
        "text_sha256",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("copy"),
    )
    return joined.select("id", "keep_id", "group_size", (F.col("kept") & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def exact_kept(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are dropped by an anti join on id and text hash, so that rows without
    a partner are never moved for it; rows that repeat a kept id and text are
    reduced to one.
    """
    groups = written(exact_groups(docs, id_col, text_col).filter("not kept or copies > 1"), "exact-groups")
    sha, other_id, other_sha = (free_name(docs, n) for n in ("own_sha256", "other_id", "other_sha256"))
    names = (F.col("id").alias(other_id), F.col("text_sha256").alias(other_sha))
    same = [F.col(f"`{id_col}`").eqNullSafe(F.col(other_id)), F.col(sha) == F.col(other_sha)]
    hashed = docs.withColumn(sha, F.sha2(without_white_space(whole_text(text_col)).cast("binary"), 256))
    left = hashed.join(groups.filter("not kept").select(*names).hint("merge"), same, "left_anti")
    repeated = groups.filter("kept and copies > 1").select(*names)
    if repeated.isEmpty():
        return left.drop(sha)
    again = left.join(repeated, same, "left_semi").dropDuplicates([id_col, sha])
    return left.join(repeated, same, "left_anti").unionByName(again).drop(sha)
