"""Mixing sources to target weights, in DataFrame operations only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnlab.llm.common import WHITE_SPACE, free_name, picked, whole_text, written

TARGET_ENTROPY = 0.95  # of the entropy of equal weights
MAX_REPEATS = 2.0
BLOCK_TOKENS = 1_000_000
SEED = 1
#: Halvings of the exponent's interval; each job evaluates the mid points of STEP halvings.
HALVINGS, STEP = 40, 5
#: Leading hex digits of a permutation key that name a slice of an epoch.
SLICE_DIGITS = 3


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{WHITE_SPACE}]+")).cast("long")


@dataclass(frozen=True)
class Weights:
    """exponent, and budget: tokens of the whole mixture; sources: a written
    table (source_key, tokens, weight, budget)."""

    exponent: float
    budget: int
    sources: DataFrame


def _meets(z: float, zl: float, share_low: float, share_high: float, a: float, n: int, entropy: float, repeats: float, budget_share: float | None) -> bool:
    reached = math.log(z) - a * zl / z
    most = share_low ** (a - 1) / (share_high ** (a - 1) if budget_share is None else z / budget_share)
    return reached <= entropy * math.log(n) + 1e-12 and most <= repeats + 1e-12


def temperature_weights(tokens: DataFrame, entropy: float = TARGET_ENTROPY, repeats: float = MAX_REPEATS, budget: int | None = None) -> Weights:
    """Weights of the sources in ``tokens`` (source_key, tokens).

    A source's weight is its share of all tokens to the power a, normalised.
    Smaller exponents are flatter: they raise the entropy of the weights and the
    number of times that small sources are repeated. The smallest a in [0, 1] at
    which the entropy is at most ``entropy`` of that of equal weights, and no
    source is seen more than ``repeats`` times, is found by bisection; each job
    evaluates all mid points that the next five halvings can reach, as sums over
    the sources. If even a = 1 is over a limit, the weights are the shares.

    Without ``budget`` the mixture is as long as it takes to show every token at
    least once, so that nothing is left out. Sources without tokens have weight
    and budget 0.
    """
    sources = written(tokens.groupBy("source_key").agg(F.sum("tokens").alias("tokens")), "sources")
    known = sources.filter("tokens > 0")
    total, n, low, high = known.agg(F.sum("tokens"), F.count(F.lit(1)), F.min("tokens"), F.max("tokens")).first()
    if not n:
        return Weights(1.0, 0, sources.select("source_key", "tokens", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("budget")))
    share = F.col("tokens") / F.lit(float(total))
    limits = (n, entropy, repeats, None if budget is None else budget / total)

    def sums(exponents: list[float]) -> list[bool]:
        powers = [F.pow(share, F.lit(a)) for a in exponents]
        row = known.agg(*[x for p in powers for x in (F.sum(p), F.sum(p * F.log(share)))]).first()
        return [_meets(row[2 * i], row[2 * i + 1], low / total, high / total, a, *limits) for i, a in enumerate(exponents)]

    start, end = sums([0.0, 1.0])
    if start:
        exponent = 0.0
    elif not end:
        exponent = 1.0
    else:
        lower, upper = 0.0, 1.0
        for _ in range(HALVINGS // STEP):
            points = [lower + (upper - lower) * i / 2**STEP for i in range(1, 2**STEP)]
            met = dict(zip(points, sums(points)))
            for _ in range(STEP):
                middle = lower + (upper - lower) / 2
                lower, upper = (lower, middle) if met[middle] else (middle, upper)
        exponent = upper
    power = F.pow(share, F.lit(exponent))
    (z,) = known.agg(F.sum(power)).first()
    weight = F.when(F.col("tokens") > 0, F.round(power / F.lit(z), 9)).otherwise(F.lit(0.0))
    weighted = sources.withColumn("weight", weight)
    if budget is None:
        budget = int(weighted.filter("weight > 0").agg(F.max(F.ceil(F.col("tokens") / F.col("weight")))).first()[0])
        own = F.greatest("tokens", F.round(F.col("weight") * F.lit(budget)).cast("long"))
    else:
        own = F.round(F.col("weight") * F.lit(budget)).cast("long")
    return Weights(exponent, budget, written(weighted.withColumn("budget", own), "weights"))


def mixture(rows: DataFrame, weights: Weights | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = SEED, **target) -> DataFrame:
    """The order in which documents are to be seen: rows (id, source, tokens) give
    rows (id, source, tokens, epoch, block, rank). A column ``row`` is handed on.

    A source is seen in epochs, each a new permutation of its documents (by a
    hash of seed, epoch and id), until its budget of tokens is spent: a document
    is taken if less than the budget lies before it. The mixture is cut into
    blocks of ``block_tokens``; every source is spread evenly over them, so each
    block holds the weights, and the documents of a block are ranked by their
    hash. Documents without words take no budget and are seen once an epoch;
    in a source without any words they are seen once, in a block by hash.

    A null source is a source of its own; a null id is hashed like an id of its own;
    repeated rows are documents of their own. No rows give no rows.

    Token positions are running sums in two levels: within slices of an epoch
    named by the first digits of the hash, and over the sums of the slices. So a
    source that holds most rows is summed in thousands of tasks.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    more = [c for c in rows.columns if c == "row"]
    rows = written(rows.select("id", "source", key.alias("source_key"), F.col("tokens").cast("long").alias("tokens"), *more), "mix-rows")
    weights = weights or temperature_weights(rows.select("source_key", "tokens"), **target)
    blocks = max(1, -(-weights.budget // block_tokens))
    sources = weights.sources.select("source_key", F.col("tokens").alias("all_tokens"), "budget")
    epochs = F.when(F.col("all_tokens") > 0, F.ceil(F.col("budget") / F.col("all_tokens"))).otherwise(F.lit(1)).cast("long")
    seen = rows.join(sources, "source_key").withColumn("epochs", epochs).filter("epochs > 0")
    seen = seen.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)))
    seen = seen.withColumn("key", F.md5(F.concat_ws("|", F.lit(str(seed)), "epoch", F.coalesce(F.col("id").cast("string"), F.lit("null")))))
    seen = seen.withColumn("slice", F.substring("key", 1, SLICE_DIGITS))
    part = ["source_key", "epoch"]
    sums = seen.groupBy(*part, "slice").agg(F.sum("tokens").alias("n"))
    before = Window.partitionBy(*part).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*part, "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(*part, "slice").orderBy("key", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = seen.withColumn("inner", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(offsets, [*part, "slice"])
    start = F.col("epoch") * F.col("all_tokens") + F.col("offset") + F.col("inner")
    placed = placed.withColumn("start", start).filter("start < budget or all_tokens = 0")
    by_hash = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % blocks
    block = F.when(F.col("all_tokens") > 0, F.floor(F.col("start") / F.col("budget") * blocks)).otherwise(by_hash)
    placed = placed.withColumn("block", F.least(block, F.lit(blocks - 1)).cast("long"))
    rank = F.row_number().over(Window.partitionBy("block").orderBy("key", "source_key", "tokens")).cast("long")
    return placed.select("id", "source", "tokens", "epoch", "block", rank.alias("rank"), *more)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None, **options) -> DataFrame:
    """``mixture`` over documents; a document's tokens are its words."""
    named = {"row": row_col} if row_col else {}
    rows = picked(docs, id=id_col, text=text_col, source=source_col, **named)
    return mixture(rows.select("id", "source", count_words(whole_text("text")).alias("tokens"), *named), **options)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents of the mixture with all their columns, one row each time
    that one is seen.

    The input is written with a row number, by which decisions name rows even
    where ids repeat or are missing; which documents are seen again depends on
    their ids alone, not on the order of the rows.
    """
    number = free_name(docs, "mixture_row")
    numbered = written(docs.withColumn(number, F.monotonically_increasing_id()), "mix-input")
    order = mixed(numbered, id_col, text_col, source_col, number, **options)
    return numbered.join(order.select(F.col("row").alias(number)), number).select(*[F.col(f"`{c}`") for c in docs.columns])
