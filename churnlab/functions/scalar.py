"""Scalar helpers: ordered CASE buckets, safe ratios, stable hash buckets."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucketize(
    value: Column,
    rules: Sequence[tuple[str, float | None, float | None]],
    default: str | None = None,
) -> Column:
    """Searched CASE over closed ranges, first match wins.

    ``rules`` holds ``(label, lo, hi)``; a missing bound is open. Values that
    match no rule get ``default`` (null when none, like CASE without ELSE).
    """
    expr = None
    for label, lo, hi in rules:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (value >= F.lit(lo))
        if hi is not None:
            cond = cond & (value <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default).cast("string"))


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; null when den is 0 or null (ANSI-safe)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def hash_value(key: Column) -> Column:
    """The first 32 bits of md5(key) as a bigint.

    Same value in any SQL engine with md5 and hex parsing, so assignment by it
    is reproducible and checkable (replaces seeded random sampling).
    """
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """Stable bucket in [0, buckets) of a key (see ``hash_value``)."""
    return (hash_value(key) % F.lit(buckets)).cast("int")


#: Terms of the series for the normal distribution: enough for |z| < 8.
NORMAL_TERMS = 160


def two_sided_p(z: Column) -> Column:
    """Probability that a standard normal value is at least as far from 0 as ``z``.

    1 - 2 * density(z) * (z + z^3/3 + z^5/(3*5) + ...), Marsaglia's series (2004);
    0 from |z| = 8 on, where the probability is under 1.3e-15. The absolute error is
    under 1e-12. Null for a null z.
    """
    x = F.abs(z.cast("double"))
    start = F.struct(x.alias("sum"), x.alias("term"))

    def add(acc: Column, k: Column) -> Column:
        term = acc["term"] * x * x / (F.lit(2.0) * k + 1)
        return F.struct((acc["sum"] + term).alias("sum"), term.alias("term"))

    total = F.aggregate(F.sequence(F.lit(1), F.lit(NORMAL_TERMS)), start, add, lambda acc: acc["sum"])
    density = F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    return F.when(x >= 8, F.lit(0.0)).when(x < 8, F.greatest(F.lit(0.0), 1 - 2 * density * total))
