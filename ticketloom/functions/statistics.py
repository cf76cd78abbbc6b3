"""Closed-form statistics on one-row summaries."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(part: Column, whole: Column, digits: int | None = None) -> Column:
    """part / whole, and NULL (unknown, not 0) for an empty whole."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double"))
    return ratio if digits is None else F.round(ratio, digits)


def log_factorial(x: Column) -> Column:
    """ln(x!) by Stirling's series at x + 9, shifted back by the first eight factors."""
    z = x.cast("double") + F.lit(9.0)
    series = (
        (z - 0.5) * F.ln(z)
        - z
        + F.lit(0.5 * math.log(2 * math.pi))
        + 1 / (12 * z)
        - 1 / (360 * F.pow(z, F.lit(3)))
        + 1 / (1260 * F.pow(z, F.lit(5)))
        - 1 / (1680 * F.pow(z, F.lit(7)))
        + 1 / (1188 * F.pow(z, F.lit(9)))
    )
    factors = F.lit(1.0)
    for k in range(1, 9):
        factors = factors * (x.cast("double") + F.lit(float(k)))
    return series - F.ln(factors)


def mcnemar_exact(only_a: Column, only_b: Column) -> Column:
    """Two-sided exact binomial p-value of the discordant counts; no discordance gives 1.

    The lower tail is summed downwards from its largest term by the ratio of
    neighbouring terms. Terms more than 12 standard deviations (and 60 steps) below
    the largest are under 1e-30 of it, so the sum has O(sqrt(n)) terms, not n.
    """
    n = only_a + only_b
    k = F.least(only_a, only_b)
    log_top = log_factorial(n) - log_factorial(k) - log_factorial(n - k) - n * F.lit(math.log(2.0))
    reach = F.least(k, F.ceil(F.sqrt(n.cast("double")) * 12) + F.lit(60)).cast("long")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(acc: Column, j: Column) -> Column:
        # from C(n, i) to C(n, i - 1) with i = k - j + 1
        i = (k - j + F.lit(1)).cast("double")
        term = acc["term"] * i / (n.cast("double") - i + F.lit(1.0))
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    steps = F.when(reach >= 1, F.sequence(F.lit(1).cast("long"), reach)).otherwise(
        F.array().cast("array<bigint>")
    )
    tail = F.aggregate(steps, start, step, lambda acc: acc["total"])
    return F.when(n == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), 2 * F.exp(log_top) * tail))


def xlogx_ratio(x: Column, m: Column) -> Column:
    """x ln(x / m) with 0 ln 0 = 0."""
    return F.when(x > 0, x * F.ln(x / m)).otherwise(F.lit(0.0))
