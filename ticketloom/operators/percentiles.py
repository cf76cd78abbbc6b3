"""Exact percentiles of a numeric column, overall or by group, in two scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.session import settle

#: A sketch places a value to one rank in so many. Groups of no more rows are ranked whole.
ACCURACY = 100_000
#: Ranks on either side of a wanted one, in parts of ACCURACY, that are looked at: the error of the
#: sketch, and what (n - 1) p and n p differ by.
SLACK = 3


def grouped_percentiles(
    df: DataFrame,
    column: str,
    by: tuple[str, ...] = (),
    probabilities: tuple[float, ...] = (0.5, 0.95, 0.99),
    accuracy: int = ACCURACY,
) -> DataFrame:
    """(by, n, mean, p...) with the exact percentiles of each group, linearly interpolated.

    The first scan makes one mergeable sketch per group, which bounds each wanted value from
    both sides. The second counts what lies below the bounds and ranks only what lies
    between, some hundred-thousandths of a group, equal values as one. So no group is sorted,
    there is no loop, and the plan is the same for all sizes.

    NULL and NaN are no measurements: a group of nothing else has n = 0 and NULLs. NULL
    is a group like any other. An empty input has no groups; without ``by`` it is one row with n = 0.
    """
    x = F.col(column).cast("double")
    known = [F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]
    groups = [f"_g{i}" for i in range(len(by))]
    values = df.select(*known, F.when(~F.isnan(x), x).alias("x"))
    around = [min(1.0, max(0.0, p + side * SLACK / accuracy)) for p in probabilities for side in (-1, 1)]
    sketch = values.groupBy(*groups).agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.approx_percentile("x", around, accuracy).alias("cuts")
    )
    sketch = settle(sketch, "sketch")
    few = F.col("n") <= accuracy
    wanted = []
    for i, p in enumerate(probabilities):
        low = F.when(few | F.lit(p * accuracy <= SLACK), F.lit(float("-inf"))).otherwise(F.get("cuts", F.lit(2 * i)))
        high = F.when(few | F.lit((1 - p) * accuracy <= SLACK), F.lit(float("inf"))).otherwise(F.get("cuts", F.lit(2 * i + 1)))
        spot = F.lit(p) * (F.col("n") - 1)
        wanted.append(F.struct(F.lit(i).alias("which"), spot.alias("spot"), low.alias("low"), high.alias("high")))
    brackets = sketch.where("n > 0").select(*groups, F.inline(F.array(*wanted)))
    same = [F.col(f"v.{g}").eqNullSafe(F.col(f"b.{g}")) for g in groups]
    pairs = values.where("x IS NOT NULL").alias("v")
    pairs = pairs.join(brackets.alias("b"), same) if groups else pairs.crossJoin(F.broadcast(brackets.alias("b")))
    # one row per value inside, and one for all below; what lies above is of no use
    inside = F.when(F.col("x") >= F.col("low"), F.col("x"))
    counted = (
        pairs.where(F.col("x") <= F.col("high"))
        .select(*[F.col(f"v.{g}").alias(g) for g in groups], "which", "spot", inside.alias("x"))
        .groupBy(*groups, "which", "spot", "x")
        .agg(F.count(F.lit(1)).alias("here"))
    )
    upto = F.sum("here").over(Window.partitionBy(*groups, "which").orderBy(F.asc_nulls_first("x")))
    ranked = counted.withColumn("upto", upto)
    first = F.floor("spot")
    at = lambda rank: F.min(F.when(F.col("upto") > rank, F.col("x")))
    found = ranked.groupBy(*groups, "which", "spot").agg(at(first).alias("a"), at(first + 1).alias("b"))
    share = F.col("spot") - first
    value = F.when(share == 0, F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * share)
    names = [f"p{round(100 * p)}" for p in probabilities]
    columns = [F.max(F.when(F.col("which") == i, F.col("value"))).alias(name) for i, name in enumerate(names)]
    per = found.withColumn("value", value).groupBy(*groups).agg(*columns)
    same = [F.col(f"s.{g}").eqNullSafe(F.col(f"q.{g}")) for g in groups]
    joined = sketch.alias("s").join(per.alias("q"), same or F.lit(True), "left")
    return joined.select(*[F.col(f"s.{g}").alias(c) for g, c in zip(groups, by, strict=True)], "n", "mean", *names)


def latency_summary(
    df: DataFrame, column: str, probabilities: tuple[float, ...] = (0.5, 0.95, 0.99)
) -> DataFrame:
    """One row: n, mean and the exact percentiles with linear interpolation; n = 0 and NULLs of an empty input."""
    return grouped_percentiles(df, column, (), probabilities)
