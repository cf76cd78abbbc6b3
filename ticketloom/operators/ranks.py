"""Rank sums: how well a score tells two sides apart (Mann and Whitney, 1947)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.session import settle

#: Parts that the different scores of a group are cut into, each ranked by a task of its own.
PARTS = 256


def rank_auc(df: DataFrame, score: str, positive: Column, by: tuple[str, ...] = (), parts: int = PARTS) -> DataFrame:
    """(by, positives, negatives, auc, z) per group: the chance that a positive outscores a negative, ties half.

    Exact. Rows become counts per different score, and no group's scores are sorted in one
    task: quantiles of the different scores cut them into parts, a part's ranks start at the
    sum of the parts below. ``z`` is the distance from 0.5 in standard deviations of two equal
    sides, corrected for ties. A null score or side takes no part; without rows of both sides
    ``auc`` and ``z`` are null, as ``z`` is where all scores are equal. No rows, no groups.
    """
    rows = df.select(*by, F.col(score).cast("double").alias("_score"), positive.cast("boolean").alias("_positive"))
    rows = rows.where(F.col("_score").isNotNull() & F.col("_positive").isNotNull())
    # -0.0 and 0.0 are one score; the table is read for the cuts and for the ranks
    counts = rows.groupBy(*by, (F.col("_score") + F.lit(0.0)).alias("_score")).agg(
        F.count_if("_positive").alias("_pos"), F.count_if(~F.col("_positive")).alias("_neg")
    )
    counts = settle(counts, "score-counts")
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    cuts = counts.groupBy(*by).agg(F.percentile_approx("_score", shares).alias("_cuts"))
    if by:
        named = cuts.select("_cuts", *[F.col(c).alias(f"_by_{c}") for c in by])
        joined = counts.join(named, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by])
    else:
        joined = counts.withColumn("_cuts", cuts.scalar())
    # one part has no cuts
    part = F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col("_score"))), F.lit(0))
    placed = joined.select(*by, "_score", "_pos", "_neg", part.alias("_part"))

    sums = placed.groupBy(*by, "_part").agg(F.sum("_neg").alias("_part_neg"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("_part").alias("_of"), F.coalesce(F.sum("_part_neg").over(earlier), F.lit(0)).alias("_start"), *[F.col(c).alias(f"_by_{c}") for c in by]
    )
    same = F.col("_part") == F.col("_of")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    lower = Window.partitionBy(*by, "_part").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    within = placed.withColumn("_lower", F.coalesce(F.sum("_neg").over(lower), F.lit(0)))
    # doubles: pairs and cubes of counts pass a long long before counts do
    below = (F.col("_start") + F.col("_lower")).cast("double")
    pos, neg = F.col("_pos").cast("double"), F.col("_neg").cast("double")
    tied = pos + neg
    sums = within.join(starts, same).groupBy(*by).agg(
        F.sum("_pos").alias("positives"),
        F.sum("_neg").alias("negatives"),
        F.sum(pos * (below + neg / 2)).alias("_won"),
        F.sum(tied * tied * tied - tied).alias("_ties"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    n = (F.col("positives") + F.col("negatives")).cast("double")
    spread = pairs / 12 * (n + 1 - F.col("_ties") / (n * (n - 1)))
    known = pairs > 0
    return sums.select(
        *by,
        "positives",
        "negatives",
        F.when(known, F.col("_won") / pairs).alias("auc"),
        F.when(known & (spread > 0), (F.col("_won") - pairs / 2) / F.sqrt(F.greatest(spread, F.lit(0.0)))).alias("z"),
    )
