"""Distribution distance and drift verdicts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.functions.statistics import safe_ratio, xlogx_ratio

LABEL_THRESHOLD = 0.1
TEXT_THRESHOLD = 0.55
MIN_SAMPLE_ROWS = 200
DRIFT_SHARE_THRESHOLD = 0.5


def label_shares(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., label, n, share); the window runs over the label counts, not the rows."""
    counts = df.groupBy(*by, F.col(label).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    if by:
        total = F.sum("n").over(Window.partitionBy(*by))
    else:
        total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.select(*by, "label", "n", safe_ratio(F.col("n"), total).alias("share"))


def align(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Both distributions over the union of their labels, 0 where one has none; NULL is a label."""
    ref = reference.select("label", F.col("share").alias("reference_share"))
    cur = current.select("label", F.col("share").alias("current_share"))
    cur = cur.withColumnRenamed("label", "_label")
    joined = ref.join(cur, F.col("label").eqNullSafe(F.col("_label")), "full_outer")
    joined = joined.withColumn("label", F.coalesce("label", "_label")).drop("_label")
    return joined.na.fill(0.0, ["reference_share", "current_share"])


def js_distance(reference: DataFrame, current: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Jensen-Shannon distance (natural log) of each current group from the reference.

    Only labels present in the group are joined: what the reference has beyond them
    adds ln(2)/2 times its share, so no group is filled up with absent labels. A ``by``
    column the reference has too (the name of a compared column) pairs the groups.
    """
    on = [c for c in by if c in reference.columns] + ["label"]
    ref = reference.select(*on, F.col("share").alias("p"))
    ref = ref.select("p", *[F.col(c).alias(f"_{c}") for c in on])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on]
    cur = current.select(*by, "label", "n", F.col("share").alias("q"))
    joined = cur.join(ref, same, "left").drop(*[f"_{c}" for c in on]).na.fill(0.0, ["p"])
    p, q = F.col("p"), F.col("q")
    middle = (p + q) / 2
    terms = (xlogx_ratio(p, middle) + xlogx_ratio(q, middle)) / 2
    divergence = F.sum(terms) + F.lit(math.log(2) / 2) * (F.lit(1.0) - F.sum(p))
    return joined.groupBy(*by).agg(
        F.sum("n").alias("rows"), F.sqrt(F.greatest(divergence, F.lit(0.0))).alias("distance")
    )


def column_scores(
    reference: DataFrame, current: DataFrame, columns: dict[str, Column], threshold: float = LABEL_THRESHOLD
) -> DataFrame:
    """(column, score, threshold, rows) of several columns; each side is read once."""
    values = F.inline(
        F.array(*[F.struct(F.lit(n).alias("column"), c.cast("string").alias("value")) for n, c in columns.items()])
    )
    sides = [label_shares(side.select(values), "value", ("column",)) for side in (reference, current)]
    distance = js_distance(*sides, ("column",))
    return distance.select("column", F.col("distance").alias("score"), F.lit(threshold).alias("threshold"), "rows")


def _verdict(score: Column, limit: Column, sufficient: Column) -> Column:
    """True or False on a large enough sample; NULL (unknown) on a thin one or without a score."""
    return F.when(sufficient, score > limit)


def column_verdicts(scores: DataFrame, min_rows: int = MIN_SAMPLE_ROWS) -> DataFrame:
    """(column, score, threshold, rows) with ``drifted`` per column."""
    sufficient = F.col("rows") >= F.lit(min_rows)
    return scores.withColumn("drifted", _verdict(F.col("score"), F.col("threshold"), sufficient))


def window_verdicts(windows: DataFrame, threshold: float = LABEL_THRESHOLD, min_rows: int = MIN_SAMPLE_ROWS) -> DataFrame:
    """``windows`` (rows, distance, ...) with ``status`` and ``drifted``, row by row: also for streams."""
    sufficient = F.col("rows") >= F.lit(min_rows)
    status = F.when(sufficient, F.lit("ok")).otherwise(F.lit("insufficient_data"))
    return windows.withColumn("status", status).withColumn("drifted", _verdict(F.col("distance"), F.lit(threshold), sufficient))


def drift_summary(
    scores: DataFrame, min_rows: int = MIN_SAMPLE_ROWS, by: tuple[str, ...] = ()
) -> DataFrame:
    """The alerting row: columns checked and over their limit, share, status, verdict."""
    over = scores.groupBy(*by).agg(
        F.count(F.lit(1)).alias("columns_checked"),
        F.count_if(F.col("score") > F.col("threshold")).alias("columns_drifted"),
        F.max("rows").alias("current_rows"),
    )
    sufficient = F.col("current_rows") >= F.lit(min_rows)
    share = safe_ratio(F.col("columns_drifted"), F.col("columns_checked"), 4)
    return (
        over.withColumn("drift_share", share)
        .withColumn("sufficient_sample", sufficient)
        .withColumn("status", F.when(sufficient, F.lit("ok")).otherwise(F.lit("insufficient_data")))
        .withColumn("dataset_drifted", _verdict(F.col("drift_share"), F.lit(DRIFT_SHARE_THRESHOLD), sufficient))
    )
