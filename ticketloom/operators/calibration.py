"""Coverage against accuracy, reliability bins, expected calibration error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.statistics import safe_ratio

# 0.30 to 0.95 in steps of 0.05.
COVERAGE_THRESHOLDS = (
    0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95,
)
N_BINS = 10


def threshold_counts(
    df: DataFrame, confidence: Column, correct: Column, thresholds: tuple[float, ...] = COVERAGE_THRESHOLDS
) -> DataFrame:
    """Rows at or above each threshold, and how many of them are right.

    One pass and one global aggregate: rows are never multiplied by thresholds.
    """
    counts = [F.count(F.lit(1)).alias("n")]
    for i, t in enumerate(thresholds):
        routed = confidence >= F.lit(float(t))
        counts.append(F.count_if(routed).alias(f"routed_{i}"))
        counts.append(F.count_if(routed & correct).alias(f"right_{i}"))
    lines = [
        F.struct(
            F.lit(float(t)).alias("threshold"), F.col(f"routed_{i}").alias("routed"), F.col(f"right_{i}").alias("right")
        )
        for i, t in enumerate(thresholds)
    ]
    return df.agg(*counts).select("n", F.inline(F.array(*lines)))


def coverage_table(counts: DataFrame) -> DataFrame:
    """Share routed, accuracy on exactly those rows (NULL when there are none), rest."""
    return counts.select(
        "threshold",
        safe_ratio(F.col("routed"), F.col("n"), 4).alias("coverage"),
        safe_ratio(F.col("right"), F.col("routed"), 4).alias("accuracy"),
        (F.col("n") - F.col("routed")).alias("to_review"),
        (F.col("routed") - F.col("right")).alias("wrong_routes"),
    )


def reliability_table(
    df: DataFrame, confidence: Column, correct: Column, n_bins: int = N_BINS, by: tuple[str, ...] = ()
) -> DataFrame:
    """Equal-width bins of confidence; edges belong to the upper bin, 1.0 to the last."""
    index = F.least(F.floor(confidence * F.lit(float(n_bins))), F.lit(n_bins - 1).cast("long"))
    binned = df.select(*by, index.alias("bin"), confidence.alias("confidence"), correct.cast("double").alias("correct"))
    sums = binned.groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("mean_confidence"), F.avg("correct").alias("accuracy")
    )
    width = F.lit(float(n_bins))
    return sums.select(
        *by,
        (F.col("bin") / width).alias("bin_low"),
        ((F.col("bin") + 1) / width).alias("bin_high"),
        "n",
        "mean_confidence",
        "accuracy",
    )


def expected_calibration_error(table: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Count-weighted mean gap between accuracy and confidence over the bins."""
    gap = F.abs(F.col("accuracy") - F.col("mean_confidence"))
    return table.groupBy(*by).agg(safe_ratio(F.sum(F.col("n") * gap), F.sum("n")).alias("ece"))
