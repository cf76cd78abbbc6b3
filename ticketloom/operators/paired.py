"""Two models on the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.statistics import mcnemar_exact
from ticketloom.operators.calibration import N_BINS, expected_calibration_error
from ticketloom.operators.evaluation import class_scores, summary_scores


def pair_predictions(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """``a`` (key, y, a) with ``b`` (key, b) on the row key, one row per key.

    A key that one side lacks, or that a side has twice, raises. Both sides are grouped
    by the key they are joined on, which needs no further shuffle, and the check is a
    filter, so it stays whatever columns are read later.
    """

    def single(side: DataFrame, count: str) -> DataFrame:
        rest = [F.first(c).alias(c) for c in side.columns if c != key]
        return side.groupBy(key).agg(*rest, F.count(F.lit(1)).alias(count))

    joined = single(a, "_in_a").join(single(b, "_in_b"), key, "full_outer")
    once = F.coalesce((F.col("_in_a") == 1) & (F.col("_in_b") == 1), F.lit(False))
    problem = F.raise_error(F.concat(F.lit("row without one partner: "), F.coalesce(F.col(key).cast("string"), F.lit("NULL"))))
    return joined.where(F.when(once, F.lit(True)).otherwise(problem.cast("boolean"))).drop("_in_a", "_in_b")


def discordant_counts(df: DataFrame, a_right: Column, b_right: Column) -> DataFrame:
    """One row: rows only A gets right and rows only B gets right."""
    return df.agg(
        F.count_if(a_right & ~b_right).alias("only_a"),
        F.count_if(~a_right & b_right).alias("only_b"),
    )


def mcnemar(df: DataFrame, a_right: Column, b_right: Column) -> DataFrame:
    counts = discordant_counts(df, a_right, b_right)
    return counts.withColumn("p_value", mcnemar_exact(F.col("only_a"), F.col("only_b")))


def paired_profile(
    df: DataFrame, truth: str, a: str, b: str, confidence_a: str, confidence_b: str, n_bins: int = N_BINS
) -> DataFrame:
    """(truth, a, b, bin_a, bin_b, n, sum_a, sum_b): all that a comparison needs, in one pass over the rows.

    K * K * K groups and the bins, whatever the number of rows; kept as a table, scores,
    reliability and the paired test are read from it.
    """

    def place(confidence: str) -> Column:
        return F.least(F.floor(F.col(confidence) * F.lit(float(n_bins))), F.lit(n_bins - 1).cast("long"))

    return df.groupBy(
        F.col(truth).alias("truth"),
        F.col(a).alias("a"),
        F.col(b).alias("b"),
        place(confidence_a).alias("bin_a"),
        place(confidence_b).alias("bin_b"),
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(confidence_a).alias("sum_a"), F.sum(confidence_b).alias("sum_b"))


def profile_reliability(profile: DataFrame, side: str) -> DataFrame:
    """(bin, n, mean_confidence, accuracy) of side ``a`` or ``b``."""
    right = F.sum(F.when(F.col("truth") == F.col(side), F.col("n")).otherwise(F.lit(0)))
    n = F.sum("n")
    return profile.groupBy(F.col(f"bin_{side}").alias("bin")).agg(
        n.alias("n"), (F.sum(f"sum_{side}") / n).alias("mean_confidence"), (right / n).alias("accuracy")
    )


def profile_scores(profile: DataFrame) -> DataFrame:
    """One row: f1_a, f1_b, ece_a, ece_b, only_a, only_b, p_value."""
    a_right, b_right = F.col("truth") == F.col("a"), F.col("truth") == F.col("b")

    def total(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).cast("long")

    row = profile.agg(total(a_right & ~b_right).alias("only_a"), total(~a_right & b_right).alias("only_b"))
    row = row.withColumn("p_value", mcnemar_exact(F.col("only_a"), F.col("only_b")))
    for side in ("a", "b"):
        cells = profile.groupBy("truth", F.col(side).alias("predicted")).agg(F.sum("n").alias("n"))
        f1 = summary_scores(class_scores(cells)).select("f1_macro").scalar()
        ece = expected_calibration_error(profile_reliability(profile, side)).scalar()
        row = row.withColumn(f"f1_{side}", f1).withColumn(f"ece_{side}", ece)
    return row


def decision(
    comparison: DataFrame,
    min_gain: float = 0.01,
    max_p: float = 0.05,
    ece_slack: float = 0.02,
    p95_limit: float = 5.0,
) -> DataFrame:
    """Four conditions on a comparison row; the challenger must clear all of them.

    Columns: f1_challenger, f1_incumbent, p_value, ece_challenger, ece_incumbent, p95.
    An unknown (NULL) condition is not a pass.
    """
    gain = F.round(F.col("f1_challenger") - F.col("f1_incumbent"), 12) >= F.lit(min_gain)
    conditions = {
        "f1_ok": gain,
        "p_ok": F.col("p_value") < F.lit(max_p),
        "ece_ok": F.col("ece_challenger") <= F.col("ece_incumbent") + F.lit(ece_slack),
        "latency_ok": F.col("p95") <= F.lit(p95_limit),
    }
    out = comparison.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in conditions.items()})
    return out.withColumn("switch", F.col("f1_ok") & F.col("p_ok") & F.col("ece_ok") & F.col("latency_ok"))
