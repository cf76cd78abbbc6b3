"""Scores from the confusion cells.

``confusion_cells`` is the only step that reads rows: one partial + final hash
aggregate, K*K cells whatever the row count. Everything else works on the cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.statistics import safe_ratio

OVERALL = "overall"


def confusion_cells(df: DataFrame, truth: str, predicted: str, by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def with_overall(cells: DataFrame, by: str) -> DataFrame:
    """Each cell once under its own slice and once under ``overall``."""
    both = F.explode(F.array(F.col(by).cast("string"), F.lit(OVERALL)))
    rest = [c for c in cells.columns if c != by]
    return cells.select(both.alias(by), *rest).groupBy(by, "truth", "predicted").agg(F.sum("n").alias("n"))


def class_scores(cells: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Precision, recall, F1 and support of every class seen as true or predicted."""
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(zero)
    as_truth = F.struct(
        F.col("truth").alias("class"), F.col("n").alias("support"), zero.alias("claimed"), hit.alias("hits")
    )
    as_prediction = F.struct(
        F.col("predicted").alias("class"), zero.alias("support"), F.col("n").alias("claimed"), zero.alias("hits")
    )
    sides = cells.select(*by, F.inline(F.array(as_truth, as_prediction)))
    sums = sides.groupBy(*by, "class").agg(
        F.sum("support").alias("support"), F.sum("claimed").alias("claimed"), F.sum("hits").alias("hits")
    )

    def or_zero(part: Column, whole: Column) -> Column:
        return F.coalesce(safe_ratio(part, whole), F.lit(0.0))

    return sums.select(
        *by,
        "class",
        or_zero(F.col("hits"), F.col("claimed")).alias("precision"),
        or_zero(F.col("hits"), F.col("support")).alias("recall"),
        or_zero(2 * F.col("hits"), F.col("support") + F.col("claimed")).alias("f1"),
        "support",
        "hits",
    )


def summary_scores(per_class: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Accuracy, macro and weighted averages over the classes of the selection."""
    weight = F.sum("support")

    def weighted(column: str) -> Column:
        return safe_ratio(F.sum(F.col(column) * F.col("support")), weight)

    return per_class.groupBy(*by).agg(
        weight.alias("rows"),
        safe_ratio(F.sum("hits"), weight).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        weighted("precision").alias("precision_weighted"),
        weighted("recall").alias("recall_weighted"),
        weighted("f1").alias("f1_weighted"),
    )


def score(df: DataFrame, truth: str, predicted: str, by: tuple[str, ...] = ()) -> DataFrame:
    return summary_scores(class_scores(confusion_cells(df, truth, predicted, by), by), by)


def class_domain(cells: DataFrame) -> DataFrame:
    """Classes that occur as true or as predicted."""
    return cells.select(F.explode(F.array("truth", "predicted")).alias("class")).distinct()


def confusion_matrix(cells: DataFrame, labels: list[str]) -> DataFrame:
    """Rows true, columns predicted, both over the given labels, zeros filled in."""
    wanted = F.array(*[F.lit(x) for x in labels])
    empty = cells.sparkSession.range(1).select(F.explode(wanted).alias("truth"))
    empty = empty.select("truth", F.col("truth").alias("predicted"), F.lit(0).cast("long").alias("n"))
    kept = cells.where(F.col("truth").isin(labels) & F.col("predicted").isin(labels))
    table = kept.select("truth", "predicted", "n").unionByName(empty)
    return table.groupBy("truth").pivot("predicted", labels).agg(F.sum("n")).na.fill(0)


def errors(
    df: DataFrame, truth: str, predicted: str, confidence: str, key: str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Misclassified rows; ``keep`` names extra columns, taken when the frame has them."""
    extra = [c for c in keep if c in df.columns]
    return df.where(F.col(truth) != F.col(predicted)).select(
        key,
        F.col(truth).alias("true_queue"),
        F.col(predicted).alias("predicted_queue"),
        F.round(confidence, 4).alias("confidence"),
        *extra,
    )


def least_confident(wrong: DataFrame, key: str, k: int | None = None) -> DataFrame:
    """The review list: all errors, the least confident first; with ``k`` only that many, without a full sort."""
    ordered = wrong.orderBy("confidence", key)
    return ordered if k is None else ordered.limit(k)


def majority_class(df: DataFrame, label: str) -> DataFrame:
    """One row: the commonest label (a tie goes to the smallest) and its share."""
    counts = df.groupBy(F.col(label).alias("majority_class")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.min_by("majority_class", F.struct(-F.col("n"), F.col("majority_class"))).alias("majority_class"),
        F.max("n").alias("n"),
        F.sum("n").alias("rows"),
    )


def class_shares(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total")).scalar()
    return counts.select("class", "n", safe_ratio(F.col("n"), total).alias("share"))


def error_profile(df: DataFrame, truth: str, predicted: str, confidence: str, sure: float = 0.9) -> DataFrame:
    """How many errors, how many of them confident, mean confidence right and wrong."""
    wrong = F.col(truth) != F.col(predicted)
    return df.agg(
        F.count_if(wrong).alias("errors"),
        F.count_if(wrong & (F.col(confidence) >= F.lit(sure))).alias("confident_errors"),
        F.avg(F.when(~wrong, F.col(confidence))).alias("mean_confidence_right"),
        F.avg(F.when(wrong, F.col(confidence))).alias("mean_confidence_wrong"),
    )


def leaderboard(scores: DataFrame, production: str, floor: str, clear_win: float = 0.01) -> DataFrame:
    """Best alternative to the production model and whether it wins clearly.

    ``scores`` has one row per model: (model, f1_macro).
    """
    alternative = ~F.col("model").isin(production, floor)
    rank = F.struct(F.col("f1_macro"), F.col("model"))
    best = scores.agg(
        F.max_by("model", F.when(alternative, rank)).alias("best_alternative"),
        F.max(F.when(alternative, F.col("f1_macro"))).alias("best_f1_macro"),
        F.max(F.when(F.col("model") == production, F.col("f1_macro"))).alias("production_f1_macro"),
    )
    margin = F.round(F.col("best_f1_macro") - F.col("production_f1_macro"), 4)
    return best.withColumn("margin", margin).withColumn("production_beaten", F.col("margin") > F.lit(clear_win))
