"""Report tables as JSON or CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.sources.corpus import CSV_OPTIONS


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_document(record: DataFrame, path: str) -> None:
    """A report of one record as one file that is not empty."""
    record.coalesce(1).write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def metrics_document(summary: DataFrame, per_class: DataFrame) -> DataFrame:
    """One nested record: the summary, each class, and the plain and weighted averages over classes."""
    scores = F.struct("precision", "recall", F.col("f1").alias("f1-score"), "support")
    support = F.sum("support")

    def averages(mean) -> Column:
        return F.struct(*[mean(c).alias(n) for c, n in (("precision", "precision"), ("recall", "recall"), ("f1", "f1-score"))], support.alias("support"))

    def weighted(c: str) -> Column:
        return F.try_divide(F.sum(F.col(c) * F.col("support")), support)

    classes = per_class.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("class"), scores)))).alias("per_class"),
        averages(F.avg).alias("macro avg"),
        averages(weighted).alias("weighted avg"),
    ).select(F.struct("per_class", "`macro avg`", "`weighted avg`").alias("found"))
    row = summary.select(F.struct("accuracy", "f1_macro").alias("summary"), "accuracy")
    row = row.withColumn("found", classes.scalar())
    return row.select("summary", "accuracy", "found.per_class", F.col("found")["macro avg"].alias("macro avg"), F.col("found")["weighted avg"].alias("weighted avg"))
