"""Folding fine labels onto coarse ones by a mapping table (intent, queue)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.session import settle


def fold(df: DataFrame, dim: DataFrame, fine: str, coarse: str) -> DataFrame:
    """Look ``fine`` up in the mapping; an unmapped label gives NULL.

    No broadcast hint: for a mapping kept as a table Catalyst sees the size, broadcasts
    the usual few KB, and shuffles one that outgrew the limit. ``settle`` a derived one.
    """
    return df.join(dim.select(F.col("intent").alias(fine), F.col("queue").alias(coarse)), fine, "left")


def unmapped(df: DataFrame, dim: DataFrame, fine: str) -> DataFrame:
    """Labels without a mapping and their row counts."""
    counts = df.groupBy(F.col(fine).alias("intent")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(dim.select("intent"), "intent", "left_anti")


def require_mapped(df: DataFrame, dim: DataFrame, fine: str) -> None:
    """Raise with the number of rows whose label the mapping does not know."""
    missing = unmapped(df, dim, fine).agg(F.sum("n").alias("n")).first()["n"]
    if missing:
        raise ValueError(f"{missing} rows have labels missing from the mapping")


def moved(before: DataFrame, after: DataFrame) -> DataFrame:
    """Labels whose queue differs between two mappings."""
    left = before.select("intent", F.col("queue").alias("queue_before"))
    right = after.select("intent", F.col("queue").alias("queue_after"))
    return left.join(right, "intent").where(F.col("queue_before") != F.col("queue_after"))


def relabel(df: DataFrame, mappings: DataFrame, versions: list[str], fine: str) -> DataFrame:
    """A queue column per mapping version, from (version, intent, queue), in one lookup."""
    wide = mappings.groupBy("intent").pivot("version", versions).agg(F.first("queue"))
    wide = wide.select(F.col("intent").alias(fine), *[F.col(v).alias(f"queue_{v}") for v in versions])
    return df.join(settle(wide, "mappings"), fine, "left")


def sibling_share(df: DataFrame, truth_fine: str, predicted_fine: str, truth: str, predicted: str) -> DataFrame:
    """Share of fine errors that disappear once both labels are folded."""
    wrong = df.where(F.col(truth_fine) != F.col(predicted_fine))
    same = (F.col(truth) == F.col(predicted)).cast("double")
    return wrong.agg(F.count(F.lit(1)).alias("fine_errors"), F.avg(same).alias("sibling_share"))
