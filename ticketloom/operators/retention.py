"""Keeping the newest days of a log within a size budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.session import settle


def retained_days(df: DataFrame, day: Column, line: Column, budget: int, log: Column | None = None) -> DataFrame:
    """(log, day, bytes) of the days kept: newest first, until the budget is used up.

    A day is kept when the newer days alone are still under budget. The running sum
    is over one row per log and day.
    """
    name = log if log is not None else F.lit("predictions")
    sizes = df.groupBy(name.alias("log"), day.alias("day")).agg(F.sum(F.octet_length(line) + 1).alias("bytes"))
    return within_budget(sizes, budget)


def within_budget(sizes: DataFrame, budget: int) -> DataFrame:
    """The rows of (log, day, bytes) whose newer days of the same log are still under budget."""
    newer = Window.partitionBy("log").orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum("bytes").over(newer), F.lit(0))
    return sizes.withColumn("_used", used).where(F.col("_used") < budget).drop("_used")


def retain(df: DataFrame, day: Column, line: Column, budget: int) -> DataFrame:
    """The rows of the kept days."""
    kept = settle(retained_days(df, day, line, budget).select(F.col("day").alias("_day")), "kept-days")
    return df.join(kept, day == F.col("_day"), "left_semi")
