"""Rates over windows and alerts that must hold before they fire."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.functions.statistics import safe_ratio

REVIEW_LIMIT = 0.20
ERROR_LIMIT = 0.05
SCRAPE_HANDLER = "/metrics"


def window_rate(df: DataFrame, ts: str, flagged: Column, length: str, slide: str | None = None) -> DataFrame:
    """Rows, flagged rows and their ratio per window of event time.

    For sliding windows the rows are first counted per slide step, and only those
    counts are spread over the windows they belong to.
    """
    step = F.window(ts, slide or length)
    counts = df.groupBy(step.alias("window")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(flagged).alias("flagged")
    )
    if slide:
        spread = F.window(F.col("window.start"), length, slide)
        counts = counts.select(spread.alias("window"), "total", "flagged")
        counts = counts.groupBy("window").agg(F.sum("total").alias("total"), F.sum("flagged").alias("flagged"))
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "total",
        "flagged",
        safe_ratio(F.col("flagged"), F.col("total")).alias("rate"),
    )


def held_alerts(rates: DataFrame, limit: float, hold: str, step: str, alert: str = "alert") -> DataFrame:
    """Every evaluation of every alert with ``firing`` once the rate stayed high for ``hold``.

    Evaluations that are missing (no traffic) end a run, like a rate that is low.
    ``rates`` has one row per alert and evaluation time, so the window is bounded by
    time passed, not by traffic.
    """
    order = Window.partitionBy(alert).orderBy("window_end")
    high = F.coalesce(F.col("rate") > F.lit(limit), F.lit(False))
    gap = F.col("window_end") - F.lag("window_end").over(order) > F.expr(f"INTERVAL {step}")
    broken = F.coalesce(gap, F.lit(True)) | ~F.lag("high").over(order)
    marked = rates.withColumn("high", high)
    marked = marked.withColumn("_new", F.when(F.col("high") & broken, 1).otherwise(0))
    marked = marked.withColumn("_run", F.sum("_new").over(order))
    run = Window.partitionBy(alert, "high", "_run")
    held = F.col("window_end") - F.min("window_end").over(run) >= F.expr(f"INTERVAL {hold}")
    return marked.withColumn("firing", F.col("high") & held).drop("_new", "_run")
