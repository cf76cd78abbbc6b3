"""Model versions: promotion gate and pointers, as queries over a version table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def promotion_replay(
    versions: DataFrame, model: str = "model", order: str = "version", metric: str = "f1_macro", source: str = "data_source"
) -> DataFrame:
    """Which versions the gate would have promoted, and the incumbent each one met.

    A version takes over when nothing is in production, when the incumbent came from
    another corpus, or when it is strictly better. The incumbent's corpus is always
    that of the row before, so a run of equal corpora is a segment, and within it the
    incumbent holds the best metric so far. The windows hold one model's versions.
    """
    history = Window.partitionBy(model).orderBy(order)
    starts = F.lag(source).over(history).eqNullSafe(F.col(source))
    marked = versions.withColumn("_start", F.when(starts & (F.row_number().over(history) > 1), 0).otherwise(1))
    marked = marked.withColumn("segment", F.sum("_start").over(history).cast("long"))
    before = (
        Window.partitionBy(model, "segment").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    incumbent = F.max(metric).over(before)
    out = marked.withColumn("incumbent_metric", incumbent)
    promoted = F.col("incumbent_metric").isNull() | (F.col(metric) > F.col("incumbent_metric"))
    return out.withColumn("promoted", promoted).drop("_start")


def production_version(replay: DataFrame, model: str = "model", order: str = "version") -> DataFrame:
    """The version the alias points at: the last one promoted."""
    return replay.where("promoted").groupBy(model).agg(F.max(order).alias("production_version"))


def latest_version(versions: DataFrame, model: str = "model", order: str = "version") -> DataFrame:
    """The numerically highest version per model, also when versions are text."""
    number = F.col(order).cast("long")
    return versions.groupBy(model).agg(
        F.max(number).alias("latest_version"), F.max_by("f1_macro", number).alias("f1_macro")
    )
