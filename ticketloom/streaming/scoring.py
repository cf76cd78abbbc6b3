"""Scoring and routing a message stream, and the redacted prediction log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.scores import REVIEW_THRESHOLD, route, score_map
from ticketloom.functions.text import admission_reason, clean_text, redact
from ticketloom.operators.classifiers import TextModel


def score_and_route(
    messages: DataFrame, model: TextModel, text: str = "text", threshold: float = REVIEW_THRESHOLD
) -> DataFrame:
    """Works on a batch or a stream: clean, score once, route.

    Refused messages keep their reason and their text, redacted, and get no label;
    ``status`` splits the sink.
    """
    tagged = messages.withColumn("reason", admission_reason(F.col(text)))
    tagged = tagged.withColumn("_raw", F.col(text))
    tagged = tagged.withColumn(text, F.when(F.col("reason").isNull(), clean_text(F.col(text))).otherwise(F.lit("")))
    scored = model.predict(tagged)
    scored = scored.withColumn(text, F.when(F.col("reason").isNull(), F.col(text)).otherwise(redact(F.col("_raw")))).drop("_raw")
    accepted = F.col("reason").isNull()
    classes = F.array(*[F.lit(c) for c in model.head.classes])
    return (
        scored.withColumn("status", F.when(accepted, F.lit("accepted")).otherwise(F.lit("quarantined")))
        .withColumn("all_scores", F.when(accepted, score_map(classes, F.col("scores"))))
        .withColumn("predicted_label", F.when(accepted, F.col("predicted_label")))
        .withColumn("confidence", F.when(accepted, F.col("confidence")))
        .withColumn("label", F.when(accepted, route(F.col("predicted_label"), F.col("confidence"), threshold)))
        .drop("scores")
    )


def log_records(scored: DataFrame, ts: str = "ts", text: str = "text", redacted: bool = True) -> DataFrame:
    """What the log keeps: the model's own label and the redacted text, with its day."""
    shown = redact(F.col(text)) if redacted else F.col(text)
    return scored.where(F.col("status") == "accepted").select(
        F.col(ts).alias("ts"),
        shown.alias("text"),
        F.col("predicted_label").alias("label"),
        F.date_format(ts, "yyyy-MM-dd").alias("dt"),
    )
