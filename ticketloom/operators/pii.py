"""How much personal data the redaction catches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.statistics import safe_ratio
from ticketloom.functions.text import redact

CLEAN_KIND = "none"


def pii_values(cases: DataFrame) -> DataFrame:
    """One row per value of the ``|``-separated list: (kind, value, caught)."""
    redacted = cases.where(F.col("kind") != CLEAN_KIND).select("kind", "pii", redact(F.col("text")).alias("_out"))
    values = redacted.select("kind", "_out", F.explode(F.split("pii", r"[|]")).alias("value"))
    caught = ~F.contains(F.lower("_out"), F.lower("value"))
    return values.select("kind", "value", caught.alias("caught"))


def recall_by_kind(cases: DataFrame) -> DataFrame:
    """Recall per kind and overall (kind ``overall``), from one aggregate over both."""
    both = pii_values(cases).select(F.explode(F.array(F.col("kind"), F.lit("overall"))).alias("kind"), "caught")
    return both.groupBy("kind").agg(
        F.count(F.lit(1)).alias("pii_values"),
        safe_ratio(F.count_if("caught"), F.count(F.lit(1)), 4).alias("recall"),
    )


def untouched_share(cases: DataFrame) -> DataFrame:
    """How many messages without personal data come out unchanged."""
    clean = cases.where(F.col("kind") == CLEAN_KIND)
    same = redact(F.col("text")) == F.col("text")
    return clean.agg(
        F.count(F.lit(1)).alias("pii_free_messages"),
        safe_ratio(F.count_if(same), F.count(F.lit(1)), 4).alias("untouched"),
    )
