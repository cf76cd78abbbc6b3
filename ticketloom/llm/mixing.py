"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.functions.hashing import uniform
from ticketloom.llm.common import n_words

WEIGHTS = (5, 2, 1)
MOST = 3


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    Sources by code point, null last, take the weights in turn and share the sum of
    all sizes by them. A target stops at ``most`` times its source's size and the
    excess is reshared by weight. The fixed point of that has a closed form: with
    sources in order of limit / weight, those up to some place stand at their
    limits, and the others share what is left. Both windows run over one row per
    source, never over documents. A source of size 0 has target 0.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1))
    rows = sizes.withColumn("weight", turn.cast("long")).withColumn("limit", F.col("source_size") * F.lit(most))
    by_limit = Window.orderBy((F.col("limit") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = rows.withColumns(
        {
            "place": F.row_number().over(by_limit),
            # what is left, and for which weights, when all sources before this one stand at their limits
            "left": F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)),
            "heads": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    # the first source whose share stays within its limit sets the share of all after it
    fits = F.col("limit") * F.col("heads") >= F.col("left") * F.col("weight")
    rows = rows.withColumn("at", F.min(F.when(fits, F.struct("place", "left", "heads"))).over(everything))
    free = F.col("at.left") * F.col("weight") / F.col("at.heads")
    target = F.least(F.col("limit").cast("double"), F.coalesce(free, F.col("limit").cast("double")))
    return rows.select("source", "source_size", F.round(target, 6).alias("target"))


def plan_mix(
    docs: DataFrame,
    size: Column | None = None,
    source: str = "source",
    key: str = "doc_id",
    seed: str = "mix",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    text: str = "text",
) -> DataFrame:
    """``docs`` with (size, source_size, target, rate, copies): how often each row is taken.

    A source's rate is target / source_size. A row is taken floor(rate) times, plus
    once more if the number hashed from seed and key is below the fraction, so reruns
    agree whatever the partitioning. Columns of these names are replaced.

    Null texts and blank texts have size 0; null sources are one source, last in
    order; a source of size 0 has rate 0, so its rows are not taken; rows with a null
    key share one hashed number, as repeated rows do; an empty table stays empty.
    """
    made = {"size", "source_size", "target", "rate", "copies"}
    rows = docs.drop(*[c for c in docs.columns if c.lower() in made]).withColumn(
        "size", n_words(F.col(text)) if size is None else size
    )
    sizes = rows.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"))
    per = targets(sizes, weights, most).withColumnRenamed("source", "__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    coin = uniform(seed, F.coalesce(F.col(key).cast("string"), F.lit("")))
    joined = rows.join(per, rows[source].eqNullSafe(per["__source"])).drop("__source").withColumn("rate", rate)
    extra = (coin < F.col("rate") - F.floor("rate")).cast("long")
    return joined.withColumn("copies", F.floor("rate") + extra)


def mix(docs: DataFrame, **options) -> DataFrame:
    """Every row as often as ``plan_mix`` says, with the columns of ``docs``."""
    planned = plan_mix(docs, **options).where(F.col("copies") > 0)
    taken = planned.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return taken.select(*docs.columns)
