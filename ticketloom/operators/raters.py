"""Agreement between raters.

Ratings (item, rater, queue) are turned once into one row per item with a column per
rater. All measures are sums over that row, so no pair of rows is ever formed and
nothing is collected per item: one shuffle by item, then global aggregates.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.statistics import safe_ratio


def rater_names(ratings: DataFrame) -> list[str]:
    """The raters in sorted order; they become columns."""
    return sorted(r["rater"] for r in ratings.select("rater").where("rater IS NOT NULL").distinct().collect())


def wide_ratings(ratings: DataFrame, raters: list[str]) -> DataFrame:
    """(item, one column per rater); a blank or missing rating is NULL."""
    queue = F.when(F.length("queue") > 0, F.col("queue"))
    columns = [F.max(F.when(F.col("rater") == r, queue)).alias(r) for r in raters]
    return ratings.groupBy("item").agg(*columns)


def complete(wide: DataFrame, raters: list[str]) -> DataFrame:
    return wide.na.drop(subset=raters)


def _long(wide: DataFrame, raters: list[str]) -> DataFrame:
    pairs = [F.struct(F.lit(r).alias("rater"), F.col(r).alias("queue")) for r in raters]
    return wide.select("item", F.inline(F.array(*pairs)))


def sheet_problems(items: DataFrame, ratings: DataFrame, raters: list[str], categories: list[str]) -> DataFrame:
    """Every missing rating and every unknown queue: (item, rater, problem)."""
    sheet = _long(items.select("item").join(wide_ratings(ratings, raters), "item", "left"), raters)
    problem = F.when(F.col("queue").isNull(), F.lit("missing")).when(
        ~F.col("queue").isin(categories), F.concat(F.lit("unknown queue "), F.col("queue"))
    )
    return sheet.select("item", "rater", problem.alias("problem")).where("problem IS NOT NULL")


def pair_agreement(wide: DataFrame, raters: list[str]) -> DataFrame:
    """(rater_a, rater_b, items, agree) from one global aggregate with a sum per pair."""
    pairs = list(combinations(raters, 2))
    sums = [F.count_if(F.col(a) == F.col(b)).alias(f"agree_{i}") for i, (a, b) in enumerate(pairs)]
    row = complete(wide, raters).agg(F.count(F.lit(1)).alias("items"), *sums)
    lines = [
        F.struct(F.lit(a).alias("rater_a"), F.lit(b).alias("rater_b"), F.col("items"), F.col(f"agree_{i}").alias("agree"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*lines)))


def cohen_kappa(wide: DataFrame, raters: list[str]) -> DataFrame:
    """Cohen's kappa per pair; NULL when chance agreement is 1."""
    pairs = list(combinations(raters, 2))
    counts = _long(complete(wide, raters), raters).groupBy("queue").pivot("rater", raters).agg(F.count(F.lit(1)))
    counts = counts.na.fill(0)
    sums = [F.sum(F.col(a) * F.col(b).cast("double")).alias(f"both_{i}") for i, (a, b) in enumerate(pairs)]
    lines = [
        F.struct(F.lit(a).alias("rater_a"), F.lit(b).alias("rater_b"), F.col(f"both_{i}").alias("both"))
        for i, (a, b) in enumerate(pairs)
    ]
    chance = counts.agg(*sums).select(F.inline(F.array(*lines)))
    joined = pair_agreement(wide, raters).join(chance, ["rater_a", "rater_b"])
    observed = safe_ratio(F.col("agree"), F.col("items"))
    expected = safe_ratio(F.col("both"), F.col("items").cast("double") * F.col("items"))
    return joined.select("rater_a", "rater_b", "items", safe_ratio(observed - expected, 1 - expected).alias("kappa"))


def _votes(raters: list[str], category: str) -> Column:
    return sum((F.when(F.col(r) == category, F.lit(1)).otherwise(F.lit(0)) for r in raters), F.lit(0))


def fleiss_kappa(wide: DataFrame, raters: list[str], categories: list[str]) -> DataFrame:
    """Fleiss' kappa over all raters, from one global aggregate."""
    r = float(len(raters))
    votes = [_votes(raters, c).cast("double") for c in categories]
    squares = sum((v * v for v in votes), F.lit(0.0))
    per_item = (squares - F.lit(r)) / F.lit(r * (r - 1))
    row = complete(wide, raters).agg(
        F.count(F.lit(1)).alias("items"),
        F.avg(per_item).alias("observed"),
        *[F.sum(v).alias(f"c_{i}") for i, v in enumerate(votes)],
    )
    share = [safe_ratio(F.col(f"c_{i}"), F.col("items") * F.lit(r)) for i in range(len(categories))]
    expected = sum((s * s for s in share), F.lit(0.0))
    return row.select("items", safe_ratio(F.col("observed") - expected, 1 - expected).alias("fleiss_kappa"))


def _disputed(raters: list[str]) -> Column:
    return F.size(F.array_distinct(F.array(*[F.col(r) for r in raters]))) > 1


def dispute_counts(wide: DataFrame, raters: list[str]) -> DataFrame:
    return complete(wide, raters).agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(~_disputed(raters)).alias("unanimous"),
        F.count_if(_disputed(raters)).alias("disputed"),
    )


def disputed_ratings(wide: DataFrame, raters: list[str]) -> DataFrame:
    """(item, rater, queue) of every item the raters do not agree on."""
    return _long(complete(wide, raters).where(_disputed(raters)), raters)


def majority_vote(wide: DataFrame, raters: list[str], author: str, categories: list[str]) -> DataFrame:
    """The commonest queue per item; any tie keeps the author's choice."""
    tally = F.array(*[F.struct(_votes(raters, c).alias("n"), F.lit(c).alias("queue")) for c in categories])
    most = F.array_max(F.transform(F.col("_tally"), lambda t: t["n"]))
    winners = F.filter(F.col("_tally"), lambda t: t["n"] == F.col("_most"))
    return (
        wide.withColumn("_tally", tally)
        .withColumn("_most", most)
        .withColumn("_winners", winners)
        .select(
            "item",
            F.when(F.size("_winners") == 1, F.element_at("_winners", 1)["queue"]).otherwise(F.col(author)).alias("queue"),
        )
    )
