"""Seeded samples and splits, exact, without sorting a stratum in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.functions.hashing import uniform
from ticketloom.session import settle

BUCKETS = 65536


def cut_points(
    df: DataFrame, stratum: str, key: str, seed: int, quota: Callable[[Column], Column], buckets: int = BUCKETS
) -> DataFrame:
    """Per stratum, the (u, key) of the quota-th smallest seeded number.

    Counts per (stratum, bucket of u) find the bucket that holds the cut; only the keys
    of that bucket, 1/buckets of the stratum, are put in order. Copies that share a key
    are counted before that, so a key with any number of rows is one line. ``_take`` is
    how many of the rows with the cut's own key are within the quota.
    """
    u = uniform(seed, key)
    tagged = df.select(F.col(stratum).alias("_s"), F.col(key).alias("_key"), u.alias("_u"))
    tagged = tagged.withColumn("_bucket", F.floor(F.col("_u") * F.lit(float(buckets))))
    counts = tagged.groupBy("_s", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    stratum_window = Window.partitionBy("_s")
    upto = F.sum("_n").over(stratum_window.orderBy("_bucket"))
    cumulative = counts.withColumn("_upto", upto).withColumn("_quota", quota(F.sum("_n").over(stratum_window)).cast("long"))
    holds = (F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_n") < F.col("_quota"))
    edge = cumulative.where(holds).select(
        "_s", "_bucket", (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_need")
    )
    held = settle(edge.withColumnsRenamed({"_s": "_es", "_bucket": "_eb"}), "edge")
    inside = tagged.join(held, F.col("_s").eqNullSafe(F.col("_es")) & (F.col("_bucket") == F.col("_eb")))
    keys = inside.groupBy("_s", "_u", "_key", "_need").agg(F.count(F.lit(1)).alias("_copies"))
    before = F.sum("_copies").over(stratum_window.orderBy("_u", "_key")) - F.col("_copies")
    take = F.col("_need") - F.col("_before")
    found = keys.withColumn("_before", before).where((take > 0) & (take <= F.col("_copies")))
    return settle(found.select("_s", F.struct("_u", "_key").alias("_cut"), take.alias("_take")), "cut")


def _sided(df: DataFrame, cuts: DataFrame, stratum: str, key: str, seed: int) -> DataFrame:
    mine = F.struct(uniform(seed, key).alias("_u"), F.col(key).alias("_key"))
    joined = df.join(cuts.drop("_take"), F.col(stratum).eqNullSafe(F.col("_s")), "left")
    side = F.when(mine < F.col("_cut"), F.lit(-1)).when(mine == F.col("_cut"), F.lit(0)).otherwise(F.lit(1))
    return joined.withColumn("_side", side).drop("_s", "_cut")


def stratified_split(
    df: DataFrame, label: str, key: str, test_size: float, seed: int = 42, buckets: int = BUCKETS
) -> DataFrame:
    """Adds ``split``: per label exactly round(n * test_size) rows are test.

    Copies that share a key stay together, so they never leak from test into train. A row's side depends on its own key and its label's cut, so renaming a label or
    repartitioning moves nothing.
    """
    cuts = cut_points(df, label, key, seed, lambda n: F.floor(n * F.lit(test_size) + F.lit(0.5)), buckets)
    sided = _sided(df, cuts, label, key, seed)
    return sided.withColumn("split", F.when(F.col("_side") <= 0, F.lit("test")).otherwise(F.lit("train"))).drop("_side")


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42, buckets: int = BUCKETS) -> DataFrame:
    """Exactly n rows (or all) without replacement: those with the smallest numbers.

    When only some copies of the last key fit, any of them are taken.
    """
    whole = df.withColumn("_all", F.lit(1))
    cuts = cut_points(whole, "_all", key, seed, lambda total: F.least(total, F.lit(n).cast("long")), buckets)
    last = cuts.first()
    if last is None:
        return df.limit(0)
    mine = F.struct(uniform(seed, key).alias("_u"), F.col(key).alias("_key"))
    cut = F.struct(F.lit(last["_cut"]["_u"]).alias("_u"), F.lit(last["_cut"]["_key"]).alias("_key"))
    return df.where(mine < cut).unionByName(df.where(mine == cut).limit(last["_take"]))


def shuffle_rows(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Spread rows by their seeded number, in that order within each partition."""
    shuffled = df.withColumn("_u", uniform(seed, key)).repartition("_u")
    return shuffled.sortWithinPartitions("_u", key).drop("_u")


def picks_per_group(df: DataFrame, group: str, key: str, seed: int = 42, k: int = 3) -> DataFrame:
    """(group, key, _rn): k seeded keys per group.

    ``row_number() <= k`` is pushed below the shuffle as a window group limit, so at
    most k keys per group leave a partition, however large the group is.
    """
    order = Window.partitionBy(group).orderBy(uniform(seed, key), F.col(key))
    return df.select(group, key).withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= k)


def annotation_sheet(df: DataFrame, intent: str, text: str, key: str, seed: int = 42, k: int = 3) -> DataFrame:
    """One row per intent with k seeded example texts and a blank queue to fill in.

    Only keys are ranked; the few picked ones then fetch their texts, so no text is
    sorted or shuffled that does not end up on the sheet.
    """
    picks = settle(picks_per_group(df, intent, key, seed, k), "picks")
    picked = df.select(intent, key, text).join(picks, [intent, key])
    sheet = picked.groupBy(intent).pivot("_rn", list(range(1, k + 1))).agg(F.first(text))
    names = [F.col(str(i)).alias(f"example_{i}") for i in range(1, k + 1)]
    return sheet.select(F.col(intent).alias("intent"), *names, F.lit("").alias("queue"))


def by_name(df: DataFrame, column: str) -> DataFrame:
    """Case-insensitive order with the exact text as the tie-break."""
    return df.orderBy(F.lower(column), column)
