"""Bootstrap intervals for macro F1."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.operators.evaluation import class_scores, confusion_cells, summary_scores


def bootstrap_f1(cells: DataFrame, n_resamples: int = 1000, seed: int = 42) -> DataFrame:
    """Macro F1 of every resample: (replicate, f1_macro).

    Resampling n rows with replacement makes the cell counts multinomial with the
    observed shares, so each replicate is drawn from the K*K cells and the rows are
    read once, not once per replicate. Each replicate is a group of its own that holds
    the cells, so the replicates run in parallel and nothing comes to the driver; a
    replicate's draw depends on (seed, replicate) and the cells only.
    """
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_resamples - 1).cast("long")))
    named = cells.select(F.col("truth").cast("string"), F.col("predicted").cast("string"), F.col("n").cast("long"))

    def draw(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.fillna("").sort_values(["truth", "predicted"])
        names, place = np.unique(np.concatenate([group["truth"], group["predicted"]]), return_inverse=True)
        truth, predicted = np.split(place, 2)
        total = int(group["n"].sum())
        rng = np.random.default_rng([seed, int(key[0])])
        sample = rng.multinomial(total, group["n"].to_numpy() / total)
        support = np.bincount(truth, weights=sample, minlength=len(names))
        claimed = np.bincount(predicted, weights=sample, minlength=len(names))
        hits = np.bincount(truth, weights=sample * (truth == predicted), minlength=len(names))
        present = support + claimed
        f1 = float(np.mean(2 * hits[present > 0] / present[present > 0]))
        return pd.DataFrame({"replicate": [key[0]], "f1_macro": [f1]})

    spread = named.select("truth", "predicted", "n", every.alias("replicate"))
    return spread.groupBy("replicate").applyInPandas(draw, "replicate long, f1_macro double")


def poisson_steps() -> list[float]:
    """The Poisson(1) distribution function at 0, 1, ... as far as a 32-bit number can tell it from 1."""
    steps, term, total = [], math.exp(-1), 0.0
    while 1 - (total + term) > 2.0**-33:
        total += term
        steps.append(round(total, 12))
        term /= len(steps)
    return steps


def named_rows(df: DataFrame, truth: str, predicted: str, key: str, name: str) -> DataFrame:
    """The rows as (truth, predicted, name), with a name of its own for each row.

    That is the key, or "" for none, and for all rows of a key but the first also their number,
    in the order of truth and predicted. Copies are counted first, so that a hot key is numbered as
    a few counts; the rows are dealt out anew after that, since their number says more than their bytes.
    """
    copies = df.groupBy(key, truth, predicted).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy(key).orderBy(F.asc_nulls_first(truth), F.asc_nulls_first(predicted))
    upto = copies.withColumn("_upto", F.sum("_n").over(order))
    number = F.explode(F.sequence(F.col("_upto") - F.col("_n"), F.col("_upto") - 1))
    rows = upto.select(key, truth, predicted, number.alias("_number"))
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), F.when(F.col("_number") > 0, F.col("_number")))
    return rows.repartition(tasks, key, "_number").select(truth, predicted, named.alias(name))


def bootstrap_f1_weighted(
    df: DataFrame, truth: str, predicted: str, key: str, n_resamples: int = 50, seed: int = 42
) -> DataFrame:
    """The same law from row weights: each row counts Poisson(1) times per replicate.

    The weights are a function of (seed, replicate, key) only, so any engine can repeat
    them. Every row is drawn for every replicate inside its task, four replicates from one digest,
    and added to the K*K cells of each replicate there; only cells are sent.
    """
    fours = F.explode(F.sequence(F.lit(0), F.lit((n_resamples - 1) // 4)))
    rows = df.select(F.col(truth).alias("truth"), F.col(predicted).alias("predicted"), F.col(key).alias("_key"), fours.alias("four"))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("four").cast("string"), F.col("_key").cast("string")))
    rows = rows.select("truth", "predicted", "four", digest.alias("_digest"))
    rows = rows.select("truth", "predicted", "four", *[F.substring("_digest", 1 + 8 * i, 8).alias(f"u{i}") for i in range(4)])
    # u / 2^32 >= step, where u is the number that eight hex digits write: they are in the order of their numbers
    steps = [f"{math.ceil(s * 2**32):08x}" for s in poisson_steps()]

    def weight(u: str) -> Column:
        drawn = F.when(F.col(u) < F.lit(steps[0]), F.lit(0))
        for n, step in enumerate(steps[1:], 1):
            drawn = drawn.when(F.col(u) < F.lit(step), F.lit(n))
        return drawn.otherwise(F.lit(len(steps))).cast("long")

    sums = rows.groupBy("four", "truth", "predicted").agg(*[F.sum(weight(f"u{i}")).alias(f"n{i}") for i in range(4)])
    replicates = F.array(*[F.struct((4 * F.col("four") + i).alias("replicate"), F.col(f"n{i}").alias("n")) for i in range(4)])
    cells = sums.select("truth", "predicted", F.inline(replicates)).where((F.col("n") > 0) & (F.col("replicate") < n_resamples))
    return summary_scores(class_scores(cells, ("replicate",)), ("replicate",)).select("replicate", "f1_macro")


def poisson_window(mean: int) -> tuple[int, int]:
    """Counts between which a Poisson number of this mean lies, but for a chance below 1e-15."""
    wide = 12 * math.sqrt(mean) + 12
    return max(0, math.floor(mean - wide)), math.ceil(mean + wide)


def bootstrap_f1_from_cells(cells: DataFrame, n_resamples: int = 1000, seed: int = 42) -> DataFrame:
    """The law of ``bootstrap_f1_weighted`` from the cells alone: (replicate, f1_macro).

    The sum of n independent Poisson(1) weights is one Poisson(n) number, so a replicate is
    one draw for each cell, whatever the number of rows: the inverse distribution function at
    the number in [0, 1) that md5 gives for (seed, replicate, truth, predicted). Any engine can
    repeat it. Each cell is drawn in a group of its own, over a window of some square roots of n.
    """
    named = cells.select(F.col("truth").cast("string"), F.col("predicted").cast("string"), F.col("n").cast("long"))

    def draw(group: pa.Table) -> pa.Table:
        truth, predicted, mean = (group[c][0].as_py() for c in ("truth", "predicted", "n"))
        low, high = poisson_window(mean)
        logs = np.array([k * math.log(mean) - mean - math.lgamma(k + 1) for k in range(low, high + 1)])
        below = np.cumsum(np.exp(logs))
        keys = (f"{seed}|{r}|{truth}|{predicted}" for r in range(n_resamples))
        u = np.array([int(hashlib.md5(k.encode()).hexdigest()[:8], 16) for k in keys]) / 4294967296.0
        n = np.minimum(low + np.searchsorted(below, u, side="right"), high)
        same = lambda v: pa.array([v] * n_resamples, pa.string())
        return pa.table({"replicate": np.arange(n_resamples), "truth": same(truth), "predicted": same(predicted), "n": n})

    schema = "replicate long, truth string, predicted string, n long"
    drawn = named.where("n > 0").groupBy("truth", "predicted").applyInArrow(draw, schema).where("n > 0")
    return summary_scores(class_scores(drawn, ("replicate",)), ("replicate",)).select("replicate", "f1_macro")


def percentile_interval(replicates: DataFrame, alpha: float = 0.05) -> DataFrame:
    """One row (ci_low, ci_high); the input has one row per replicate, a set number."""
    cut = F.percentile("f1_macro", F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2)))
    return replicates.agg(cut.alias("_cut")).select(
        F.round(F.element_at("_cut", 1), 4).alias("ci_low"), F.round(F.element_at("_cut", 2), 4).alias("ci_high")
    )


def bootstrap_f1_ci(
    df: DataFrame, truth: str, predicted: str, n_resamples: int = 1000, seed: int = 42, alpha: float = 0.05
) -> DataFrame:
    cells = confusion_cells(df, truth, predicted)
    return percentile_interval(bootstrap_f1(cells, n_resamples, seed), alpha)
