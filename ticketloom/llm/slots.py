"""Hard negatives by slots: the upper limits of an anchor's positives cut the scores into disjoint slots."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm import shards
from ticketloom.llm.components import Stash

#: Rows of a shard, on average.
SHARD = 8192
#: Positives of an anchor, negatives of a positive, and the limits of a negative's score in
#: hundredths of the positive's.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
#: Components are whole multiples of one in so many, rounded down.
SCALE = 256
#: Scores beyond this size count as this size, so that a hundred of them are still a long.
MOST = 1 << 56


def whole(vector: np.ndarray) -> np.ndarray:
    """Components in whole steps of 1 / SCALE: exact, since the scale is a power of two."""
    return np.floor(np.clip(vector, -1e300, 1e300) * SCALE)


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whole inner products of whole vectors, anchors x rows, exact whatever their size."""
    largest = float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(rows.shape[1], 1)
    if largest < 2**53:
        return (anchors @ rows.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    product = exact(anchors) @ exact(rows).T if rows.shape[1] else np.zeros((len(anchors), len(rows)))
    return np.clip(product, -MOST, MOST).astype(np.int64)


def first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` first: the higher score, then the smaller id."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= least)
        return near[np.lexsort((ids[near], -score[near]))[:k]]
    return np.lexsort((ids, -score))[:k]


@dataclass
class _Shard:
    vectors: np.ndarray
    ids: np.ndarray
    labels: np.ndarray


def _opened(rows: pa.Table) -> _Shard:
    labels = rows["label"].to_numpy()
    return _Shard(shards.matrix(rows["vector"]), rows["vec_id"].to_numpy(), labels)


def _asked(shard: _Shard, batch: pa.RecordBatch):
    """Of each anchor: its id, label, scores with all rows of the shard, and its place in the batch."""
    ids, labels = batch.column("anchor_id").to_pylist(), batch.column("anchor_label").to_pylist()
    anchors = shards.matrix(batch.column("vector"))
    for start in range(0, len(ids), 64):
        product = scores(anchors[start : start + 64], shard.vectors)
        for i, score in enumerate(product, start):
            yield ids[i], labels[i], score, i


def _positives(shard: _Shard, batch: pa.RecordBatch, k: int) -> dict[str, list]:
    out: dict[str, list] = {"anchor_id": [], "vec_id": [], "score": []}
    for anchor, label, score, _ in _asked(shard, batch):
        same = np.flatnonzero((shard.labels == label) & (shard.ids != anchor))
        best = same[first(score[same], shard.ids[same], k)]
        out["anchor_id"] += [anchor] * len(best)
        out["vec_id"] += shard.ids[best].tolist()
        out["score"] += score[best].tolist()
    return out


def _slotted(shard: _Shard, batch: pa.RecordBatch, k: int) -> dict[str, list]:
    """The first ``k`` rows of other labels in each slot; ``uppers`` fall, slot i lies between limits i and i + 1."""
    out: dict[str, list] = {"anchor_id": [], "slot": [], "vec_id": [], "score": []}
    uppers, lowest = batch.column("uppers").to_pylist(), batch.column("lowest").to_pylist()
    for anchor, label, score, i in _asked(shard, batch):
        limits = np.array(uppers[i], np.int64)
        held = np.flatnonzero((score <= limits[0]) & (score >= lowest[i]) & (shard.labels != label))
        # the number of limits that a score does not exceed, less one, is its slot
        slot = len(limits) - np.searchsorted(limits[::-1], score[held], side="left") - 1
        for s in np.unique(slot).tolist():
            inside = held[slot == s]
            best = inside[first(score[inside], shard.ids[inside], k)]
            out["anchor_id"] += [anchor] * len(best)
            out["slot"] += [s] * len(best)
            out["vec_id"] += shard.ids[best].tolist()
            out["score"] += score[best].tolist()
    return out


def _hundredths(score: Column, hundredths: int, more: int) -> Column:
    """So many hundredths of a score that is not negative: rounded down with ``more`` 0, rounded up with 99."""
    # decimals divide by a hundred exactly
    return F.floor((score * F.lit(hundredths) + F.lit(more)).cast("decimal(20,0)") / F.lit(100)).cast("long")


def _merged(rows: DataFrame, by: tuple[str, ...], k: int) -> DataFrame:
    """The first ``k`` of each group over all shards, with their ``rank``."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)


def _suffixes(slots: Column, entries: Column, k: int) -> Column:
    """For each slot the first ``k`` entries of it and of all lower ones: one merge per slot, from the lowest up.

    Scores of a slot exceed those of lower slots, so a merge is a concatenation.
    """
    nothing = F.expr("cast(array() as array<array<struct<score: bigint, vec_id: bigint>>>)")

    def merge(known: Column, slot: Column) -> Column:
        own = F.transform(
            F.filter(entries, lambda e: e["slot"] == slot),
            lambda e: F.struct(e["score"].alias("score"), e["vec_id"].alias("vec_id")),
        )
        below = F.when(F.size(known) == 0, F.expr("cast(array() as array<struct<score: bigint, vec_id: bigint>>)"))
        below = below.otherwise(F.get(known, F.lit(0)))
        return F.concat(F.array(F.slice(F.concat(own, below), 1, k)), known)

    return F.aggregate(F.reverse(F.sequence(F.lit(0), slots - 1)), nothing, merge)


def hard_negatives(
    rows: DataFrame,
    asking: str,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    shard: int = SHARD,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows that fulfil ``asking`` (SQL over ``vec_id``); scores are whole inner
    products of the whole vectors (see ``whole``). An anchor's positives are its first
    ``positives`` other rows of its label. A row of another label is a negative of a
    positive if ``low`` * positive score <= 100 * its score <= ``high`` * positive score; the
    first ``negatives`` are returned, the higher score first, ties by the smaller id.

    Windows of one anchor overlap, so they are not searched one by one. Their upper limits
    cut the scores into disjoint slots; each shard keeps the first rows of each slot, the
    shards' rows are merged by slot, and what a window may hold is the merge of its slot
    with all lower ones, of which the lower limit then cuts off the end. The rows are read in
    shards of bounded size, past which all anchors stream.

    Rows without key or label, with a null vector or null or non-finite numbers take no
    part; of rows with one key the least by label and vector counts. Vectors of different lengths
    are never compared. Where a positive's score is negative no score is in its window. An
    empty table gives no rows; other columns are not read.
    """
    stash = Stash(rows.sparkSession)
    plain = rows.select(F.col(key).alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"))
    plain = plain.where(F.col("label").isNotNull())
    usable = shards.usable_vectors(plain, "vec_id", "vector", whole, ("label",))
    usable = stash.put(usable.withColumn("band", F.lit(0)), "usable")
    parts = stash.put(shards.parts_of(usable, shard), "parts")
    placed = shards.dealt(usable, parts, "vec_id")
    anchors = usable.where(asking).select(
        F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), "size", "vector"
    )

    found = shards.answers(
        placed,
        anchors,
        parts,
        _opened,
        lambda s, batch: _positives(s, batch, positives),
        "anchor_id long, vec_id long, score long",
    )
    # at most ``positives`` of each anchor
    per = _merged(found, ("anchor_id",), positives).groupBy("anchor_id")
    wanted = F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("wanted")
    wanted = stash.put(per.agg(wanted), "positives")
    windows = F.filter("wanted", lambda p: p["score"] >= 0)
    limited = wanted.withColumn("windows", windows).where(F.size("windows") > 0)
    limited = limited.withColumn("uppers", F.transform("windows", lambda p: _hundredths(p["score"], high, 0)))
    limited = limited.withColumn("uppers", F.sort_array(F.array_distinct("uppers"), asc=False))
    limited = limited.withColumn("lowest", F.array_min(F.transform("windows", lambda p: _hundredths(p["score"], low, 99))))
    asked = anchors.join(limited.select("anchor_id", "uppers", "lowest"), "anchor_id")
    kept = shards.answers(
        placed,
        asked,
        parts,
        _opened,
        lambda s, batch: _slotted(s, batch, negatives),
        "anchor_id long, slot int, vec_id long, score long",
    )
    kept = _merged(kept, ("anchor_id", "slot"), negatives).groupBy("anchor_id")
    # at most ``negatives`` of each slot, ``positives`` slots
    entries = kept.agg(F.collect_list(F.struct("slot", "rank", "score", "vec_id")).alias("entries"))
    both = entries.withColumn("entries", F.sort_array("entries")).join(limited, "anchor_id")
    both = both.withColumn("suffixes", _suffixes(F.size("uppers"), F.col("entries"), negatives))
    each = both.select("anchor_id", "uppers", "suffixes", F.inline("windows").alias("positive_rank", "positive_id", "positive_score"))
    slot = F.array_position("uppers", _hundredths(F.col("positive_score"), high, 0)).cast("int")
    held = F.filter(
        F.element_at("suffixes", slot), lambda e: e["score"] * 100 >= F.col("positive_score") * F.lit(low)
    )
    out = each.select("anchor_id", "positive_id", "positive_score", F.posexplode(held).alias("place", "negative"))
    return out.select(
        "anchor_id",
        "positive_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("negative.vec_id").alias("negative_id"),
        "positive_score",
        F.col("negative.score").alias("negative_score"),
    )
