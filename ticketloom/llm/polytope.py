"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import splitmix
from ticketloom.llm.components import Stash, connected_components

#: Least hash tables, and buckets that a vector is put into in each (its own and the next best).
TABLES, PROBES = 6, 2
ALIKE = 0.9
#: Share of the pairs at a cosine of exactly ``ALIKE`` that meet, at every count; tables are
#: added until so many of the drawn pairs do, with ``SPARE`` more as a draw's error. Above
#: MOST_TABLES, buckets are made of one rotation less.
RECALL, SPARE, MOST_TABLES = 0.97, 0.005, 64
#: Vectors compared in one place; a larger bucket is dealt as pairs of blocks.
BLOCK = 2048


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of the rows; their length is a power of two."""
    x, half = x.copy(), 1
    while half < x.shape[1]:
        pairs = x.reshape(len(x), -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), -1)
        half *= 2
    return x / math.sqrt(x.shape[1])


def signs(dimensions: int, count: int, seed: int) -> np.ndarray:
    """count x 3 rows of random signs: the diagonals of one rotation each."""
    numbers = splitmix(np.arange(count * 3 * dimensions, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 32))
    return (1.0 - 2.0 * (numbers & np.uint64(1))).reshape(count, 3, dimensions)


def rotations_for(count: int, dimensions: int, alike: float = ALIKE) -> int:
    """Rotations whose hashes make one bucket: about as many buckets as there are vectors.

    Buckets smaller than the cap of the sphere that is alike would part neighbours only,
    so there are no more of them than such caps.
    """
    dimensions = max(dimensions, 2)
    angles = (np.arange(20_000) + 0.5) * (math.pi / 20_000)
    weights = np.sin(angles) ** (dimensions - 2)
    cap = float(weights[np.cos(angles) >= alike].sum() / weights.sum())
    most = min(max(count, 2), 1 / cap if cap > 0 else math.inf)
    return max(1, round(math.log(most) / math.log(2 * dimensions)))


@lru_cache(maxsize=None)
def tables_for(length: int, dimensions: int, alike: float = ALIKE, probes: int = PROBES) -> int | None:
    """Tables of ``length`` rotations in which RECALL of the pairs at exactly ``alike`` meet; None above MOST_TABLES.

    Pairs from a fixed seed are hashed with the very rotations that vectors of so many
    dimensions get, as in few dimensions some tables repeat others.
    """
    draw, rows = np.random.default_rng(length), max(500, min(2000, (1 << 18) // dimensions))
    a, b = draw.standard_normal((2, rows, max(dimensions, 2)))
    a = unit(a)
    b = unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    pairs = np.concatenate([a, alike * a + math.sqrt(max(0.0, 1 - alike**2)) * b])
    met = np.zeros(rows, bool)
    for table in range(MOST_TABLES):
        found = buckets(pairs, length, 1, probes, seed=dimensions, first=table)
        met |= (found[:rows, :, None] == found[rows:, None, :]).any(axis=(1, 2))
        if met.mean() >= RECALL + SPARE:
            return table + 1
    return None


def layout(
    count: int, dimensions: int, alike: float = ALIKE, tables: int = TABLES, probes: int = PROBES
) -> tuple[int, int]:
    """Rotations of a bucket and tables for ``count`` vectors: RECALL holds at every count.

    More rotations need more tables. Where even one rotation needs too many, there is one
    bucket for all vectors (no rotations), and every pair is compared.
    """
    for length in range(rotations_for(count, dimensions, alike), 0, -1):
        needed = tables_for(length, dimensions, alike, probes)
        if needed is not None:
            return length, max(tables, needed)
    return 0, 1


def buckets(
    units: np.ndarray, length: int, tables: int = TABLES, probes: int = PROBES, seed: int = 1, first: int = 0
) -> np.ndarray:
    """rows x (tables * probes): signed 64-bit bucket numbers, of each table from ``first`` on the best first.

    A rotation is three rounds of random signs and a Hadamard transform; its hash is the
    nearest of the 2 d points +-e_i. A bucket joins ``length`` such hashes. Further probes
    change the one hash where the second nearest point costs least. The number starts
    from the length of the vectors and the table.
    """
    rows, wide = len(units), 1 << max(1, (units.shape[1] - 1).bit_length())
    padded = np.zeros((rows, wide))
    padded[:, : units.shape[1]] = units
    diagonals = signs(wide, (first + tables) * length, seed)
    out = np.empty((rows, tables, probes), np.uint64)
    every = np.arange(rows)
    for table in range(first, first + tables):
        best = np.empty((rows, length), np.uint64)
        options, losses = [], []
        for part in range(length):
            turned = padded
            for diagonal in diagonals[table * length + part]:
                turned = hadamard(turned * diagonal)
            size = np.abs(turned)
            near = np.argsort(-size, axis=1, kind="stable")[:, :probes]
            top = size[every[:, None], near]
            points = (near + wide * (turned[every[:, None], near] < 0)).astype(np.uint64)
            best[:, part] = points[:, 0]
            for i in range(1, near.shape[1]):
                options.append((part, points[:, i]))
                losses.append(top[:, 0] ** 2 - top[:, i] ** 2)
        order = np.argsort(np.stack(losses, axis=1), axis=1, kind="stable") if losses else np.zeros((rows, 0), int)
        parts = np.array([part for part, _ in options], int)
        others = np.stack([p for _, p in options], axis=1) if options else np.zeros((rows, 0), np.uint64)
        for probe in range(probes):
            hashes = best.copy()
            if probe and probe <= order.shape[1]:
                pick = order[:, probe - 1]
                hashes[every, parts[pick]] = others[every, pick]
            number = splitmix(np.full(rows, (units.shape[1] << 32) + table, np.uint64))
            for part in range(length):
                number = splitmix(number ^ hashes[:, part])
            out[:, table - first, probe] = number
    return out.reshape(rows, -1).view(np.int64)


def _vectors(column: pa.Array) -> tuple[list[int], list[np.ndarray]]:
    """Places and values of the usable vectors of a batch: finite, not zero, without nulls."""
    places, found = [], []
    for i, value in enumerate(column.to_pylist()):
        if value and all(x is not None for x in value):
            vector = np.asarray(value, np.float64)
            if np.isfinite(vector).all() and vector.any():
                places.append(i)
                found.append(vector)
    return places, found


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, first by their largest entry so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, embedding) -> (vec_id, vector): the usable vectors in binary, -0.0 written as 0.0; else null."""
    for batch in batches:
        made: list[bytes | None] = [None] * batch.num_rows
        for place, vector in zip(*_vectors(batch.column(1)), strict=True):
            made[place] = (vector + 0.0).astype("<f8").tobytes()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["vec_id", "vector"])


def _linked(batches: Iterator[pa.RecordBatch], alike: float) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, block, mine, key, copies, vector, buckets), a bucket's block together -> counts and links.

    A pair that meets in several buckets is counted in the least of them only, and in
    that bucket in the block of its two halves, so counts add up without a list of pairs.
    Vectors of other lengths, whose numbers may be equal by chance, are blocks of their own.
    """
    held: list[tuple] = []
    place: tuple | None = None
    counts: dict[int, int] = {}
    links: list[tuple[int, int]] = []

    def close() -> None:
        for size in sorted({len(r[3]) for r in held}):
            alone = [r for r in held if len(r[3]) == size]
            if len(alone) > 1:
                _block(place[0], alone, alike, counts, links)

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(7)]
        for bucket, block, mine, key, copies, vector, own in zip(*columns, strict=True):
            if (bucket, block) != place:
                close()
                held, place = [], (bucket, block)
            held.append((mine, key, copies, np.frombuffer(vector, "<f8"), np.asarray(own, np.int64)))
    close()
    kinds = (pa.int64(), pa.int64(), pa.int64())
    rows = [(k, n, None) for k, n in counts.items()] + [(a, 0, b) for a, b in links]
    values = zip(*rows, strict=True) if rows else ([], [], [])
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(v), k) for v, k in zip(values, kinds, strict=True)], names=["key", "links", "other"]
    )


def _block(bucket: int, held: list[tuple], alike: float, counts: dict, links: list) -> None:
    held.sort(key=lambda r: r[1])
    units = unit(np.stack([r[3] for r in held]))
    halves, copies = np.array([r[0] for r in held]), np.array([r[2] for r in held])
    keys = [r[1] for r in held]
    wide = max(len(r[4]) for r in held)
    own = np.stack([np.pad(r[4], (0, wide - len(r[4])), mode="edge") for r in held])
    mixed = len(np.unique(halves)) > 1
    label, total = np.arange(len(held)), np.zeros(len(held), np.int64)
    for start in range(0, len(held), 512):
        near = units[start : start + 512] @ units.T >= alike
        for i in range(start, min(start + 512, len(held))):
            others = np.flatnonzero(near[i - start, i + 1 :]) + i + 1
            if mixed:
                others = others[halves[others] != halves[i]]
            if not len(others):
                continue
            common = (own[others][:, :, None] == own[i][None, None, :]).any(axis=2)
            first = np.where(common, own[others], np.iinfo(np.int64).max).min(axis=1)
            others = others[first == bucket]
            total[i] += copies[others].sum()
            total[others] += copies[i]
            for j in others[label[others] != label[i]].tolist():
                if label[j] != label[i]:
                    links.append((keys[i], keys[j]))
                    label[label == label[j]] = label[i]
    for i in np.flatnonzero(total).tolist():
        counts[keys[i]] = counts.get(keys[i], 0) + int(total[i])


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    alike: float = ALIKE,
    tables: int = TABLES,
    probes: int = PROBES,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Equal vectors are one class, so copies are counted and never compared. Each class
    goes into ``probes`` buckets of each of ``tables`` tables, or of more where more
    vectors ask for finer buckets (see ``layout``); pairs that meet are verified by their
    cosine in double precision. A bucket larger than a block is dealt
    as pairs of blocks, so no place holds more than two blocks, and every pair of the
    bucket is still compared.

    Vectors that are null, empty, zero or hold null or non-finite numbers link with
    nothing and are their own component. Vectors of different lengths never meet. Rows
    without a key have null component and are no links of others; repeated rows are
    copies, each a link of the others. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    stash = Stash(spark)
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))
    read = stash.put(rows.mapInArrow(_keyed, "vec_id long, vector binary"), "vectors")
    usable = read.where(F.col("vector").isNotNull() & F.col("vec_id").isNotNull())
    classes = usable.groupBy("vector").agg(F.min("vec_id").alias("key"), F.count("*").alias("copies"))
    classes = stash.put(classes.where(F.octet_length("vector") > 0), "classes")
    lengths = classes.groupBy((F.octet_length("vector") / 8).cast("int").alias("size")).agg(F.count("*").alias("n"))
    layouts = {r["size"]: layout(r["n"], r["size"], alike, tables, probes) for r in lengths.collect()}
    schema = "key long, copies long, vector binary, buckets array<long>"

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.frombuffer(v, "<f8") for v in batch.column("vector").to_pylist()]
            made: list = [None] * len(held)
            for size in sorted({len(v) for v in held}):
                places = [i for i, v in enumerate(held) if len(v) == size]
                units = unit(np.stack([held[i] for i in places]))
                length, of = layouts[size]
                found = buckets(units, length, of, probes, seed=size)
                for i, numbers in zip(places, found, strict=True):
                    made[i] = np.unique(numbers)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("copies"),
                    batch.column("vector"),
                    pa.array(made, pa.list_(pa.int64())),
                ],
                names=["key", "copies", "vector", "buckets"],
            )

    placed = stash.put(classes.select("key", "copies", "vector").mapInArrow(hashed, schema), "buckets")
    entries = placed.select(F.explode("buckets").alias("bucket"), "key")
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = entries.join(sizes, "bucket").withColumn("blocks", F.ceil(F.col("n") / F.lit(BLOCK)))
    mine = F.pmod(F.xxhash64("key"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = met.withColumn("mine", mine).withColumn("other", other)
    block = F.least("mine", "other") * F.col("blocks") + F.greatest("mine", "other")
    dealt = dealt.select("bucket", block.alias("block"), "mine", "key")
    together = dealt.join(placed, "key").select("bucket", "block", "mine", "key", "copies", "vector", "buckets")
    ordered = together.repartition("bucket", "block").sortWithinPartitions("bucket", "block")
    found = stash.put(
        ordered.mapInArrow(lambda batches: _linked(batches, alike), "key long, links long, other long"), "found"
    )
    edges = found.where("other is not null").select(F.col("key").alias("a"), F.col("other").alias("b"))
    linked = connected_components(edges, stash)
    totals = found.groupBy("key").agg(F.sum("links").alias("links"))
    by_class = (
        classes.join(totals, "key", "left")
        .join(linked, F.col("key") == F.col("node"), "left")
        .select(
            "vector",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "key").alias("root"),
        )
    )
    # keys are the least numbers of their classes, so the least key of a component is its least number
    joined = read.join(by_class, "vector", "left")
    alone = F.col("vec_id").isNull() | F.col("root").isNull()
    return joined.select(
        "vec_id",
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("root")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
