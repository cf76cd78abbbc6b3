"""Linear machines of many classes as one matrix: fitted together, calibrated together, applied by one multiply."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a block, which is made dense for a multiply.
BLOCK = 512
#: Steps and gradients that the search for the minimum remembers.
MEMORY = 20
#: A machine is done when its gradient is at most this long, or this part of the first. The loss is
#: strongly convex with modulus 1, so the weights are then no further than that from the optimum.
GRADIENT, SHARE = 1e-2, 1e-3
#: Machines up to which sparse sums are quicker than making rows dense and multiplying.
FEW = 16
#: Tasks whose sums the driver adds; those of more are added by column in a shuffle first.
FAN_IN = 64
#: Steps of margins on which isotonic curves are counted, per unit.
GRID = 256

BLOCKS = "labels binary, folds binary, starts binary, places binary, values binary"


@dataclass(frozen=True)
class Target:
    """What one machine tells apart: a class from all others, in the rows of all folds but one."""

    label: int
    left_out: int = -1


# --- blocks of rows --------------------------------------------------------------------------------


def blocked(featured: DataFrame, width: int, label: str = "_label", fold: str | None = None) -> DataFrame:
    """``features`` with label and fold in sparse blocks of rows; the caller keeps it as long as it fits."""
    inner = F.unwrap_udt("features")
    # a dense vector has no places: they are all
    places = F.coalesce(inner["indices"], F.sequence(F.lit(0), F.lit(width - 1)))
    folds = F.col(fold).cast("int") if fold else F.lit(-2)
    rows = featured.select(F.col(label).cast("int").alias("label"), folds.alias("fold"), places.alias("p"), inner["values"].alias("v"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(start, BLOCK)
                sizes = np.array([len(x) for x in batch.column("p")], np.int64)
                made = (
                    batch.column("label").to_numpy().astype("<i4"),
                    batch.column("fold").to_numpy().astype("<i4"),
                    np.concatenate([[0], np.cumsum(sizes)]).astype("<i8"),
                    batch.column("p").flatten().to_numpy().astype("<i4"),
                    batch.column("v").flatten().to_numpy().astype("<f8"),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes()], pa.binary()) for x in made],
                    names=["labels", "folds", "starts", "places", "values"],
                )

    return rows.mapInArrow(packed, BLOCKS)


@dataclass
class _Block:
    """Some rows: labels, folds, and features with a constant last one."""

    labels: np.ndarray
    folds: np.ndarray
    owner: np.ndarray  # of each entry its row
    places: np.ndarray
    values: np.ndarray
    width: int

    def dense(self) -> np.ndarray:
        rows = np.zeros((len(self.labels), self.width + 1))
        rows[self.owner, self.places] = self.values
        rows[:, -1] = 1
        return rows

    def margins(self, weights: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
        """Rows x machines."""
        if rows is not None:
            return rows @ weights.T
        each = [np.bincount(self.owner, self.values * w[self.places], len(self.labels)) + w[-1] for w in weights]
        return np.stack(each, axis=1)

    def combined(self, shares: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
        """Machines x features: the sum of rows, each as often as its share says."""
        if rows is not None:
            return shares.T @ rows
        out = np.empty((shares.shape[1], self.width + 1))
        for m, share in enumerate(shares.T):
            out[m, :-1] = np.bincount(self.places, self.values * share[self.owner], self.width)
            out[m, -1] = share.sum()
        return out


def _read(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[_Block]:
    for batch in batches:
        for raw in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            kinds = ("<i4", "<i4", "<i8", "<i4", "<f8")
            labels, folds, starts, places, values = (np.frombuffer(x, k) for x, k in zip(raw, kinds, strict=True))
            yield _Block(labels, folds, np.repeat(np.arange(len(labels)), np.diff(starts)), places, values, width)


# --- fitting ---------------------------------------------------------------------------------------


def _summed(frame: DataFrame, part: Callable, columns: int) -> dict[int, np.ndarray]:
    """For each column the sum of what all tasks make of their blocks: one row per task and column, added by column.

    Only sums come to the driver: as much as FAN_IN matrices of weights at most, whatever the rows.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = part(batches)
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(columns, dtype=np.int32)), pa.array([t.tobytes() for t in total], pa.binary())],
                names=["machine", "sums"],
            )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for machine, sums in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                value = np.frombuffer(sums, "<f8")
                total[machine] = total[machine] + value if machine in total else value
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())],
            names=["machine", "sums"],
        )

    schema = "machine int, sums binary"
    parts = frame.mapInArrow(partial, schema)
    if frame.rdd.getNumPartitions() > FAN_IN:
        parts = parts.repartition("machine").mapInArrow(added, schema)
    total: dict[int, np.ndarray] = {}
    for row in sorted(parts.collect(), key=lambda r: (r["machine"], r["sums"])):
        value = np.frombuffer(row["sums"], "<f8")
        total[row["machine"]] = total[row["machine"]] + value if row["machine"] in total else value
    return total


def _losses(blocks: DataFrame, weights: np.ndarray, targets: list[Target], c: float) -> tuple[np.ndarray, np.ndarray]:
    """Loss and gradient of every machine at its weights, from one pass over the rows.

    The loss of a machine is |w|^2 / 2 + c * sum of max(0, 1 - y (w x + b))^2, where the
    offset b is the weight of a constant feature.
    """
    width = weights.shape[1] - 1
    sent = blocks.sparkSession.sparkContext.broadcast(weights)
    names = np.array([t.label for t in targets])
    left_out = np.array([t.left_out for t in targets])

    def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        w, total = sent.value, None
        for block in _read(batches, width):
            rows = block.dense() if len(w) > FEW else None
            sides = np.where(block.labels[:, None] == names, 1.0, -1.0)
            short = np.maximum(0, 1 - sides * block.margins(w, rows)) * (block.folds[:, None] != left_out)
            found = np.concatenate([(short**2).sum(axis=0)[:, None], -2 * block.combined(short * sides, rows)], axis=1)
            total = found if total is None else total + found
        return total

    found = _summed(blocks, part, len(targets))
    sent.destroy()
    sums = np.stack([found.get(i, np.zeros(width + 2)) for i in range(len(targets))])
    return (weights**2).sum(axis=1) / 2 + c * sums[:, 0], weights + c * sums[:, 1:]


def _curvatures(blocks: DataFrame, width: int, targets: list[Target], c: float) -> np.ndarray:
    """The diagonal of every machine's second derivatives while all its rows are short of the margin."""
    folds_of = sorted({t.left_out for t in targets})

    def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        total = np.zeros((len(folds_of), width + 1))
        for block in _read(batches, width):
            for f, fold in enumerate(folds_of):
                used = block.folds != fold
                total[f, :-1] += np.bincount(block.places, block.values**2 * used[block.owner], width)
                total[f, -1] += used.sum()
        return total

    found = _summed(blocks, part, len(folds_of))
    by_fold = {fold: 1 + 2 * c * found.get(f, np.zeros(width + 1)) for f, fold in enumerate(folds_of)}
    return np.stack([by_fold[t.left_out] for t in targets])


@dataclass
class Fit:
    weights: np.ndarray  # machines x (width + 1), the offset last
    passes: int
    gradients: np.ndarray  # lengths of the last gradients


def _directions(
    gradient: np.ndarray, steps: np.ndarray, turns: np.ndarray, known: np.ndarray, curvature: np.ndarray
) -> np.ndarray:
    """Limited-memory quasi-Newton directions of all machines at once; ``known`` counts what each remembers.

    Weights of common terms bend the loss thousands of times more than those of rare ones, so what
    is not remembered is taken from the diagonal ``curvature``.
    """
    out, shares = -gradient.copy(), []
    dots = np.einsum("mij,mij->mi", steps, turns)
    for m in range(len(steps)):
        used = (m < known) & (dots[m] > 0)
        share = np.where(used, np.einsum("ij,ij->i", steps[m], out) / np.where(used, dots[m], 1), 0)
        out -= share[:, None] * turns[m]
        shares.append((used, share))
    newest = np.einsum("ij,ij->i", turns[0], turns[0] / curvature)
    scale = np.where((known > 0) & (newest > 0), dots[0] / np.where(newest > 0, newest, 1), 1)
    out *= scale[:, None] / curvature
    for m in range(len(steps) - 1, -1, -1):
        used, share = shares[m]
        back = np.where(used, np.einsum("ij,ij->i", turns[m], out) / np.where(used, dots[m], 1), 0)
        out += np.where(used, share - back, 0)[:, None] * steps[m]
    return out


def fit_squared_hinge(
    blocks: DataFrame,
    width: int,
    targets: list[Target],
    c: float = 1.0,
    max_passes: int = 100,
    gradient: float = GRADIENT,
    share: float = SHARE,
) -> Fit:
    """The machines of all targets, from passes that each serve all of them.

    Every machine has its own quasi-Newton memory and step length; a pass evaluates each
    at the place it wants to try next, so the number of passes is that of the slowest
    machine and not their sum. Machines that are done are left out of further passes.
    """
    count = len(targets)
    weights = np.zeros((count, width + 1))
    loss, slope = _losses(blocks, weights, targets, c)
    curvature = _curvatures(blocks, width, targets, c)
    passes = 2
    first = np.linalg.norm(slope, axis=1)
    goal = np.maximum(gradient, share * first)
    steps, turns = np.zeros((MEMORY, count, width + 1)), np.zeros((MEMORY, count, width + 1))
    known = np.zeros(count, int)
    direction, length = -slope / curvature, np.ones(count)
    while passes < max_passes:
        open_ = np.flatnonzero(np.linalg.norm(slope, axis=1) > goal)
        if not len(open_):
            break
        tried = weights[open_] + length[open_, None] * direction[open_]
        there, turned = _losses(blocks, tried, [targets[i] for i in open_], c)
        passes += 1
        fall = np.einsum("ij,ij->i", slope[open_], direction[open_])
        taken = there <= loss[open_] + 1e-4 * length[open_] * fall
        # a step that goes too far is cut to where a parabola has its least value
        over = open_[~taken]
        t = length[over]
        bend = there[~taken] - loss[over] - t * fall[~taken]
        length[over] = np.clip(-fall[~taken] * t**2 / np.maximum(2 * bend, 1e-300), 0.1 * t, 0.5 * t)
        moved = open_[taken]
        if len(moved):
            steps[1:, moved], turns[1:, moved] = steps[:-1, moved], turns[:-1, moved]
            steps[0, moved], turns[0, moved] = tried[taken] - weights[moved], turned[taken] - slope[moved]
            known[moved] = np.minimum(known[moved] + 1, MEMORY)
            weights[moved], loss[moved], slope[moved] = tried[taken], there[taken], turned[taken]
            direction[moved] = _directions(slope[moved], steps[:, moved], turns[:, moved], known[moved], curvature[moved])
            length[moved] = 1.0
        if (length < 1e-12).any():
            slope[length < 1e-12] = 0  # no better place in sight
    return Fit(weights, passes, np.linalg.norm(slope, axis=1))


# --- calibration -----------------------------------------------------------------------------------


def held_margins(blocks: DataFrame, weights: np.ndarray, targets: list[Target]) -> DataFrame:
    """(labels, folds, margins) of each block: of every row the margins of the machines that did not see it."""
    width, folds_of = weights.shape[1] - 1, sorted({t.left_out for t in targets})
    sent = blocks.sparkSession.sparkContext.broadcast(weights)
    mine = {f: np.array([i for i, t in enumerate(targets) if t.left_out == f]) for f in folds_of}

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _read(batches, width):
            every = block.margins(sent.value, block.dense() if len(targets) > FEW else None)
            margins = np.zeros((len(block.labels), len(mine[folds_of[0]])))
            for fold, machines in mine.items():
                at = block.folds == fold
                margins[at] = every[np.ix_(at, machines)]
            parts = (block.labels.astype("<i4"), block.folds.astype("<i4"), margins.astype("<f8"))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes()], pa.binary()) for x in parts], names=["labels", "folds", "margins"]
            )

    return blocks.mapInArrow(made, "labels binary, folds binary, margins binary")


def _margins(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for labels, folds, margins in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            names = np.frombuffer(labels, "<i4")
            yield names, np.frombuffer(folds, "<i4"), np.frombuffer(margins, "<f8").reshape(len(names), -1)


def fit_sigmoids(margins: DataFrame, targets: list[Target], max_passes: int = 50) -> list[tuple[float, float]]:
    """(slope, offset) of each machine's sigmoid: Platt's fit to softened targets, by Newton steps of all at once."""
    folds_of = sorted({t.left_out for t in targets})
    names = np.array([t.label for t in targets]).reshape(len(folds_of), -1)
    count = names.size

    def sums(function: Callable) -> np.ndarray:
        def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
            total = np.zeros((count, 6))
            for labels, folds, values in _margins(batches):
                for f, fold in enumerate(folds_of):
                    at = folds == fold
                    own = slice(f * names.shape[1], (f + 1) * names.shape[1])
                    total[own] += function(labels[at, None] == names[f], values[at], own)
            return total

        found = _summed(margins, part, count)
        return np.stack([found[i] for i in range(count)])

    def count_sides(is_, values, own):
        yes = is_.sum(axis=0)
        return np.stack([yes, len(is_) - yes, *[np.zeros(len(yes))] * 4], axis=1)

    sides = sums(count_sides)
    high, low = (sides[:, 0] + 1) / (sides[:, 0] + 2), 1 / (sides[:, 1] + 2)
    params = np.stack([np.zeros(count), np.log((sides[:, 0] + 1) / (sides[:, 1] + 1))], axis=1)

    def evaluate(at: np.ndarray) -> np.ndarray:
        """Loss, gradient and second derivatives of each machine."""

        def parts(is_, values, own):
            z = values * at[own, 0] + at[own, 1]
            p, soft = 1 / (1 + np.exp(-z)), np.where(is_, high[own], low[own])
            loss = np.logaddexp(0, z) - soft * z
            off, bend = p - soft, p * (1 - p)
            each = (loss, off * values, off, bend * values**2, bend * values, bend)
            return np.stack([x.sum(axis=0) for x in each], axis=1)

        return sums(parts)

    here, scale = evaluate(params), np.ones(count)
    step = np.zeros_like(params)
    for _ in range(max_passes):
        loss, ga, gb, haa, hab, hbb = here.T
        determinant = np.maximum((haa + 1e-12) * (hbb + 1e-12) - hab**2, 1e-300)
        newton = np.stack([(hbb + 1e-12) * ga - hab * gb, (haa + 1e-12) * gb - hab * ga], axis=1) / determinant[:, None]
        step = -newton * scale[:, None]
        if np.abs(step).max() < 1e-8:
            break
        there = evaluate(params + step)
        better = there[:, 0] <= loss + 1e-12 * np.abs(loss)
        params[better], here[better] = (params + step)[better], there[better]
        scale = np.where(better, 1.0, scale / 4)
    return [(float(a), float(b)) for a, b in params]


def pooled(x: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[list[float], list[float]]:
    """Knots of the monotone fit to weighted means at rising x: neighbours that fall are pooled."""
    pools: list[list[float]] = []  # weight, total, first x, last x
    for at, w, s in zip(x.tolist(), weight.tolist(), total.tolist(), strict=True):
        pools.append([w, s, at, at])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            w2, s2, _, last = pools.pop()
            pools[-1][0] += w2
            pools[-1][1] += s2
            pools[-1][3] = last
    xs, ys = [], []
    for w, s, first, last in pools:
        for at in (first,) if first == last else (first, last):
            xs.append(at)
            ys.append(s / w)
    return xs, ys


def fit_monotone(margins: DataFrame, targets: list[Target]) -> list[tuple[list[float], list[float]]]:
    """Knots of each machine's isotonic curve, fitted to counts on a grid of 1 / GRID.

    So the fit and its knots follow from the range of the margins and not from the number of
    rows; counts are added per task before they are shuffled, and only knots come to the driver.
    """
    folds_of = sorted({t.left_out for t in targets})
    names = np.array([t.label for t in targets]).reshape(len(folds_of), -1)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, hits = [], []
        for labels, folds, values in _margins(batches):
            for f, fold in enumerate(folds_of):
                at = folds == fold
                steps = np.rint(values[at] * GRID).astype(np.int64)
                machine = np.broadcast_to(np.arange(names.shape[1]) + f * names.shape[1], steps.shape)
                keys.append(np.stack([machine.ravel(), steps.ravel()], axis=1))
                hits.append((labels[at, None] == names[f]).ravel())
        if keys:
            found, place = np.unique(np.concatenate(keys), axis=0, return_inverse=True)
            hit = np.concatenate(hits)
            n = np.bincount(place.ravel(), minlength=len(found))
            yes = np.bincount(place.ravel(), weights=hit, minlength=len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(n), pa.array(yes)], names=["machine", "step", "n", "yes"]
            )

    cells = margins.mapInArrow(counted, "machine long, step long, n long, yes long")
    cells = cells.groupBy("machine", "step").agg(F.sum("n").alias("n"), F.sum("yes").alias("yes"))

    def fitted(table: pa.Table) -> pa.Table:
        table = table.sort_by("step")
        steps, n, yes = (table[c].to_numpy() for c in ("step", "n", "yes"))
        xs, ys = pooled(steps / GRID, n, yes)
        kinds = pa.list_(pa.float64())
        return pa.table({"machine": table["machine"][:1], "xs": pa.array([xs], kinds), "ys": pa.array([ys], kinds)})

    rows = cells.groupBy("machine").applyInArrow(fitted, "machine long, xs array<double>, ys array<double>").collect()
    return [(r["xs"], r["ys"]) for r in sorted(rows, key=lambda r: r["machine"])]


# --- applying --------------------------------------------------------------------------------------


def matrix_model(spark: SparkSession, weights: np.ndarray) -> LogisticRegressionModel:
    """A JVM model whose raw prediction is weights times features plus offsets: one multiply for all machines.

    The multinomial logistic model is used for its matrix only; its probabilities are not made.
    """
    matrix = np.ascontiguousarray(weights[:, :-1])
    rows, columns = matrix.shape
    context = spark.sparkContext
    made = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"matrix_{uuid.uuid4().hex[:12]}",
        _py2java(context, DenseMatrix(rows, columns, matrix.ravel(), True)),
        _py2java(context, DenseVector(weights[:, -1])),
        rows,
        True,
    )
    return LogisticRegressionModel(made)


def multiplied(df: DataFrame, model: LogisticRegressionModel, out: str) -> DataFrame:
    """``df`` with the array of all machines' margins."""
    from pyspark.ml.functions import vector_to_array

    bare = model.copy().setFeaturesCol("features").setRawPredictionCol("_raw").setProbabilityCol("").setPredictionCol("")
    return bare.transform(df).withColumn(out, vector_to_array("_raw")).drop("_raw")


def doubles(values: list[float]) -> Column:
    """An array constant that is one literal in the plan, however long."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def sigmoids(margins: Column, slopes: list[float], offsets: list[float]) -> Column:
    """1 / (1 + exp(-(slope * margin + offset))) of each margin."""
    a, b = doubles(slopes), doubles(offsets)
    return F.transform(margins, lambda m, i: 1 / (1 + F.exp(-(m * F.get(a, i) + F.get(b, i)))))


def monotone(margins: Column, curves: list[tuple[list[float], list[float]]]) -> Column:
    """Each margin on its own curve, between the knots on either side; these are found by halving."""
    sizes = [len(xs) for xs, _ in curves]
    starts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    xs = doubles([x for knots, _ in curves for x in knots])
    ys = doubles([y for _, knots in curves for y in knots])
    first = F.array(*[F.lit(s) for s in starts])
    halvings = F.sequence(F.lit(1), F.lit(max(sizes).bit_length()))

    def above(m: Column, low: Column, high: Column) -> Column:
        """The first place in low..high whose knot lies above the margin; high if none."""

        def halve(range_: Column, _: Column) -> Column:
            middle = F.floor((range_["low"] + range_["high"]) / 2).cast("int")
            open_ = range_["low"] < range_["high"]
            is_below = open_ & (F.get(xs, middle) <= m)
            return F.struct(
                F.when(is_below, middle + 1).otherwise(range_["low"]).alias("low"),
                F.when(open_ & ~is_below, middle).otherwise(range_["high"]).alias("high"),
            )

        return F.aggregate(halvings, F.struct(low.alias("low"), high.alias("high")), halve, lambda r: r["low"])

    def value(m: Column, i: Column) -> Column:
        low, high = F.get(first, i), F.get(first, i + 1)

        def between(at: Column) -> Column:
            x0, x1, y0, y1 = F.get(xs, at - 1), F.get(xs, at), F.get(ys, at - 1), F.get(ys, at)
            inside = y0 + (y1 - y0) * (m - x0) / (x1 - x0)
            return F.when(at == low, F.get(ys, low)).when(at == high, F.get(ys, high - 1)).otherwise(inside)

        return F.get(F.transform(F.array(above(m, low, high)), between), F.lit(0))

    return F.transform(margins, value)


def persisted(blocks: DataFrame) -> DataFrame:
    return blocks.persist(StorageLevel.MEMORY_AND_DISK)
