"""Machines of many classes: the solver, the curves and the matrix against plain numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import plan
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ticketloom.operators import linear
from ticketloom.operators.classifiers import CalibratedHead, Curves


def rows_of(classes, n=240, width=30, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((classes, width)) * 1.2
    labels = draw.integers(classes, size=n)
    x = np.maximum(centres[labels] + draw.standard_normal((n, width)), 0)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    return x, labels, np.arange(n) % 5


@pytest.fixture(scope="module")
def data(spark):
    def made(classes, **settings):
        x, labels, folds = rows_of(classes, **settings)
        sparse = [Vectors.sparse(x.shape[1], {j: float(v) for j, v in enumerate(r) if v}) for r in x]
        rows = [(v, float(k), int(f), i) for i, (v, k, f) in enumerate(zip(sparse, labels, folds, strict=True))]
        frame = spark.createDataFrame(rows, ["features", "_label", "_fold", "id"]).repartition(3, "id")
        return frame, x, labels, folds

    return made


def newton(x, sides, c):
    """The same loss by full Newton steps with halving: an independent way to its minimum."""
    rows = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(rows.shape[1])

    def loss(v):
        return v @ v / 2 + c * (np.maximum(0, 1 - sides * (rows @ v)) ** 2).sum()

    for _ in range(200):
        short = np.maximum(0, 1 - sides * (rows @ w))
        gradient = w - 2 * c * rows.T @ (short * sides)
        if np.linalg.norm(gradient) < 1e-10:
            break
        used = rows[short > 0]
        step = np.linalg.solve(np.eye(len(w)) + 2 * c * used.T @ used, gradient)
        size = 1.0
        while loss(w - size * step) > loss(w) - 1e-12 and size > 1e-8:
            size /= 2
        w = w - size * step
    return w


@pytest.mark.parametrize("classes", [3, 20])
def test_weights_equal_an_independent_solver(data, classes):
    frame, x, labels, _ = data(classes)
    blocks = linear.blocked(frame, x.shape[1]).persist()
    fit = linear.fit_squared_hinge(blocks, x.shape[1], [linear.Target(k) for k in range(classes)], 1.5, 400, 1e-5, 0)
    expected = np.stack([newton(x, np.where(labels == k, 1.0, -1.0), 1.5) for k in range(classes)])
    assert np.abs(fit.weights - expected).max() < 1e-3 and fit.gradients.max() <= 1e-5
    blocks.unpersist()


def test_passes_do_not_grow_with_classes(data):
    passes = {}
    for classes in (2, 20):
        frame, x, _, _ = data(classes)
        blocks = linear.blocked(frame, x.shape[1]).persist()
        passes[classes] = linear.fit_squared_hinge(blocks, x.shape[1], [linear.Target(k) for k in range(classes)]).passes
        blocks.unpersist()
    assert passes[20] <= 2 * passes[2]


def test_members_leave_their_fold_out(data):
    frame, x, labels, folds = data(3, n=120)
    blocks = linear.blocked(frame, x.shape[1], fold="_fold").persist()
    targets = [linear.Target(k, f) for f in range(5) for k in range(3)]
    fit = linear.fit_squared_hinge(blocks, x.shape[1], targets, 1.0, 300, 1e-5, 0)
    expected = np.stack([newton(x[folds != t.left_out], np.where(labels == t.label, 1.0, -1.0)[folds != t.left_out], 1.0) for t in targets])
    assert np.abs(fit.weights - expected).max() < 1e-3

    held = linear.held_margins(blocks, fit.weights, targets).persist()
    own = {t: (x[folds == t.left_out] @ w[:-1] + w[-1], labels[folds == t.left_out] == t.label) for t, w in zip(targets, fit.weights, strict=True)}
    for t, (slope, offset) in zip(targets, linear.fit_sigmoids(held, targets), strict=True):
        margins, is_ = own[t]
        soft = np.where(is_, (is_.sum() + 1) / (is_.sum() + 2), 1 / ((~is_).sum() + 2))
        off = 1 / (1 + np.exp(-(slope * margins + offset))) - soft
        # at the minimum of a convex loss both derivatives vanish
        assert abs((off * margins).sum()) < 1e-5 and abs(off.sum()) < 1e-5
    for t, (xs, ys) in zip(targets, linear.fit_monotone(held, targets), strict=True):
        margins, is_ = own[t]
        assert xs == sorted(xs) and ys == sorted(ys) and len(set(xs)) == len(xs)
        # the mean of the fit over the rows is the share of the class
        fitted = np.interp(np.rint(margins * linear.GRID) / linear.GRID, xs, ys)
        assert fitted.mean() == pytest.approx(is_.mean(), abs=1e-9)
    blocks.unpersist()
    held.unpersist()


def test_pooled_is_the_least_squares_monotone_fit():
    draw = np.random.default_rng(4)
    for _ in range(50):
        n = int(draw.integers(1, 12))
        x, w = np.arange(n) / 4, draw.integers(1, 5, n)
        total = np.array([draw.integers(0, k + 1) for k in w])
        xs, ys = linear.pooled(x, w, total)
        # value at i is the largest, over starts up to i, of the least mean over ends from i on
        means = lambda a, b: total[a : b + 1].sum() / w[a : b + 1].sum()
        expected = [max(min(means(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        assert np.interp(x, xs, ys) == pytest.approx(expected)


def test_curves_in_the_plan_equal_numpy(spark):
    curves = [([-1.0, 0.0, 2.0], [0.1, 0.1, 0.9]), ([0.5], [0.3]), ([-3.0, -1.0, -0.5, 0.25, 0.75], [0.0, 0.2, 0.2, 0.6, 1.0])]
    margins = [[-5.0, 0.0, -0.75], [2.0, 0.5, 0.25], [1.0, 9.0, 0.7], [-1.0, -9.0, -3.0], [7.0, 1.0, 8.0]]
    frame = spark.createDataFrame([(m,) for m in margins], "m array<double>")
    found = frame.select(linear.monotone(F.col("m"), curves)).collect()
    for row, m in zip(found, margins, strict=True):
        assert row[0] == pytest.approx([float(np.interp(v, *c)) for v, c in zip(m, curves, strict=True)])
    found = frame.select(linear.sigmoids(F.col("m"), [1.0, -2.0, 0.5], [0.0, 1.0, 3.0])).collect()
    for row, m in zip(found, margins, strict=True):
        expected = [1 / (1 + math.exp(-(v * a + b))) for v, a, b in zip(m, [1.0, -2.0, 0.5], [0.0, 1.0, 3.0], strict=True)]
        assert row[0] == pytest.approx(expected)


def test_seventy_seven_classes_are_one_multiply(spark, data):
    """One prediction function for all members and classes, and one curve expression for each member."""
    frame, x, _, _ = data(3, n=60)
    draw, classes = np.random.default_rng(2), [f"c{i:02d}" for i in range(77)]
    weights = draw.standard_normal((5 * 77, x.shape[1] + 1))
    members = [Curves("sigmoid", draw.uniform(1, 3, 77).tolist(), draw.uniform(-1, 1, 77).tolist()) for _ in range(5)]
    scored = CalibratedHead(classes, True, linear.matrix_model(spark, weights), members).score(frame)
    text = plan(scored)
    assert text.count("UDF(features") == 1 and "EvalPython" not in text and "MapIn" not in text
    found = {r["id"]: r["scores"] for r in scored.collect()}
    for i in range(0, 60, 7):
        margins = (weights[:, :-1] @ x[i] + weights[:, -1]).reshape(5, 77)
        parts = [1 / (1 + np.exp(-(m * c.xs + c.ys))) for m, c in zip(margins, members, strict=True)]
        assert found[i] == pytest.approx(np.mean([p / p.sum() for p in parts], axis=0))
