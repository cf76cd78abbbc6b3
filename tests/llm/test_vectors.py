"""Graph search and hard negatives against brute force, on planted rows and on whole small tables."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticketloom.llm import queries, shards, slots, vamana
from ticketloom.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, score string, rank string, size string, vector string"


def framed(spark, rows):
    """(vec_id, embedding, label) with extra columns of clashing names."""
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Unusable vectors, copies, other lengths, other norms, and one vector that half of the rows share."""
    draw = np.random.default_rng(5)
    rows = [(i, draw.standard_normal(16).astype("f4").tolist(), int(draw.integers(4))) for i in range(0, 600)]
    hot = draw.standard_normal(16).astype("f4").tolist()
    rows += [(i, hot, i % 4) for i in range(600, 1100)]
    rows += [(i, (draw.standard_normal(16) * 1000).astype("f4").tolist(), 1) for i in range(1100, 1140)]
    rows += [(i, draw.standard_normal(5).astype("f4").tolist(), 2) for i in range(1140, 1150)]
    rows += [
        (1200, None, 1),
        (1220, [0.0] * 16, 1),
        (1240, [1.0] * 15 + [math.nan], 1),
        (1260, [1.0] * 15 + [None], 1),
        (1280, [1.0] * 15 + [math.inf], 1),
        (1300, [], 1),
        (None, [1.0] * 16, 1),
        (1400, [0.5] * 16, None),
    ]
    return rows + rows[:30]


def sound(rows, zero):
    """One vector for each key that takes part."""
    kept = {}
    for key, vector, label in rows:
        if key is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if zero or any(vector):
            kept[key] = (np.array(vector, float), label)
    return kept


def test_neighbours_of_odd_rows(spark, odd_vectors):
    kept = sound(odd_vectors, zero=False)
    found = vamana.nearest_neighbours(framed(spark, odd_vectors), "vec_id % 20 = 0").collect()
    mine = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        mine.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    hits = total = 0
    for q in (k for k in kept if k % 20 == 0):
        others = [(-float(kept[q][0] @ v), k) for k, (v, _) in kept.items() if k != q and len(v) == len(kept[q][0])]
        best = sorted(others)[:20]
        got = mine.get(q, [])
        assert len(got) == len(best)
        assert got == sorted(got, key=lambda x: (-x[1], x[0])) and len({i for i, _ in got}) == len(got)
        for i, score in got:
            assert i != q and math.isclose(score, float(kept[q][0] @ kept[i][0]), rel_tol=1e-12, abs_tol=1e-12)
        hits += len({i for i, _ in got} & {i for _, i in best})
        total += len(best)
    assert set(mine) == {k for k in kept if k % 20 == 0}
    assert hits >= 0.97 * total
    nothing = framed(spark, odd_vectors).where("false")
    assert vamana.nearest_neighbours(nothing, "vec_id % 20 = 0").count() == 0


def test_copies_are_equally_near(spark):
    """A query whose vector half of the rows share finds the smallest ids among them, but not itself."""
    rows = [(i, [1.0, 0.0], 0) for i in range(200)] + [(i, [0.9, 0.1], 0) for i in range(200, 230)]
    found = vamana.nearest_neighbours(framed(spark, rows), "vec_id in (0, 100)").orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in found if r["query_id"] == 0] == list(range(1, 21))
    assert [r["vec_id"] for r in found if r["query_id"] == 100] == list(range(20))
    assert {r["score"] for r in found} == {1.0}


def test_graph_is_reachable_and_bounded():
    vectors = np.random.default_rng(1).standard_normal((1500, 24))
    graph = vamana.build(vectors, degree=16, beam=32)
    assert graph.edges.shape == (1500, 16)
    for node, edges in enumerate(graph.edges):
        own = edges[edges >= 0].tolist()
        assert node not in own and len(set(own)) == len(own)
    reached, front = set(graph.starts.tolist()), graph.starts.tolist()
    while front:
        front = list({e for n in front for e in graph.edges[n].tolist() if e >= 0} - reached)
        reached |= set(front)
    assert len(reached) == 1500


def test_pruning_keeps_diverse_edges():
    """Of candidates in one direction the nearest stays; one on the other side stays too."""
    angles = np.array([0.0, 0.1, 0.12, 0.14, -0.3])
    points = np.stack([np.cos(angles), np.sin(angles)], axis=1).astype(np.float32)
    nodes = np.array([[1, 2, 3, 4]], np.int32)
    likeness = (points[nodes[0]] @ points[0])[None, :]
    kept = vamana.prune(points, np.array([0]), nodes, likeness, 3, 1.2)
    assert kept.tolist() == [[1, 4, -1]]


def recall(spark, sf):
    found = queries.QUERIES["op11_graph_search"](spark, sf).toPandas()
    rows = table(spark, sf, "embeddings").toPandas()
    vectors, ids = np.array(rows["embedding"].tolist(), float), rows["vec_id"].to_numpy()
    mine = found.groupby("query_id")["vec_id"].apply(set)
    hits = total = 0
    for at in np.flatnonzero(ids % 20 == 0):
        score = vectors @ vectors[at]
        score[at] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]].tolist()
        hits += len(mine[ids[at]] & set(best))
        total += len(best)
    return hits / total


def test_graph_query_recall(spark, sf):
    assert recall(spark, sf) >= 0.98
    assert recall(spark, "/root/testdata/sf0.1") >= 0.95


def brute_negatives(rows, step=100):
    kept = {k: (np.floor(256 * v), label) for k, (v, label) in sound(rows, zero=True).items() if label is not None}
    kept = {k: ([int(x) for x in v], label) for k, (v, label) in kept.items()}
    out = set()
    for a in (k for k in kept if k % step == 0):
        scored = sorted(
            (-sum(x * y for x, y in zip(kept[a][0], v, strict=True)), k, label)
            for k, (v, label) in kept.items()
            if k != a and len(v) == len(kept[a][0])
        )
        for s, p, _ in [x for x in scored if x[2] == kept[a][1]][:5]:
            fits = [x for x in scored if x[2] != kept[a][1] and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out |= {(a, p, i + 1, n, -s, -t) for i, (t, n, _) in enumerate(fits)}
    return out


@pytest.mark.parametrize("shard", [8192, 64])
def test_negatives_of_odd_rows(spark, odd_vectors, shard):
    found = slots.hard_negatives(framed(spark, odd_vectors), "vec_id % 100 = 0", shard=shard)
    assert {tuple(r) for r in found.collect()} == brute_negatives(odd_vectors)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert slots.hard_negatives(framed(spark, odd_vectors).where("false"), "vec_id % 100 = 0").count() == 0


def test_negatives_with_many_ties(spark):
    """Small whole vectors: scores tie, windows share limits, and positives of score 0 and below occur."""
    draw = np.random.default_rng(9)
    rows = [(i, (draw.integers(-2, 4, 3) / 256).tolist(), int(draw.integers(3))) for i in range(300)]
    found = slots.hard_negatives(framed(spark, rows), "vec_id % 10 = 0", shard=50)
    assert {tuple(r) for r in found.collect()} == brute_negatives(rows, 10)


def test_scores_are_exact_beyond_doubles():
    a, b = np.array([[2.0**30 + 1, 3.0]]), np.array([[2.0**25 + 1, 1.0], [1.0, -(2.0**60)]])
    assert slots.scores(a, b).tolist() == [[(2**30 + 1) * (2**25 + 1) + 3, -slots.MOST]]


def test_shards_hold_their_part_only(spark):
    """A hash deals every row to one part, whose number is below the parts of its length."""
    rows = framed(spark, [(i, [float(i + 1), 1.0], 0) for i in range(1000)])
    usable = vamana.usable(rows)
    parts = shards.parts_of(usable, 100)
    placed = shards.dealt(usable, parts, "vector").groupBy("size", "band", "part").agg(F.count("*").alias("n")).collect()
    assert sum(r["n"] for r in placed) == 1000 and max(r["n"] for r in placed) < 200
