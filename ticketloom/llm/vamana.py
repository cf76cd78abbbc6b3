"""Approximate nearest neighbours: robust-pruned directed graphs in shards, searched by beams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm import shards
from ticketloom.llm.components import Stash

#: Distinct vectors of a shard, on average; edges of a node; relaxation of the pruning.
SHARD, DEGREE, RELAXED = 8192, 32, 1.2
#: Places that a beam keeps while the graph is built, and while it is searched.
BUILD_BEAM, BEAM = 64, 128
#: Nodes that search for their neighbours together, and candidates that one pruning looks at.
BATCH, CANDIDATES = 512, 128
#: Neighbours that a query asks for.
NEAREST = 20


@dataclass
class Graph:
    """Nodes on the unit sphere, their edges (-1 fills up), and where a search starts."""

    points: np.ndarray  # n x d, float32
    edges: np.ndarray  # n x degree, int32
    starts: np.ndarray


def on_sphere(vectors: np.ndarray) -> np.ndarray:
    """Vectors as points of a sphere with one dimension more, where the largest inner product is the nearest point."""
    scaled = vectors / np.abs(vectors).max()
    norms = np.linalg.norm(scaled, axis=1)
    most = norms.max()
    rest = np.sqrt(np.maximum(most**2 - norms**2, 0))
    return (np.concatenate([scaled, rest[:, None]], axis=1) / most).astype(np.float32)


def beam_search(graph: Graph, targets: np.ndarray, beam: int, known: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` best nodes met by a greedy search from the starts, of each target: (nodes, likeness), best first.

    All targets go in step: in each step a target opens the best node of its beam that it
    has not opened, and the node's edges join the beam; a target whose beam is all opened
    is done. Only the first ``known`` nodes are in the graph yet. -1 fills up.
    """
    rows = len(targets)
    nodes = np.full((rows, beam), -1, np.int32)
    likeness = np.full((rows, beam), -np.inf, np.float32)
    opened = np.ones((rows, beam), bool)
    seen = np.zeros((rows, known), bool)
    starts = graph.starts[:beam]
    seen[:, starts] = True
    first = targets @ graph.points[starts].T
    order = np.argsort(-first, axis=1, kind="stable")
    nodes[:, : len(starts)] = starts[order]
    likeness[:, : len(starts)] = np.take_along_axis(first, order, 1)
    opened[:, : len(starts)] = False
    active = np.arange(rows)
    while len(active):
        waiting = ~opened[active]
        open_ = waiting.any(axis=1)
        active, waiting = active[open_], waiting[open_]
        if not len(active):
            break
        place = waiting.argmax(axis=1)
        opened[active, place] = True
        near = graph.edges[nodes[active, place]]
        fresh = near >= 0
        at, column = np.nonzero(fresh)
        new = ~seen[active[at], near[at, column]]
        at, column = at[new], column[new]
        found = near[at, column]
        seen[active[at], found] = True
        value = np.full(near.shape, -np.inf, np.float32)
        value[at, column] = np.einsum("ij,ij->i", targets[active[at]], graph.points[found])
        joined = np.concatenate([likeness[active], value], axis=1)
        ids = np.concatenate([nodes[active], near], axis=1)
        done = np.concatenate([opened[active], np.zeros(near.shape, bool)], axis=1)
        order = np.argsort(-joined, axis=1, kind="stable")[:, :beam]
        likeness[active] = joined = np.take_along_axis(joined, order, 1)
        ids = np.take_along_axis(ids, order, 1)
        lost = joined == -np.inf
        nodes[active] = np.where(lost, -1, ids)
        opened[active] = np.take_along_axis(done, order, 1) | lost
    return nodes, likeness


def prune(
    points: np.ndarray, owners: np.ndarray, nodes: np.ndarray, likeness: np.ndarray, degree: int, relaxed: float
) -> np.ndarray:
    """Of each owner's candidates (nearest first, -1 fills up), at most ``degree`` diverse ones.

    The nearest candidate is kept, and with it all others go that are nearer to it, by
    the factor ``relaxed``, than to the owner; then the nearest of what is left is kept.
    """
    out = np.full((len(nodes), degree), -1, np.int32)
    for start in range(0, len(nodes), 64):
        some = nodes[start : start + 64]
        alive = (some >= 0) & (some != owners[start : start + 64, None])
        places = points[np.maximum(some, 0)]
        # squared distances, of points that all have length one
        between = (2 - 2 * (places @ places.transpose(0, 2, 1))) * np.float32(relaxed**2)
        away = 2 - 2 * likeness[start : start + 64]
        part, kept = out[start : start + 64], np.zeros(len(some), int)
        for c in range(some.shape[1]):
            rows = np.flatnonzero(alive[:, c] & (kept < degree))
            part[rows, kept[rows]] = some[rows, c]
            kept[rows] += 1
            alive[rows] &= between[rows, c] > away[rows]
    return out


def _likeness(points: np.ndarray, owners: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """How near each owner's nodes are to it; -1 has none."""
    value = (points[np.maximum(nodes, 0)] @ points[owners][:, :, None])[:, :, 0]
    return np.where(nodes >= 0, value, np.float32(-np.inf))


def _nearest_first(points: np.ndarray, owners: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    value = _likeness(points, owners, nodes)
    order = np.argsort(-value, axis=1, kind="stable")[:, :CANDIDATES]
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(value, order, 1)


def _back_edges(graph: Graph, owners: np.ndarray, relaxed: float) -> None:
    """Each new edge also leads back; nodes with too many edges are pruned."""
    degree = graph.edges.shape[1]
    chosen = graph.edges[owners]
    target, source = chosen.ravel(), np.repeat(owners, degree)
    source, target = source[target >= 0], target[target >= 0]
    known = (graph.edges[target] == source[:, None]).any(axis=1)
    order = np.argsort(target[~known], kind="stable")
    source, target = source[~known][order], target[~known][order]
    if not len(target):
        return
    names, first, counts = np.unique(target, return_index=True, return_counts=True)
    most = int(counts.max())
    place = np.arange(len(target)) - np.repeat(first, counts)
    added = np.full((len(names), most), -1, np.int32)
    added[np.repeat(np.arange(len(names)), counts), place] = source
    for start in range(0, len(names), 256):
        some = names[start : start + 256]
        both = np.concatenate([graph.edges[some], added[start : start + 256]], axis=1)
        size = (both >= 0).sum(axis=1)
        fits = size <= degree
        packed_ = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
        graph.edges[some[fits]] = packed_[fits, :degree]
        if not fits.all():
            owners_ = some[~fits]
            nodes, value = _nearest_first(graph.points, owners_, both[~fits])
            graph.edges[owners_] = prune(graph.points, owners_, nodes, value, degree, relaxed)


def build(vectors: np.ndarray, degree: int = DEGREE, relaxed: float = RELAXED, beam: int = BUILD_BEAM) -> Graph:
    """The graph of some distinct vectors, none of them zero.

    Nodes come in batches that double, up to BATCH. Each searches the graph so far; the
    beam, and what the batch itself offers, is pruned to its edges, which also lead back. Where
    nodes cannot be reached from the middle, searches start from one of them too.
    """
    points = on_sphere(vectors)
    n = len(points)
    graph = Graph(points, np.full((n, degree), -1, np.int32), np.zeros(1, np.int64))
    done = 1
    while done < n:
        new = np.arange(done, min(n, done + min(done, BATCH)))
        nodes, _ = beam_search(graph, points[new], beam, done)
        own = np.argsort(-(points[new] @ points[new].T), axis=1, kind="stable")[:, 1 : 1 + degree]
        nodes, value = _nearest_first(points, new, np.concatenate([nodes, new[own].astype(np.int32)], axis=1))
        graph.edges[new] = prune(points, new, nodes, value, degree, relaxed)
        _back_edges(graph, new, relaxed)
        done = int(new[-1]) + 1
    middle = points.mean(axis=0, dtype=np.float64)
    graph.starts = np.array([int((points @ middle.astype(np.float32)).argmax())])
    reached = np.zeros(n, bool)
    front = graph.starts
    while True:
        while len(front):
            reached[front] = True
            near = np.unique(graph.edges[front])
            near = near[near >= 0]
            front = near[~reached[near]]
        if reached.all():
            return graph
        front = np.flatnonzero(~reached)[:1]
        graph.starts = np.concatenate([graph.starts, front])


def norm_band(vectors: np.ndarray) -> np.ndarray:
    """Logarithm of the norms, rounded: vectors of one band differ in norm by a factor of two at most."""
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    norms = np.log2(largest[:, 0]) + np.log2(np.linalg.norm(vectors / largest, axis=1))
    return np.rint(norms).astype(np.int32)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, size, vector) -> the same with the norm's band."""
    for batch in batches:
        sizes, bands = batch.column("size").to_numpy(), np.zeros(batch.num_rows, np.int32)
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            bands[rows] = norm_band(shards.matrix(batch.column("vector").take(pa.array(rows))))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bands)], names=[*batch.schema.names, "band"])


INDEX = (
    "size int, band int, part int, node int, vector binary, ids array<long>, edges array<int>, start boolean"
)


def _built(batches: Iterator[pa.RecordBatch], degree: int, relaxed: float, beam: int) -> Iterator[pa.RecordBatch]:
    """Rows (size, band, part, vector, ids) in the order of the shards -> INDEX."""
    held: list[pa.RecordBatch] = []
    place: tuple | None = None

    def shard() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        graph = build(shards.matrix(rows["vector"]), degree, relaxed, beam)
        n = rows.num_rows
        starts = np.zeros(n, bool)
        starts[graph.starts] = True
        names = ("size", "band", "part", "node", "vector", "ids", "edges", "start")
        made = [*rows.columns[:3], pa.array(np.arange(n, dtype=np.int32)), *rows.columns[3:]]
        made += [pa.array([e[e >= 0] for e in graph.edges], pa.list_(pa.int32())), pa.array(starts)]
        yield from pa.table(made, names=names).to_batches(max_chunksize=4096)

    for batch in batches:
        marks = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
        cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), len(marks)]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if start == end:
                continue
            if tuple(marks[start]) != place:
                if held:
                    yield from shard()
                held, place = [], tuple(marks[start])
            held.append(batch.slice(start, end - start))
    if held:
        yield from shard()


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, size, vector, band) of the rows that take part: finite vectors that are not zero."""
    rows = shards.usable_vectors(vectors, key, vector, lambda v: v if v.any() else None)
    return rows.mapInArrow(_banded, "vec_id long, size int, vector binary, band int")


def build_index(
    rows: DataFrame,
    copies: int = NEAREST + 1,
    shard: int = SHARD,
    degree: int = DEGREE,
    relaxed: float = RELAXED,
    beam: int = BUILD_BEAM,
) -> DataFrame:
    """The graphs of all rows of ``usable``, one row per node (see INDEX); to be kept as a table.

    Equal vectors are one node with its ``copies`` least ids, which are all that searches for
    fewer neighbours can need; so copies, however many, neither crowd a graph nor a
    task. Nodes of one length and one band of norms are dealt to shards of ``shard``
    nodes on average by a hash.
    """
    place = F.row_number().over(Window.partitionBy("size", "band", "vector").orderBy("vec_id"))
    least = rows.withColumn("__n", place).where(F.col("__n") <= copies)
    nodes = least.groupBy("size", "band", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = Stash(rows.sparkSession).put(nodes, "nodes")
    placed = shards.dealt(nodes, shards.parts_of(nodes, shard), "vector").select(*shards.PLACE, "vector", "ids")
    together = placed.repartition(*shards.PLACE).sortWithinPartitions(*shards.PLACE, "vector")
    return together.mapInArrow(lambda batches: _built(batches, degree, relaxed, beam), INDEX)


@dataclass
class _Shard:
    graph: Graph
    vectors: np.ndarray
    ids: list[list[int]]


def _opened(rows: pa.Table) -> _Shard:
    rows = rows.take(np.argsort(rows["node"].to_numpy()))
    vectors, lists = shards.matrix(rows["vector"]), rows["edges"].to_pylist()
    edges = np.full((len(lists), max(1, max(map(len, lists)))), -1, np.int32)
    for i, e in enumerate(lists):
        edges[i, : len(e)] = e
    graph = Graph(on_sphere(vectors), edges, np.flatnonzero(rows["start"].to_numpy(zero_copy_only=False)))
    return _Shard(graph, vectors, rows["ids"].to_pylist())


def _nearest(shard: _Shard, batch: pa.RecordBatch, k: int, beam: int) -> dict[str, list]:
    """The ``k`` nearest ids of the shard for each query, by the inner product in double precision."""
    queries, names = shards.matrix(batch.column("vector")), batch.column("query_id").to_pylist()
    targets = np.concatenate([queries / np.abs(queries).max(axis=1, keepdims=True), np.zeros((len(queries), 1))], axis=1)
    nodes, _ = beam_search(shard.graph, targets.astype(np.float32), beam, len(shard.vectors))
    out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    for name, query, found in zip(names, queries, nodes, strict=True):
        found = found[found >= 0]
        # one pair at a time and in one order, so that equal vectors have equal scores
        scores = np.einsum("ij,j->i", shard.vectors[found], query)
        first = np.array([shard.ids[n][0] for n in found], np.int64)
        best = np.lexsort((first, -scores))[: k + 1]
        pairs = sorted((-scores[b], i) for b in best.tolist() for i in shard.ids[found[b]] if i != name)[:k]
        out["query_id"] += [name] * len(pairs)
        out["vec_id"] += [i for _, i in pairs]
        out["score"] += [float(-s) for s, _ in pairs]
    return out


def search(index: DataFrame, queries: DataFrame, k: int = NEAREST, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest ids found for each row (vec_id, size, vector) of ``queries``.

    Every shard of the query's length is searched by a beam; what the beams hold is
    measured again in double precision, and the shards' best are merged. Nearest means the
    largest inner product, ties go to the smaller id, and a query's own id is no
    neighbour. ``index`` must be a table that keeps at least ``k`` + 1 copies.
    """
    parts = index.groupBy("size", "band").agg((F.max("part") + 1).cast("int").alias("parts"))
    parts = Stash(index.sparkSession).put(parts, "parts")
    asked = queries.select(F.col("vec_id").alias("query_id"), "size", "vector")
    found = shards.answers(
        index,
        asked,
        parts,
        _opened,
        lambda shard, batch: _nearest(shard, batch, k, max(beam, k + 1)),
        "query_id long, vec_id long, score double",
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(
    vectors: DataFrame, asking: str, key: str = "vec_id", vector: str = "embedding", k: int = NEAREST
) -> DataFrame:
    """The ``k`` nearest rows found for each row that fulfils ``asking`` (SQL over ``vec_id``).

    Vectors that are null, empty, zero or hold null or non-finite numbers, and rows without
    a key, neither ask nor are found. Vectors of different lengths are never compared.
    Of rows with one key the least vector counts. Equal vectors are equally near, the
    smaller id first. A query with fewer than ``k`` others finds them all; an empty
    table gives no rows; other columns are not read.
    """
    stash = Stash(vectors.sparkSession)
    rows = stash.put(usable(vectors, key, vector), "usable")
    index = stash.put(build_index(rows, k + 1), "index")
    return search(index, rows.where(asking), k)
