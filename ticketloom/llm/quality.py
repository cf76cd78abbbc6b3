"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.llm.common import crc_mod, slices, with_columns

#: Bytes a filter sees (two steps of STEP), bytes between filters, bytes between chunks.
#: A chunk is two pieces, so every chunk overlaps the next by half and none of a text is left out.
STEP, WIDTH, PIECE = 4, 8, 256
EMBEDDED, FILTERS, HIDDEN = 6, 24, 16

#: Bounds of the labelled sample the network is fitted on: rows of each class, bytes of a text.
ROWS_PER_CLASS, LONGEST = 1500, 32_768
ROUNDS, BATCH, RATE = 400, 48, 0.01

KEEP_AT = 0.3

#: Bytes of a text that go through the network together; of longer ones, run after run.
RUN = 1 << 18


@dataclass
class Network:
    """Weights, of fixed size: embedding, filters with bias, hidden layer, output."""

    embed: np.ndarray  # 256 x EMBEDDED
    filters: np.ndarray  # WIDTH * EMBEDDED x FILTERS
    bias: np.ndarray
    hidden: np.ndarray  # 2 * FILTERS x HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        draw = np.random.default_rng(seed)

        def normal(rows: int, columns: int) -> np.ndarray:
            return (draw.standard_normal((rows, columns)) / np.sqrt(rows)).astype(np.float32)

        zeros = lambda n: np.zeros(n, np.float32)
        return Network(
            draw.standard_normal((256, EMBEDDED)).astype(np.float32) * np.float32(0.5),
            normal(WIDTH * EMBEDDED, FILTERS),
            zeros(FILTERS),
            normal(2 * FILTERS, HIDDEN),
            zeros(HIDDEN),
            normal(HIDDEN, 1)[:, 0],
            zeros(1),
        )


@dataclass
class _Pass:
    """One forward pass over some texts, with what a backward pass needs."""

    codes: np.ndarray  # bytes of all texts, each filled up with zeros to whole pieces
    answers: np.ndarray  # filters x windows
    chunk_of: np.ndarray  # first chunk of each text
    chunks: np.ndarray  # pieces a chunk is made of: first and second
    pooled: np.ndarray  # chunks x filters, after the rectifier
    texts: np.ndarray  # texts x 2 * filters
    middle: np.ndarray
    logits: np.ndarray


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in whole pieces, and the number of pieces of each."""
    pieces = np.array([max(1, -(-len(t) // PIECE)) for t in texts])
    codes = np.zeros(int(pieces.sum()) * PIECE, np.uint8)
    at = 0
    for text, n in zip(texts, pieces.tolist(), strict=True):
        codes[at : at + len(text)] = np.frombuffer(text, np.uint8)
        at += n * PIECE
    return codes, pieces


def _windows(net: Network, codes: np.ndarray) -> np.ndarray:
    """What each window of WIDTH bytes embeds to; the last of all texts is filled with zeros."""
    steps = net.embed[codes].reshape(-1, STEP * EMBEDDED)
    following = np.concatenate([steps[1:], np.zeros((1, steps.shape[1]), np.float32)])
    return np.concatenate([steps, following], axis=1)


def _forward(net: Network, texts: list[bytes]) -> _Pass:
    codes, pieces = _laid_out(texts)
    answers = _windows(net, codes) @ net.filters
    per = PIECE // STEP
    ends = np.cumsum(pieces)
    answers[ends * per - 1] = -np.inf  # a window that would reach into the next text
    of_piece = answers.reshape(-1, per, FILTERS).max(axis=1)
    # chunk i of a text is its pieces i and i + 1; a text of one piece is one chunk
    counts = np.maximum(pieces - 1, 1)
    chunk_of = np.concatenate([[0], np.cumsum(counts)[:-1]])
    first = np.arange(int(counts.sum())) + np.repeat(ends - pieces - chunk_of, counts)
    second = np.minimum(first + 1, np.repeat(ends - 1, counts))
    pooled = np.maximum(np.maximum(of_piece[first], of_piece[second]) + net.bias, 0)
    mean = np.add.reduceat(pooled, chunk_of) / counts[:, None].astype(np.float32)
    most = np.maximum.reduceat(pooled, chunk_of)
    joined = np.concatenate([mean, most], axis=1)
    middle = np.tanh(joined @ net.hidden + net.hidden_bias)
    logits = middle @ net.out + net.out_bias
    return _Pass(codes, answers, chunk_of, np.stack([first, second]), pooled, joined, middle, logits)


def _logit_of_runs(net: Network, text: bytes, run: int) -> float:
    """``_forward`` of one long text over runs of pieces, with one step of overlap; kept are a sum and a maximum.

    A run's last piece is also the first of its next chunk, so its best answers are handed on.
    """
    pieces, per = -(-len(text) // PIECE), max(1, run // PIECE)
    before: np.ndarray | None = None
    total, most = np.zeros(FILTERS), np.full(FILTERS, -np.inf, np.float32)
    for first in range(0, pieces, per):
        last = min(first + per, pieces)
        codes = np.zeros((last - first) * PIECE + STEP, np.uint8)
        part = text[first * PIECE : last * PIECE + STEP]
        codes[: len(part)] = np.frombuffer(part, np.uint8)
        answers = (_windows(net, codes) @ net.filters)[:-1]
        if last == pieces:
            answers[-1] = -np.inf
        of_piece = answers.reshape(last - first, -1, FILTERS).max(axis=1)
        if before is not None:
            of_piece = np.concatenate([before, of_piece])
        before = of_piece[-1:]
        pooled = np.maximum(np.maximum(of_piece[:-1], of_piece[1:]) + net.bias, 0)
        total += pooled.sum(axis=0, dtype=np.float64)
        most = np.maximum(most, pooled.max(axis=0, initial=-np.inf))
    joined = np.concatenate([(total / (pieces - 1)).astype(np.float32), most])
    return float(np.tanh(joined @ net.hidden + net.hidden_bias) @ net.out + net.out_bias[0])


def probabilities(net: Network, texts: list[bytes], run: int = RUN) -> np.ndarray:
    """The network's probability for each whole text; memory does not depend on the length of a text."""
    logits = np.empty(len(texts))
    for start, end in slices(texts, run):
        long = {i for i in range(start, end) if len(texts[i]) > max(run, 2 * PIECE)}
        for i in long:
            logits[i] = _logit_of_runs(net, texts[i], run)
        others = [i for i in range(start, end) if i not in long]
        if others:
            logits[others] = _forward(net, [texts[i] for i in others]).logits
    return 1 / (1 + np.exp(-logits))


def _gradients(net: Network, texts: list[bytes], labels: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross entropy with respect to every weight."""
    p = _forward(net, texts)
    error = ((1 / (1 + np.exp(-p.logits)) - labels) / len(texts)).astype(np.float32)
    out, out_bias = p.middle.T @ error, error.sum(keepdims=True)
    back = np.outer(error, net.out) * (1 - p.middle**2)
    hidden, hidden_bias = p.texts.T @ back, back.sum(axis=0)
    to_text = back @ net.hidden.T
    # through the mean and the maximum over a text's chunks
    counts = np.diff(np.append(p.chunk_of, len(p.pooled)))
    owner = np.repeat(np.arange(len(texts)), counts)
    to_chunk = (to_text[:, :FILTERS] / counts[:, None])[owner]
    # neighbours share a piece and often its maximum: the first of equal chunks learns
    place = np.where(p.pooled == p.texts[:, FILTERS:][owner], np.arange(len(owner))[:, None], len(owner))
    is_most = place == np.minimum.reduceat(place, p.chunk_of)[owner]
    to_chunk = to_chunk + np.where(is_most, to_text[:, FILTERS:][owner], 0)
    to_chunk = np.where(p.pooled > 0, to_chunk, 0)
    # through the maximum over a chunk's windows: only the best window learns
    per = PIECE // STEP
    cut = p.answers.reshape(-1, per, FILTERS)
    best = cut.argmax(axis=1)
    value = np.take_along_axis(cut, best[:, None, :], axis=1)[:, 0, :]
    first, second = p.chunks
    winner = np.where(value[first] >= value[second], first[:, None], second[:, None])
    window = winner * per + best[winner, np.arange(FILTERS)]
    at, which = np.nonzero(to_chunk)
    weight, place = to_chunk[at, which].astype(np.float32), window[at, which]
    steps = p.codes.reshape(-1, STEP)
    seen = np.concatenate([steps[place], steps[np.minimum(place + 1, len(steps) - 1)]], axis=1)  # rows x WIDTH
    embedded = net.embed[seen].reshape(len(place), -1)
    filters = np.zeros_like(net.filters)
    embed = np.zeros_like(net.embed)
    for f in range(FILTERS):
        mine = which == f
        filters[:, f] = weight[mine] @ embedded[mine]
        flow = np.outer(weight[mine], net.filters[:, f]).reshape(-1, EMBEDDED)
        letters = seen[mine].reshape(-1)
        for d in range(EMBEDDED):
            embed[:, d] += np.bincount(letters, weights=flow[:, d], minlength=256)
    return [embed, filters, to_chunk.sum(axis=0), hidden, hidden_bias, out, out_bias]


def fit(texts: list[bytes], labels: list[int], rounds: int = ROUNDS, seed: int = 7) -> Network:
    """Adam over balanced draws. Without rows of both classes the output is the constant class share."""
    net, draw = Network.fresh(seed), np.random.default_rng(seed)
    y = np.asarray(labels, dtype=np.float32)
    classes = [np.flatnonzero(y == c) for c in (0, 1)]
    if not all(map(len, classes)):
        share = float(y.mean()) if len(y) else 0.5
        net.out[:] = 0
        net.out_bias[:] = np.log((share + 0.05) / (1.05 - share))
        return net
    first, second = [np.zeros_like(w) for w in net.parts()], [np.zeros_like(w) for w in net.parts()]
    for t in range(1, rounds + 1):
        rows = np.concatenate([draw.choice(c, BATCH // 2) for c in classes])
        grads = _gradients(net, [texts[i] for i in rows], y[rows])
        rate = RATE * min(1.0, 2 * (1 - t / (rounds + 1)))
        for w, g, m, v in zip(net.parts(), grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6)).astype(np.float32)
    return net


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    rows_per_class: int = ROWS_PER_CLASS,
    longest: int = LONGEST,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> tuple[list[bytes], list[int]]:
    """At most ``rows_per_class`` whole texts of each class, in the order of a hash of the key.

    Only keys are chosen first, from the small columns; their bounded list selects the
    texts, so no text is shuffled. Texts over ``longest`` bytes are not learned from.
    """
    known = labels.select(F.col(key), F.col(label)).where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & usable)
    chosen = None
    for value in (0, 1):
        top = known.where(F.col(label) == value).orderBy(F.xxhash64(key), key).limit(rows_per_class)
        chosen = top if chosen is None else chosen.unionByName(top)
    keys = {r[0]: r[1] for r in chosen.collect()}
    if not keys:
        return [], []
    spark = docs.sparkSession
    picked = spark.createDataFrame(list(keys.items()), f"__key {docs.schema[key].dataType.simpleString()}, __label int")
    read = docs.select(key, text).where(F.octet_length(text).between(1, longest))
    found = read.join(F.broadcast(picked), F.col(key) == F.col("__key")).select("__key", "__label", text)
    rows = sorted(found.toArrow().to_pylist(), key=lambda r: (str(r["__key"]), r[text]))
    return [r[text].encode() for r in rows], [r["__label"] for r in rows]


SCORED = T.StructType([T.StructField("score", T.DoubleType(), False)])


def score(docs: DataFrame, net: Network, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability that a whole text is good.

    Only the text goes in. Null and empty texts are one piece of zeros and get the
    same score; repeated rows get equal scores; a column named ``score`` is replaced;
    an empty table stays empty. Texts of any length are cut into overlapping chunks, a
    quarter of a megabyte at a time, also within one text; the network is of fixed size.
    """

    def make() -> Callable[[list[bytes]], list[list]]:
        return lambda texts: [probabilities(net, texts).tolist()]

    return with_columns(docs, text, SCORED, make, frugal=True)


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the key modulo 5 is 0. False without a key."""
    return F.coalesce(crc_mod(F.col(key), 5) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Network:
    """Fit on balanced draws of the sample, then shift the output to the share of the classes in all labels."""
    usable = crc_mod(F.col("doc_id"), 5) != 0
    net = fit(*labelled_sample(docs, labels, usable))
    counted = labels.where(usable & F.col("quality").isin(0, 1)).groupBy("quality").count().collect()
    counts = {r["quality"]: r["count"] for r in counted}
    if len(counts) == 2:
        net.out_bias += np.float32(np.log(counts[1] / counts[0]))
    return net
