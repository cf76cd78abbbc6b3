"""Token-id output: best-fit-decreasing packing into rows of equal length."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.common import texts_of

Encoder = Callable[[bytes], np.ndarray]

#: Ids in a row of a matrix, and ids that a task holds before it packs them.
LENGTH, HELD = 2048, 1 << 20
#: Rows of a batch that are taken out of it at a time.
ROWS = 500

PACK_SCHEMA = (
    "shard int, pack long, n_tokens long, n_segments int, doc_ids array<long>, doc_offsets array<long>, "
    "cu_seqlens array<int>, ids binary, positions binary"
)


_TOOLS: dict[str, tiktoken.Encoding] = {}


def ranked_encoder(ranks: dict[bytes, int], pattern: str) -> Callable[[], Encoder]:
    """What makes an encoder of a byte-level vocabulary in a task; special strings are ordinary text."""

    name = hashlib.sha256(repr((pattern, sorted(ranks.items()))).encode()).hexdigest()

    def make() -> Encoder:
        # one tool for all tasks of a Python worker
        if name not in _TOOLS:
            _TOOLS.clear()
            _TOOLS[name] = tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        tool = _TOOLS[name]
        return lambda text: np.array(tool.encode_ordinary(text.decode()), np.uint32)

    return make


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of lines with a token in base64 and its rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


class CapacityTree:
    """A segment tree over room left: how many open rows have each room, and the least room that is enough."""

    def __init__(self, length: int) -> None:
        self.leaves = 1 << length.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, room: int, change: int) -> None:
        at = room + self.leaves
        while at:
            self.counts[at] += change
            at >>= 1

    def least_from(self, room: int) -> int:
        """The least room of this size or more that an open row has; -1 if there is none."""
        at = room + self.leaves
        if self.counts[at]:
            return room
        while at > 1:
            if not at & 1 and self.counts[at + 1]:  # what lies right of a left child is larger
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.counts[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return -1


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of places: the longest first, each into the row with the least room that it fits in.

    Ties go to the earlier place and to the row that was opened last; every size is at
    most ``length``.
    """
    tree, open_rows, rows = CapacityTree(length), {}, []
    for place in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        room = tree.least_from(sizes[place])
        if room < 0:
            rows.append([])
            row, room = len(rows) - 1, length
        else:
            row = open_rows[room].pop()
            tree.add(room, -1)
        rows[row].append(place)
        left = room - sizes[place]
        if left:
            open_rows.setdefault(left, []).append(row)
            tree.add(left, 1)
    return rows


def pieces(ids: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, ids) of a document in pieces of at most ``length``; together they are the document."""
    for start in range(0, len(ids), length):
        yield start, ids[start : start + length]


def pack_rows(held: list[tuple[int | None, int, np.ndarray]], length: int, kind: str, pad: int) -> Iterator[dict]:
    """(doc_id, offset, ids) pieces -> rows with the bytes of their ids and positions."""
    for row in best_fit_decreasing([len(p[2]) for p in held], length):
        segments = [held[i] for i in row]
        sizes = [len(s[2]) for s in segments]
        ids = np.full(length, pad, dtype=kind)
        positions = np.zeros(length, dtype="<u2" if length <= 1 << 16 else "<u4")
        ends = np.cumsum([0, *sizes])
        for (_, _, part), start in zip(segments, ends.tolist(), strict=False):
            ids[start : start + len(part)] = part
            positions[start : start + len(part)] = np.arange(len(part))
        yield {
            "n_tokens": int(ends[-1]),
            "n_segments": len(segments),
            "doc_ids": [s[0] for s in segments],
            "doc_offsets": [s[1] for s in segments],
            "cu_seqlens": ends.tolist(),
            "ids": ids.tobytes(),
            "positions": positions.tobytes(),
        }


def pack(
    docs: DataFrame,
    encoder: Callable[[], Encoder],
    vocabulary_size: int,
    length: int = LENGTH,
    held: int = HELD,
    key: str = "doc_id",
    text: str = "text",
    pad: int = 0,
) -> DataFrame:
    """Documents as packed rows of ``length`` ids, one row of the result for each row of the matrices.

    A task encodes its documents, cuts those over ``length`` into pieces without loss,
    and whenever it holds ``held`` ids packs them by best fit decreasing; only its last
    pack of rows may be loose, so nothing is shuffled and memory is bounded. ``ids`` are
    little-endian unsigned integers, of 16 bits if the vocabulary allows, filled up with
    ``pad``; ``cu_seqlens`` are the bounds of the segments in the row, from 0; ``positions``
    (as wide as a row's length needs) begin anew at 0 with each segment. ``shard`` is the
    task's partition.

    Null and empty texts have no ids and are in no row; a null key stays null; repeated
    rows are packed as often as they come; an empty table gives no rows; other columns
    are not read.
    """
    kind = "<u2" if vocabulary_size <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        shard, number = TaskContext.get().partitionId(), 0
        waiting: list[tuple[int | None, int, np.ndarray]] = []
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, waiting, total
            rows = []
            for row in pack_rows(waiting, length, kind, pad):
                rows.append({"shard": shard, "pack": number, **row})
                number += 1
                if len(rows) >= 256:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                    rows = []
            waiting, total = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                rows = batch.slice(start, ROWS)
                for doc, raw in zip(rows.column(0).to_pylist(), texts_of(rows, rows.schema.names[1]), strict=True):
                    for offset, part in pieces(encode(raw).astype(kind), length):
                        waiting.append((doc, offset, part))
                        total += len(part)
                        if total >= held:
                            yield from flush()
        yield from flush()

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, PACK_SCHEMA)


_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("pack", pa.int64()),
        ("n_tokens", pa.int64()),
        ("n_segments", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_offsets", pa.list_(pa.int64())),
        ("cu_seqlens", pa.list_(pa.int32())),
        ("ids", pa.binary()),
        ("positions", pa.binary()),
    ]
)


def write_matrices(packed: DataFrame, path: str) -> None:
    """The packed rows as Parquet files below a new folder ``path``: one file is one matrix, row by row."""
    packed.write.option("compression", "zstd").parquet(path)
