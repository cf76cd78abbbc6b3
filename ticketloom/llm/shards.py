"""Rows in shards of bounded size, each answering a stated set of queries that streams past it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Queries that a shard answers together.
TOGETHER = 512

#: What names a shard: vectors of one length and one kind, in parts.
PLACE = ("size", "band", "part")


def finite(column: pa.Array) -> list[np.ndarray | None]:
    """The vectors of a list column as doubles; None for null ones and those with null or non-finite numbers."""
    column = column.cast(pa.list_(pa.float64()))
    flat = column.values.to_numpy(zero_copy_only=False)  # nulls become NaN
    offsets, valid = column.offsets.to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    sound = valid & (bad[offsets[1:]] == bad[offsets[:-1]])
    return [flat[a:b] if ok else None for a, b, ok in zip(offsets[:-1], offsets[1:], sound, strict=True)]


def usable_vectors(
    rows: DataFrame, key: str, vector: str, change: Callable[[np.ndarray], np.ndarray | None], extra: tuple[str, ...] = ()
) -> DataFrame:
    """(vec_id, extra, size, vector): ``change`` of each finite vector as little-endian doubles, one row for each key.

    Rows are left out that have no key, a vector that is null or holds null or
    non-finite numbers, or one of which ``change`` makes nothing. Of rows with one key
    the least by extra columns and vector stands for all.
    """
    slim = rows.select(F.col(key).cast("long").alias("vec_id"), *extra, F.col(vector).alias("__vector"))
    slim = slim.where(F.col("vec_id").isNotNull() & F.col("__vector").isNotNull())
    schema = T.StructType(
        [*slim.schema.fields[:-1], T.StructField("size", T.IntegerType()), T.StructField("vector", T.BinaryType())]
    )

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [None if v is None else change(v) for v in finite(batch.column(batch.num_columns - 1))]
            kept = pa.array([i for i, v in enumerate(made) if v is not None], pa.int64())
            made = [v for v in made if v is not None]
            yield pa.RecordBatch.from_arrays(
                [
                    *[c.take(kept) for c in batch.columns[:-1]],
                    pa.array([len(v) for v in made], pa.int32()),
                    # -0.0 is written as 0.0, so that equal vectors are equal bytes
                    pa.array([(v + 0.0).astype("<f8").tobytes() for v in made], pa.binary()),
                ],
                names=schema.names,
            )

    least = F.min(F.struct(*extra, "size", "vector")).alias("least")
    return slim.mapInArrow(written, schema).groupBy("vec_id").agg(least).select("vec_id", "least.*")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length, written as bytes, as rows."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)


def parts_of(rows: DataFrame, most: int) -> DataFrame:
    """(size, band, parts): in how many parts the rows of each length and band are dealt, of ``most`` rows on average."""
    return rows.groupBy("size", "band").agg(F.ceil(F.count(F.lit(1)) / F.lit(most)).cast("int").alias("parts"))


def dealt(rows: DataFrame, parts: DataFrame, by: str) -> DataFrame:
    """``rows`` with their ``part``, by a hash of a column."""
    part = F.pmod(F.xxhash64(by), F.col("parts")).cast("int")
    return rows.join(parts, ["size", "band"]).withColumn("part", part).drop("parts")


def answers(
    shards: DataFrame,
    queries: DataFrame,
    parts: DataFrame,
    make: Callable[[pa.Table], Any],
    answer: Callable[[Any, pa.RecordBatch], dict[str, list]],
    schema: str,
) -> DataFrame:
    """Every query past every shard of its length.

    ``shards`` (size, band, part, ...) and ``queries`` (size, ...) go to one place per
    shard: the rows of the shard come first and ``make`` turns them into what is kept;
    the queries follow and are answered at most TOGETHER at a time. So a task holds one
    shard and a few queries, whatever their number.
    """
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    asked = queries.join(parts, "size").select(*queries.columns, "band", every)
    both = shards.withColumn("kind", F.lit(0)).unionByName(asked.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    both = both.select(*PLACE, "kind", *[c for c in both.columns if c not in (*PLACE, "kind")])
    kinds = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: tuple | None = None
        held: list[pa.RecordBatch] = []
        made: Any = None
        for batch in batches:
            marks = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), len(marks)]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                if start == end:
                    continue
                if tuple(marks[start, :3]) != place:
                    place, held, made = tuple(marks[start, :3]), [], None
                if marks[start, 3] == 0:
                    held.append(batch.slice(start, end - start))
                    continue
                if made is None and held:
                    made, held = make(pa.Table.from_batches(held)), []
                for first in range(start, end, TOGETHER) if made is not None else ():
                    found = answer(made, batch.slice(first, min(TOGETHER, end - first)))
                    yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in kinds], schema=kinds)

    return both.repartition(*PLACE).sortWithinPartitions(*PLACE, "kind").mapInArrow(run, schema)
