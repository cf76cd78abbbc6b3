"""What the operators of this folder share: words, byte slices, row-wise Arrow maps."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Words are runs of anything but ASCII white space; ``bytes.split()`` splits at the same bytes.
SPACES = r"[\x20\x09-\x0D]+"

#: Bytes of text that a task turns into results at a time; rows that a frugal one takes out of a batch at a time.
SLICE, FEW_ROWS = 4 << 20, 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Words of a text as a long; 0 for null and blank texts."""
    parts = F.split(F.regexp_replace(text, rf"^{SPACES}", ""), SPACES)
    return F.coalesce(F.size(F.filter(parts, lambda w: w != "")), F.lit(0)).cast("long")


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key written as text, modulo n; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(n)


def splitmix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (Steele, Lea and Flood's SplitMix64) over an array."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes together, for bounded memory."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def release() -> None:
    """Give memory that is no longer used back to the system: at a task's end, as workers stay and serve other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for mapInArrow, with ``release`` after its last batch."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs begun inside pass at most ``rows`` rows at a time to Python and back, so that rows may be wide."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts of a batch in UTF-8; null is empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def with_columns(
    df: DataFrame,
    text: str,
    added: T.StructType,
    make: Callable[[], Callable[[list[bytes]], list[list]]],
    frugal: bool = False,
) -> DataFrame:
    """Append columns that are functions of one text column, in Arrow batches and without a shuffle.

    ``make`` runs once per task and returns a function from texts to one list per
    added column. Columns of ``df`` whose names clash with added ones are replaced.
    ``frugal`` tasks hold the texts of a few rows at a time and give memory back: Arrow's after
    every few rows, as its pool keeps what was freed, and all at the end.
    """
    names = {f.name.lower() for f in added}
    kept = df.drop(*[c for c in df.columns if c.lower() in names and c != text])
    if text.lower() in names:
        raise ValueError(f"the added columns would replace the text column {text}")
    schema = T.StructType([*kept.schema.fields, *added.fields])
    kinds = [f.type for f in to_arrow_schema(added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for whole in batches:
            rows = FEW_ROWS if frugal else max(whole.num_rows, 1)
            for i in range(0, whole.num_rows, rows):
                yield from added_to(function, whole.slice(i, rows))
                if frugal:
                    pa.default_memory_pool().release_unused()

    def added_to(function: Callable[[list[bytes]], list[list]], batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = texts_of(batch, text)
        for start, end in slices(texts, SLICE):
            made = function(texts[start:end])
            new = [pa.array(v, type=k) for v, k in zip(made, kinds, strict=True)]
            old = batch.slice(start, end - start).columns
            yield pa.RecordBatch.from_arrays([*old, *new], names=schema.names)

    return kept.mapInArrow(releasing(run) if frugal else run, schema)
