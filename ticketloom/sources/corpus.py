"""Corpus files: CSV in, Parquet from then on."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.operators.mapping import fold, require_mapped
from ticketloom.operators.sampling import sample_rows

CORPUS_SCHEMA = "text string, category string"
MESSAGE_SCHEMA = "text string, label string, language_style string, author string"
CASE_SCHEMA = "kind string, pii string, text string"

# A quote inside a quoted field is doubled, as other tools write it. Line breaks inside
# fields make a file unsplittable, so reading them is asked for by ``multiline``.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, paths: str | list[str], schema: str, multiline: bool = False) -> DataFrame:
    """The columns of ``schema`` by the names in the files' headers, whatever their order.

    Files are read in splits unless ``multiline``; files without a line have no rows. Files with
    different headers are read header by header and put together by name, and then hold the
    columns of ``schema`` only. A file that lacks a column fails by its name.
    """
    kinds = files_by_header(spark, paths)
    if len(kinds) < 2:
        return _read_alike(spark, paths, schema, multiline)
    names = T.StructType.fromDDL(schema).names
    parts = [_read_alike(spark, files, schema, multiline).select(*names, "_metadata") for files in kinds]
    return reduce(DataFrame.union, parts)


def files_by_header(spark: SparkSession, paths: str | list[str]) -> list[list[str]]:
    """The files of each header line, in the order of the lines; blank files have none.

    Every file's first line is found by one scan with a row per file out of it; what comes
    to the driver are names of files, which it lists anyway. One file is not scanned.
    """
    lines = spark.read.text(paths)
    if len(lines.inputFiles()) < 2:
        return []
    at = F.monotonically_increasing_id()
    begun = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", at.alias("at"))
    first = begun.where("block = 0 AND trim(value) != ''").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    found = first.groupBy("header").agg(F.array_sort(F.collect_list("file")).alias("files")).orderBy("header").collect()
    return [[unquote(file) for file in row["files"]] for row in found]


def _read_alike(spark: SparkSession, paths: str | list[str], schema: str, multiline: bool) -> DataFrame:
    """Files that share one header."""
    wanted = T.StructType.fromDDL(schema)
    options = {**CSV_OPTIONS, "multiLine": str(multiline).lower(), "enforceSchema": "false", "mode": "FAILFAST"}
    header = spark.read.options(**{**options, "mode": "PERMISSIVE"}).csv(paths).columns
    missing = [f.name for f in wanted if f.name not in header] if header else []
    if missing:
        raise ValueError(f"missing columns {missing} in {paths}")
    kinds = {f.name: f for f in wanted}
    full = T.StructType([kinds.get(c, T.StructField(c, T.StringType())) for c in header]) if header else wanted
    return spark.read.schema(full).options(**options).csv(paths)


def file_stem() -> Column:
    """Stem of the CSV a row came from: ``x.csv`` or a folder ``x.csv/`` of part files."""
    return F.url_decode(F.regexp_extract("_metadata.file_path", r"([^/]+?)\.csv(?:/part-[^/]*)?$", 1))


def scan_corpus(
    spark: SparkSession, paths: list[str], schema: str = CORPUS_SCHEMA, multiline: bool = False
) -> DataFrame:
    """All files in one scan, each row tagged with its file's stem as ``split``."""
    names = T.StructType.fromDDL(schema).names
    return read_csv(spark, paths, schema, multiline).select(*names, file_stem().alias("split"))


def load_labelled(
    spark: SparkSession,
    paths: list[str],
    mapping: DataFrame,
    n_samples: int | None = None,
    seed: int = 42,
    multiline: bool = False,
) -> DataFrame:
    """(text, label, intent, split): the corpus folded onto queues, optionally a seeded sample.

    An intent the mapping does not know fails the load.
    """
    rows = scan_corpus(spark, paths, multiline=multiline).withColumnRenamed("category", "intent")
    require_mapped(rows, mapping, "intent")
    labelled = fold(rows, mapping, "intent", "label").select("text", "label", "intent", "split")
    if n_samples is None:
        return labelled
    key = F.sha2(F.concat_ws("\x1f", "split", "intent", "text"), 256)
    return sample_rows(labelled.withColumn("_id", key), "_id", n_samples, seed).drop("_id")


def scan_text(spark: SparkSession, path: str | list[str], schema: str, multiline: bool = False) -> DataFrame:
    """A CSV whose columns are all text; missing fields become empty strings."""
    return read_csv(spark, path, schema, multiline).select(*T.StructType.fromDDL(schema).names).na.fill("")


def scan_sheets(spark: SparkSession, directory: str) -> DataFrame:
    """Every rater's sheet in a folder: (rater, item, queue), the stem names the rater."""
    rows = read_csv(spark, f"{directory}/*.csv", "intent string, queue string")
    queue = F.lower(F.trim(F.coalesce("queue", F.lit(""))))
    return rows.select(file_stem().alias("rater"), F.col("intent").alias("item"), queue.alias("queue"))


def write_csv(df: DataFrame, path: str) -> None:
    """Every field quoted; a file whose fields hold line breaks is read back with ``multiline``."""
    df.write.options(**CSV_OPTIONS).option("quoteAll", "true").csv(path)


def write_splits(df: DataFrame, path: str) -> None:
    """One Parquet dataset partitioned by ``split``."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One side; only its folder is listed and read."""
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def official_split(df: DataFrame, side: str) -> DataFrame:
    if "split" not in df.columns:
        raise ValueError("the official split needs a split column; use the random split instead")
    return df.where(F.col("split") == side).drop("split")
