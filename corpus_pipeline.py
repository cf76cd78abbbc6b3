"""A training corpus from raw documents: scored, near copies out, secrets out, mixed, as tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm import bpe, jaccard, mixing, quality, secrets
from ticketloom.llm.common import FEW_ROWS
from ticketloom.llm.components import Stash
from ticketloom.llm.queries import vocabulary_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near copies: shingles of so many words, alike from so many hundredths.
SHINGLE_WORDS, ALIKE = 5, 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on ``labels``, does not reject."""
    net = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs.withColumnRenamed("score", "__score"), net)
    kept = scored.where(F.col("score") >= quality.KEEP_AT).drop("score")
    return kept.withColumnRenamed("__score", "score").select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least doc_id."""
    return jaccard.one_of_each(docs, SHINGLE_WORDS, ALIKE).select(*docs.columns)


def take_secrets_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with a mark in place of each secret."""
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weight of their source asks for."""
    return mixing.mix(docs)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and the digest of the text they decode to.

    Written here, a few rows at a time between the JVM and Python: rows that are passed by
    the thousand stand in buffers beside the heap, which the stages before have filled.
    """
    coded = bpe.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), vocabulary_path())
    rows = coded.select(
        "doc_id",
        "lang",
        "source",
        (F.octet_length("tokens") / 4).cast("long").alias("n_tokens"),
        "tokens",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
    return Stash(spark, FEW_ROWS).put(rows, "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("secret scans", take_secrets_out),
    ("mixing sources", mix_sources),
    ("BPE encoding and decoding", as_tokens),
]

#: The classifier, the join and the tokens have no SQL; the tests hold brute-force versions against the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    stash = Stash(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stash.put(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
