"""The stages one after the other, each against what it should have kept."""

from __future__ import annotations

import hashlib

import duckdb
import pyarrow as pa
from pyspark.sql import types as T

import corpus_pipeline
from check import canonical, same
from ticketloom.llm import bpe, common, queries, secrets
from ticketloom.llm.common import FEW_ROWS
from ticketloom.llm.components import Stash

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    stash = Stash(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, states = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        states.append(stash.put(stage(spark, states[-1], SF), "stage"))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert states[-1].columns == columns, name
    raw, good, single, clean, mixed, tokens = [s.toPandas() for s in states]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = set(good.doc_id)
    right = [(i in kept) == bool(q) for i, q in labels.items()]
    assert sum(right) / len(right) > 0.9
    assert set(single.doc_id) <= kept and len(single) == single.doc_id.nunique()
    from test_pairs import brute_jaccard

    _, roots = brute_jaccard(dict(zip(good.doc_id, good.text, strict=True)), 5, 80)
    assert set(single.doc_id) == set(roots.values())
    assert list(clean.doc_id.sort_values()) == list(single.doc_id.sort_values())
    assert set(mixed.doc_id) <= set(clean.doc_id) and mixed.doc_id.value_counts().max() <= 3
    assert list(tokens.doc_id.sort_values()) == list(mixed.doc_id.sort_values())
    assert (tokens.tokens.map(len) == 4 * tokens.n_tokens).all()


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


def test_mixing_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    mine, theirs = queries.op3(spark, SF).toPandas(), con.execute(queries.ORACLES["op3_mix_sources"]).df()
    assert same(canonical(mine), canonical(theirs)) is None


def test_encoding_gives_python_few_rows_at_a_time(spark, monkeypatch):
    """The JVM buffers a batch beside its heap, so that batches of 10,000 texts take much of an executor."""

    def sizes(batches):
        for batch in batches:
            n = batch.num_rows
            made = [pa.array([b"\0\0\0\0"] * n, pa.binary()), pa.array([str(n)] * n)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "tokens", "decoded"])

    def counted(docs, vocabulary):
        return docs.mapInArrow(sizes, T.StructType([*docs.schema.fields, *bpe.CODED.fields]))

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    monkeypatch.setattr(bpe, "encode_and_decode", counted)
    docs = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "'en' AS lang", "'a' AS source", "'b c' AS text")
    rows = corpus_pipeline.as_tokens(spark, docs, SF).collect()
    few = {hashlib.sha256(str(n).encode()).hexdigest() for n in range(1, FEW_ROWS + 1)}
    assert sorted(r["doc_id"] for r in rows) == list(range(2000)) and {r["n_tokens"] for r in rows} == {1}
    assert {r["decoded_sha256"] for r in rows} <= few
    assert spark.conf.get(name) == before


def test_redaction_holds_the_texts_of_few_rows_at_a_time(spark, monkeypatch):
    def scanner():
        return lambda texts: [[[{"kind": "hex", "start": 0, "end": len(texts)}] for _ in texts]]

    monkeypatch.setattr(secrets, "_scanner", scanner)
    docs = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "repeat('x', 2000) AS text")
    left = [len(r["text"]) - len("[SECRET]") for r in secrets.redact_secrets(docs).collect()]
    assert len(left) == 2000 and max(2000 - n for n in left) <= FEW_ROWS


def test_frugal_tasks_return_arrow_memory_after_every_few_rows(monkeypatch):
    """Arrow's pool keeps what was freed, and a Python worker with it."""
    released, pool = [], pa.default_memory_pool()

    class Pool:
        def release_unused(self):
            released.append(1)
            pool.release_unused()

    class Rows:
        columns, schema = ["text"], T.StructType([T.StructField("text", T.StringType())])

        def drop(self, *names):
            return self

        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    added = T.StructType([T.StructField("n", T.LongType(), False)])
    run = common.with_columns(Rows(), "text", added, lambda: lambda texts: [[len(t) for t in texts]], frugal=True)
    batch = pa.RecordBatch.from_arrays([pa.array(["ab"] * (2 * FEW_ROWS + 1))], names=["text"])
    made = list(run(iter([batch])))
    assert [b.num_rows for b in made] == [FEW_ROWS, FEW_ROWS, 1] and sum(map(sum, (b["n"].to_pylist() for b in made))) == 2 * batch.num_rows
    assert len(released) == 4  # and once at the end
