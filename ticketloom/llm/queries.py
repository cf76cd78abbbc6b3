"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm import (
    bpe,
    divergence,
    jaccard,
    langid,
    mixing,
    packing,
    polytope,
    quality,
    secrets,
    slots,
    trie,
    vamana,
    warc,
)
from ticketloom.llm.common import table
from ticketloom.llm.components import Stash
from ticketloom.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer files of this installation lie."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op1_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, net).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= quality.KEEP_AT, 1).otherwise(0).alias("predicted"),
    )


@query("op2_divergence")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return divergence.judge(docs, Stash(spark)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "nearest",
        "char_distance",
        "word_distance",
        "all_words_distance",
    )


@query("op4_language")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = langid.train(docs)
    found = langid.identify(docs.select("doc_id", "text"), trees)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


_UNIFORM = "(CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE)"

MIXED_SQL = f"""sized AS (
  SELECT *, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, source_size * 3 AS most,
  ([5, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM sources),
placed AS (SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS place FROM weighed),
shared AS (SELECT *,
  (SELECT sum(source_size) FROM sources)
    - coalesce(sum(most) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
  (SELECT sum(weight) FROM weighed)
    - coalesce(sum(weight) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS heads
  FROM placed),
first_free AS (SELECT remaining, heads FROM shared WHERE most * heads >= remaining * weight ORDER BY place LIMIT 1),
aimed AS (SELECT source, source_size,
  round(least(CAST(most AS DOUBLE), coalesce(
    (SELECT CAST(remaining AS BIGINT) * CAST(s.weight AS BIGINT) / CAST(heads AS BIGINT) FROM first_free),
    CAST(most AS DOUBLE))), 6) AS target FROM shared s),
rated AS (SELECT d.*, a.source_size, a.target,
  CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0 END AS rate
  FROM sized d JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source),
mixed AS (SELECT *, CAST(floor(rate) AS BIGINT)
  + CASE WHEN {_UNIFORM} < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM rated)"""


@query("op3_mix_sources", f"WITH {MIXED_SQL} SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return planned.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


@query("op5_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary_path()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_and_decode(docs, path).select(
        "doc_id",
        (F.octet_length("tokens") / 4).cast("long").alias("n_tokens"),
        F.sha2("tokens", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op6_secrets")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = list(secrets.KINDS[:3])

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def counted(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[counted(k) for k in base],
        F.sha2(written(F.filter("secrets", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        written(F.col("secrets")).alias("spans"),
    )


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = packing.read_ranks(vocabulary_path("byte_bpe_50k.tiktoken"))
    encoder = packing.ranked_encoder(ranks, public_tokenizers.PATTERN)
    path = fresh_path(spark, "packs")
    packing.write_matrices(packing.pack(table(spark, sf_dir, "documents"), encoder, len(ranks)), path)
    return spark.read.schema(packing.PACK_SCHEMA).parquet(path).select(
        "shard",
        "pack",
        "n_tokens",
        "n_segments",
        "doc_ids",
        "doc_offsets",
        "cu_seqlens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("positions", 256).alias("positions_sha256"),
    )


@query("op8_jaccard_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op9_near_vectors")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polytope.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP10_SQL = """WITH paid AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
hashed AS (SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
  from_hex(sha1(payload)) AS raw, sha1(payload) AS hex FROM paid),
digested AS (SELECT page_id, payload_bytes, hex,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    (CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)),
    'string_agg', '') AS payload_digest FROM hashed),
best AS (SELECT hex, max(page_id) AS best FROM digested GROUP BY hex)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
  CASE WHEN d.page_id IS DISTINCT FROM b.best AND b.best IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN d.page_id IS DISTINCT FROM b.best THEN b.best END AS refers_to
FROM digested d JOIN best b USING (hex)"""


@query("op10_warc", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    warc.register(spark)
    path = fresh_path(spark, "archive")
    warc.archive_pages(table(spark, sf_dir, "pages"), path)
    records = spark.read.format("warc").option("payload", "false").option("verify", "true").load(path)
    key = F.regexp_extract("record_id", r"^<urn:record:(\d+|-\d+)>$", 1).try_cast("long")
    return records.where(F.col("record_type").isin("response", "revisit")).select(
        key.alias("page_id"),
        F.col("payload_length").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        "record_type",
        F.regexp_extract("refers_to", r"^<urn:record:(-?\d+)>$", 1).try_cast("long").alias("refers_to"),
    )


@query("op11_graph_search")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vamana.nearest_neighbours(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id % 20 = 0")


OP12_SQL = f"""WITH bits AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs),
ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % {trie.FAMILY} AS base,
  xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
    lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), CAST(i AS INTEGER), 1)) AS BIGINT))),
    lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) % {trie.HEADS + 1} AS h FROM ids, bits),
turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
  md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
built AS (SELECT c.conv_id, 0 AS part, pos, k, w FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL SELECT c.conv_id, 1, pos, k, w FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h),
seqs AS (SELECT c.conv_id, coalesce(list(k ORDER BY part, pos) FILTER (k IS NOT NULL), []) AS ks,
  coalesce(list(w ORDER BY part, pos) FILTER (k IS NOT NULL), []) AS ws FROM convs c LEFT JOIN built b ON b.conv_id = c.conv_id
  GROUP BY c.conv_id),
prefixes AS (SELECT conv_id, d, array_to_string(ks[1:d], ',') AS p, array_to_string(ks[1:d - 1], ',') AS up,
  len(ks) = d AS ends, CASE WHEN d = 0 THEN 0 ELSE ws[d] END AS w FROM (SELECT *, unnest(range(0, len(ks) + 1)) AS d FROM seqs)),
nodes AS (SELECT d, p, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, max(w) AS w,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM prefixes GROUP BY d, p),
kids AS (SELECT d - 1 AS d, up AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1, 2),
told AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (d, p)),
sums AS (SELECT q.d, q.p, CAST(sum((t.n_convs - 1) * t.w) AS BIGINT) AS saved_tokens, count(*) FILTER (t.n_children = 0) AS n_leaves
  FROM told t JOIN prefixes q ON q.conv_id = t.conv_id AND q.d <= t.d GROUP BY 1, 2)
SELECT t.conv_id, t.d AS depth, u.conv_id AS parent_conv_id, t.n_convs, t.n_children, s.n_leaves, s.saved_tokens, t.ends_sha256
FROM told t JOIN sums s USING (d, p) LEFT JOIN nodes u ON t.d > 0 AND u.d = t.d - 1 AND u.p = t.up"""


@query("op12_conversation_trie", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


OP13_SQL = f"""WITH kept AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor({slots.SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT a.vec_id AS anchor_id, e.vec_id, a.label = e.label AS same, CAST(list_dot_product(a.v, e.v) AS BIGINT) AS score
  FROM kept a JOIN kept e ON a.vec_id % 100 = 0 AND a.vec_id <> e.vec_id AND len(a.v) = len(e.v)),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {slots.POSITIVES}),
windows AS (SELECT p.*, n.vec_id AS negative_id, n.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND {slots.LOW} * positive_score <= 100 * n.score AND 100 * n.score <= {slots.HIGH} * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM windows WHERE rank <= {slots.NEGATIVES}"""


@query("op13_hard_negatives", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return slots.hard_negatives(rows.withColumn("label", moved), "vec_id % 100 = 0")
