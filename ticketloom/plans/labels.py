"""Queries over raters, mappings, splits, samples and versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketloom.operators import raters, registry, sampling
from ticketloom.plans.registry import query
from ticketloom.plans.views import (
    LANGS,
    RATERS,
    RATINGS,
    VERSIONS,
    broken_ratings,
    r6,
    ratings,
    table,
    u_sql,
    versions,
)

PAIRS = "pairs AS (SELECT a.item, a.rater AS rater_a, b.rater AS rater_b, a.queue AS qa, b.queue AS qb FROM ratings a JOIN ratings b ON a.item = b.item AND a.rater < b.rater)"


def _wide(spark, sf):
    return raters.wide_ratings(ratings(spark, sf), RATERS)


MISS = u_sql("miss", "(item || '|' || rater)")
UNK = u_sql("unk", "(item || '|' || rater)")


@query(
    "j05_sheet_problems",
    f"""WITH {RATINGS} SELECT item, rater, CASE WHEN {MISS} < 0.01 THEN 'missing' ELSE 'unknown queue unknown' END AS problem
    FROM ratings WHERE {MISS} < 0.01 OR {UNK} < 0.01""",
)
def _(spark, sf):
    items = table(spark, sf, "documents").select(F.col("doc_id").alias("item"))
    return raters.sheet_problems(items, broken_ratings(spark, sf), RATERS, LANGS)


@query(
    "j06_rater_pairs",
    f"""WITH {RATINGS}, {PAIRS} SELECT rater_a, rater_b, count(*) AS items, count(*) FILTER (qa = qb) AS agree
    FROM pairs GROUP BY 1, 2""",
)
def _(spark, sf):
    return raters.pair_agreement(_wide(spark, sf), RATERS)


@query(
    "a17_cohen_kappa",
    f"""WITH {RATINGS}, {PAIRS}, po AS (SELECT rater_a, rater_b, count(*) AS n, avg(CASE WHEN qa = qb THEN 1.0::DOUBLE ELSE 0 END) AS po
    FROM pairs GROUP BY 1, 2), m AS (SELECT rater, queue, count(*)::DOUBLE AS c FROM ratings GROUP BY 1, 2),
    pe AS (SELECT rater_a, rater_b, n, po, (SELECT sum(x.c * y.c) FROM m x JOIN m y ON x.queue = y.queue
      WHERE x.rater = rater_a AND y.rater = rater_b) / (n::DOUBLE * n) AS pe FROM po)
    SELECT rater_a, rater_b, n AS items, round((po - pe) / (1 - pe), 6) AS kappa FROM pe""",
)
def _(spark, sf):
    rows = raters.cohen_kappa(_wide(spark, sf), RATERS)
    return rows.select("rater_a", "rater_b", "items", r6("kappa").alias("kappa"))


@query(
    "a18_fleiss_kappa",
    f"""WITH {RATINGS}, c AS (SELECT item, queue, count(*)::DOUBLE AS n FROM ratings GROUP BY 1, 2),
    p AS (SELECT item, (sum(n * n) - 4) / 12 AS p FROM c GROUP BY item), s AS (SELECT count(*) AS items, avg(p) AS po FROM p),
    e AS (SELECT sum(pow(t / (SELECT items * 4 FROM s), 2)) AS pe FROM (SELECT queue, sum(n) AS t FROM c GROUP BY queue))
    SELECT items, round((po - pe) / (1 - pe), 6) AS fleiss_kappa FROM s, e""",
)
def _(spark, sf):
    return raters.fleiss_kappa(_wide(spark, sf), RATERS, LANGS).select("items", r6("fleiss_kappa").alias("fleiss_kappa"))


@query(
    "a19_dispute_counts",
    f"""WITH {RATINGS}, d AS (SELECT item, count(DISTINCT queue) AS k FROM ratings GROUP BY item)
    SELECT count(*) AS items, count(*) FILTER (k = 1) AS unanimous, count(*) FILTER (k > 1) AS disputed FROM d""",
)
def _(spark, sf):
    return raters.dispute_counts(_wide(spark, sf), RATERS)


@query(
    "a19_disputed_ratings",
    f"""WITH {RATINGS} SELECT item, rater, queue FROM ratings
    WHERE item IN (SELECT item FROM ratings GROUP BY item HAVING count(DISTINCT queue) > 1)""",
)
def _(spark, sf):
    return raters.disputed_ratings(_wide(spark, sf), RATERS)


@query(
    "w03_majority_vote",
    f"""WITH {RATINGS}, v AS (SELECT item, queue, count(*) AS n FROM ratings GROUP BY 1, 2),
    r AS (SELECT *, rank() OVER (PARTITION BY item ORDER BY n DESC) AS rk FROM v),
    t AS (SELECT item, min(queue) AS queue, count(*) AS k FROM r WHERE rk = 1 GROUP BY item)
    SELECT t.item, CASE WHEN k = 1 THEN t.queue ELSE a.queue END AS queue FROM t JOIN ratings a ON a.item = t.item AND a.rater = 'author'""",
)
def _(spark, sf):
    return raters.majority_vote(_wide(spark, sf), RATERS, "author", LANGS)


U42 = u_sql("42", "doc_id")


@query(
    "w01_annotation_sheet",
    f"""WITH r AS (SELECT source, text, row_number() OVER (PARTITION BY source ORDER BY {U42}, doc_id) AS rn FROM documents)
    SELECT source AS intent, max(text) FILTER (rn = 1) AS example_1, max(text) FILTER (rn = 2) AS example_2,
    max(text) FILTER (rn = 3) AS example_3, '' AS queue FROM r WHERE rn <= 3 GROUP BY source""",
)
def _(spark, sf):
    return sampling.annotation_sheet(table(spark, sf, "documents"), "source", "text", "doc_id")


@query(
    "w02_stratified_split",
    f"""WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {U42}, doc_id) AS rn,
    count(*) OVER (PARTITION BY lang) AS n FROM documents)
    SELECT doc_id, lang, CASE WHEN rn <= floor(n * 0.2::DOUBLE + 0.5::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM r""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return sampling.stratified_split(docs, "lang", "doc_id", 0.2)


@query("o04_seeded_sample", f"SELECT doc_id, lang FROM documents ORDER BY {U42}, doc_id LIMIT 150")
def _(spark, sf):
    return sampling.sample_rows(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 150)


@query("o05_seeded_shuffle", "SELECT doc_id, lang, n_chars FROM documents")
def _(spark, sf):
    return sampling.shuffle_rows(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "doc_id")


@query(
    "o02_key_order",
    """SELECT DISTINCT CASE WHEN CAST(replace(source, 'src', '') AS INT) % 2 = 0 THEN upper(source) ELSE source END AS intent
    FROM documents ORDER BY lower(intent), intent""",
)
def _(spark, sf):
    number = F.replace("source", F.lit("src"), F.lit("")).cast("int")
    shown = F.when(number % 2 == 0, F.upper("source")).otherwise(F.col("source"))
    names = table(spark, sf, "documents").select(shown.alias("intent")).distinct()
    return sampling.by_name(names, "intent")


REPLAY = f"""{VERSIONS}, o AS (SELECT *, CASE WHEN lag(data_source) OVER w = data_source THEN 0 ELSE 1 END AS start_ FROM versions
  WINDOW w AS (PARTITION BY model ORDER BY version)),
g AS (SELECT *, CAST(sum(start_) OVER (PARTITION BY model ORDER BY version) AS BIGINT) AS segment FROM o),
replay AS (SELECT model, version, f1_macro, accuracy, data_source, segment, max(f1_macro) OVER (PARTITION BY model, segment
  ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS incumbent_metric FROM g)"""


@query("w04_promotion_replay", f"WITH {REPLAY} SELECT *, incumbent_metric IS NULL OR f1_macro > incumbent_metric AS promoted FROM replay")
def _(spark, sf):
    return registry.promotion_replay(versions(spark, sf))


@query(
    "w04_production_version",
    f"""WITH {REPLAY} SELECT model, max(version) AS production_version FROM replay
    WHERE incumbent_metric IS NULL OR f1_macro > incumbent_metric GROUP BY model""",
)
def _(spark, sf):
    return registry.production_version(registry.promotion_replay(versions(spark, sf)))


@query(
    "w05_latest_version",
    f"""WITH {VERSIONS} SELECT model, CAST(max(version) AS BIGINT) AS latest_version, arg_max(f1_macro, version) AS f1_macro
    FROM versions GROUP BY model""",
)
def _(spark, sf):
    as_text = versions(spark, sf).withColumn("version", F.col("version").cast("string"))
    return registry.latest_version(as_text)
