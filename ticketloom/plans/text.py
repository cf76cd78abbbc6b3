"""Queries over texts: cleaning, admission, redaction, tokens, files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketloom.functions import text as tx
from ticketloom.functions.hashing import pick, uniform
from ticketloom.functions.statistics import safe_ratio
from ticketloom.operators import features, pii, synthetic, validation
from ticketloom.plans.registry import query
from ticketloom.plans.views import (
    CASES,
    LANGS,
    RATERS,
    RATINGS,
    SLICES,
    W,
    balanced,
    clean_sql,
    pick_sql,
    pii_cases,
    ratings,
    redact_sql,
    table,
    u_sql,
)
from ticketloom.session import fresh_path
from ticketloom.sources import corpus


def _docs(spark, sf, *columns):
    return balanced(table(spark, sf, "documents").select(*columns))


CLEANED = f"cleaned AS (SELECT doc_id, lang, source, text AS raw, {clean_sql('text')} AS text FROM documents)"


@query("p01_clean_text", f"WITH {CLEANED} SELECT doc_id, text FROM cleaned")
def _(spark, sf):
    return _docs(spark, sf, "doc_id", "text").withColumn("text", tx.clean_text(F.col("text")))


# a third of the labels is taken away and some texts are blank, so that rows drop out
@query(
    "p02_drop_empty",
    f"""WITH g AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN ' ' || chr(10) ELSE text END AS text,
    CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END AS label FROM documents)
    SELECT doc_id, {clean_sql('text')} AS text, label FROM g WHERE label IS NOT NULL AND length({clean_sql('text')}) > 0""",
)
def _(spark, sf):
    rows = _docs(spark, sf, "doc_id", "text", "lang").select(
        "doc_id",
        F.when(F.col("doc_id") % 7 == 0, F.lit(" \n")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("label"),
    )
    return validation.prepare(rows)


REASON = f"""CASE WHEN text IS NULL OR length(text) < 1 THEN 'empty' WHEN length(text) > 5000 THEN 'too_long'
  WHEN length({clean_sql('text')}) = 0 THEN 'blank' END"""


@query(
    "p03_admission",
    f"""WITH g AS (SELECT doc_id, CASE doc_id % 11 WHEN 0 THEN '' WHEN 1 THEN '  ' ELSE text END AS text FROM documents)
    SELECT doc_id, coalesce({REASON}, 'accepted') AS outcome FROM g""",
)
def _(spark, sf):
    spoiled = F.when(F.col("doc_id") % 11 == 0, F.lit("")).when(F.col("doc_id") % 11 == 1, F.lit("  "))
    rows = _docs(spark, sf, "doc_id", "text").withColumn("text", F.coalesce(spoiled, F.col("text")))
    accepted, refused = validation.admit(rows, "text")
    return accepted.select("doc_id", F.lit("accepted").alias("outcome")).unionByName(
        refused.select("doc_id", F.col("reason").alias("outcome"))
    )


@query("p04_official_split", "SELECT doc_id, lang AS label FROM documents WHERE doc_id % 4 <> 0")
def _(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("label"), side().alias("split"))
    return corpus.official_split(rows, "train")


@query("p05_normalised", "SELECT doc_id, lang, source FROM documents")
def _(spark, sf):
    padded = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.lit("  "), F.upper("lang")).alias("lang"), F.concat(F.initcap("source"), F.lit(" ")).alias("source")
    )
    return validation.normalise(padded, ["lang", "source"])


@query(
    "p06_row_problems",
    """WITH g AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN '  ' ELSE text END AS text,
    CASE WHEN doc_id % 5 = 0 THEN 'xx' ELSE lang END AS label, source FROM documents)
    SELECT doc_id, array_to_string(list_filter([CASE WHEN trim(text) = '' THEN 'empty text' END,
      CASE WHEN label NOT IN ('de','en','es','fr') THEN 'unknown label ''' || label || '''' END,
      CASE WHEN source NOT IN ('src1','src2','src3') THEN 'unknown source ''' || source || '''' END], lambda x: x IS NOT NULL), '; ')
      AS problems FROM g WHERE trim(text) = '' OR label NOT IN ('de','en','es','fr') OR source NOT IN ('src1','src2','src3')""",
)
def _(spark, sf):
    rows = table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 13 == 0, F.lit("  ")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("doc_id") % 5 == 0, F.lit("xx")).otherwise(F.col("lang")).alias("label"),
        "source",
    )
    checks = {"label": (F.col("label"), LANGS), "source": (F.col("source"), ["src1", "src2", "src3"])}
    bad = validation.invalid_rows(rows, "doc_id", validation.row_problems(F.col("text"), checks))
    return bad.withColumn("problems", F.array_join("problems", "; "))


@query("p07_required_columns", "SELECT doc_id, text, lang AS label FROM documents")
def _(spark, sf):
    rows = table(spark, sf, "documents").withColumnRenamed("lang", "label")
    return validation.require_columns(rows, ["doc_id", "text", "label"]).select("doc_id", "text", "label")


@query("p08_derived_columns", "SELECT doc_id, source AS intent, lang AS label FROM documents")
def _(spark, sf):
    rows = table(spark, sf, "documents").withColumnRenamed("source", "intent").withColumnRenamed("lang", "label")
    return rows.drop("text", "n_chars")


for _rule, _pattern, _token in tx.REDACTION_RULES:
    _number = {"email": 2, "upi": 3, "pan": 4, "ifsc": 5, "number": 6, "fragment": 7}[_rule]

    @query(f"f{_number:02d}_redact_{_rule}", f"WITH {CASES} SELECT doc_id, kind, {redact_sql('text', (_rule,))} AS text FROM cases")
    def _(spark, sf, rule=_rule):
        return balanced(pii_cases(spark, sf)).select("doc_id", "kind", tx.redact_rule(F.col("text"), rule).alias("text"))


@query("f08_redact", f"WITH {CASES} SELECT doc_id, {redact_sql('text')} AS text FROM cases")
def _(spark, sf):
    return balanced(pii_cases(spark, sf)).select("doc_id", tx.redact(F.col("text")).alias("text"))


CAUGHT = f"""{CASES}, vals AS (SELECT kind, unnest(string_split(pii, '|')) AS value, {redact_sql('text')} AS shown FROM cases WHERE kind <> 'none'),
hits AS (SELECT kind, CASE WHEN contains(lower(shown), lower(value)) THEN 0 ELSE 1 END AS hit FROM vals)"""


@query(
    "a16_pii_recall",
    f"""WITH {CAUGHT} SELECT kind, count(*) AS pii_values, round(sum(hit)::DOUBLE / count(*), 4) AS recall FROM hits GROUP BY kind
    UNION ALL SELECT 'overall', count(*), round(sum(hit)::DOUBLE / count(*), 4) FROM hits""",
)
def _(spark, sf):
    return pii.recall_by_kind(balanced(pii_cases(spark, sf)))


@query(
    "p12_untouched",
    f"""WITH {CASES} SELECT count(*) AS pii_free_messages,
    round(count(*) FILTER ({redact_sql('text')} = text)::DOUBLE / count(*), 4) AS untouched FROM cases WHERE kind = 'none'""",
)
def _(spark, sf):
    return pii.untouched_share(balanced(pii_cases(spark, sf)))


WORDS = f"regexp_extract_all(lower(text), '[{W}]{{2,}}')"


@query("f09_tokens", f"SELECT doc_id, len({WORDS}) AS n, array_to_string({WORDS}, ' ') AS words FROM documents")
def _(spark, sf):
    words = _docs(spark, sf, "doc_id", "text").select("doc_id", tx.tokens(F.col("text")).alias("w"))
    return words.select("doc_id", F.size("w").cast("long").alias("n"), F.array_join("w", " ").alias("words"))


GRAMS = f"""words AS (SELECT doc_id, {WORDS} AS w FROM documents),
grams AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM words)"""


@query("f10_ngrams", f"WITH {GRAMS} SELECT doc_id, count(*) AS n, md5(string_agg(term, '|' ORDER BY term)) AS digest FROM grams GROUP BY doc_id")
def _(spark, sf):
    grams = _docs(spark, sf, "doc_id", "text").select("doc_id", tx.terms(F.col("text"), 2).alias("t"))
    sorted_terms = F.array_join(F.sort_array("t"), "|")
    return grams.where(F.size("t") > 0).select("doc_id", F.size("t").cast("long").alias("n"), F.md5(sorted_terms).alias("digest"))


@query("o03_top_terms", f"WITH {GRAMS} SELECT term, count(*) AS n FROM grams GROUP BY term ORDER BY n DESC, term LIMIT 5000")
def _(spark, sf):
    return features.top_terms(features.term_counts(_docs(spark, sf, "text"), "text"))


TEMPLATES = ["the {lang} text from {source}", "{source} again {source} in {lang}", "nothing to fill"]


@query(
    "f11_filled_templates",
    f"""SELECT doc_id, replace(replace({pick_sql(TEMPLATES, u_sql('t', 'doc_id'))}, '{{lang}}', lang), '{{source}}', source) AS text
    FROM documents""",
)
def _(spark, sf):
    rows = table(spark, sf, "documents")
    filled = tx.fill_template(pick(TEMPLATES, uniform("t", "doc_id")), {"lang": F.col("lang"), "source": F.col("source")})
    return rows.select("doc_id", filled.alias("text"))


@query(
    "f12_rounding",
    """SELECT event_id, round(value / 7.0::DOUBLE, 4) AS rounded_4, round(value / 7.0::DOUBLE, 6) AS rounded_6 FROM events""",
)
def _(spark, sf):
    seventh = F.col("value") / F.lit(7.0)
    return table(spark, sf, "events").select("event_id", F.round(seventh, 4).alias("rounded_4"), F.round(seventh, 6).alias("rounded_6"))


@query(
    "f14_split_list",
    f"WITH {CASES} SELECT doc_id, unnest(string_split(pii, '|')) AS value FROM cases",
)
def _(spark, sf):
    return pii_cases(spark, sf).select("doc_id", F.explode(F.split("pii", r"[|]")).alias("value"))


@query("f15_content_digest", "SELECT doc_id, sha256(text) AS digest FROM documents")
def _(spark, sf):
    return _docs(spark, sf, "doc_id", "text").select("doc_id", F.sha2("text", 256).alias("digest"))


@query("f16_json_lines", "SELECT doc_id, text, lang AS label FROM documents")
def _(spark, sf):
    """Every row through a JSON line and back."""
    line = F.to_json(F.struct("text", F.col("lang").alias("label")))
    lines = _docs(spark, sf, "doc_id", "text", "lang").select("doc_id", line.alias("line"))
    back = F.from_json("line", "text string, label string")
    return lines.select("doc_id", back.alias("r")).select("doc_id", "r.text", "r.label")


@query(
    "f17_safe_ratio",
    """SELECT user_id, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'view') AS views,
    round(count(*) FILTER (event_type = 'error')::DOUBLE / nullif(count(*) FILTER (event_type = 'view'), 0), 6) AS ratio
    FROM events GROUP BY user_id""",
)
def _(spark, sf):
    counts = table(spark, sf, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "error").alias("errors"), F.count_if(F.col("event_type") == "view").alias("views")
    )
    return counts.withColumn("ratio", safe_ratio(F.col("errors"), F.col("views"), 6))


# --- files ---------------------------------------------------------------------------------


def side():
    return F.when(F.col("doc_id") % 4 == 0, F.lit("test")).otherwise(F.lit("train"))


def _corpus_files(spark, sf):
    base = fresh_path(spark, "corpus")
    rows = table(spark, sf, "documents").select("text", F.col("source").alias("category"), side().alias("side"))
    for name in ("train", "test"):
        corpus.write_csv(rows.where(F.col("side") == name).drop("side"), f"{base}/{name}.csv")
    return [f"{base}/train.csv", f"{base}/test.csv"]


@query(
    "s01_corpus_scan",
    """SELECT text, source AS category, CASE WHEN doc_id % 4 = 0 THEN 'test' ELSE 'train' END AS split FROM documents""",
)
def _(spark, sf):
    return corpus.scan_corpus(spark, _corpus_files(spark, sf), multiline=True)


def _split_dataset(spark, sf):
    path = fresh_path(spark, "splits")
    rows = table(spark, sf, "documents").select("doc_id", "text", F.col("lang").alias("label"), side().alias("split"))
    corpus.write_splits(rows, path)
    return path


@query(
    "s02_split_dataset",
    "SELECT doc_id, text, lang AS label, CASE WHEN doc_id % 4 = 0 THEN 'test' ELSE 'train' END AS split FROM documents",
)
def _(spark, sf):
    return spark.read.parquet(_split_dataset(spark, sf))


@query("s03_read_split", "SELECT doc_id, text, lang AS label FROM documents WHERE doc_id % 4 <> 0")
def _(spark, sf):
    return corpus.read_split(spark, _split_dataset(spark, sf), "train")


@query("s08_rater_sheets", f"WITH {RATINGS} SELECT rater, CAST(item AS VARCHAR) AS item, queue FROM ratings")
def _(spark, sf):
    base = fresh_path(spark, "sheets")
    rows = ratings(spark, sf)
    for rater in RATERS:
        sheet = rows.where(F.col("rater") == rater).select(
            F.col("item").cast("string").alias("intent"), F.concat(F.lit(" "), F.upper("queue")).alias("queue")
        )
        corpus.write_csv(sheet, f"{base}/{rater}.csv")
    return corpus.scan_sheets(spark, base)


STYLE = "(['english', 'mixed', 'short'])[1 + CAST(doc_id % 3 AS INT)]"


@query(
    "s09_message_scan",
    f"SELECT text, lang AS label, {STYLE} AS language_style, CASE WHEN doc_id % 5 = 0 THEN '' ELSE source END AS author FROM documents",
)
def _(spark, sf):
    path = fresh_path(spark, "messages")
    style = F.element_at(F.array(*[F.lit(s) for s in SLICES]), (F.col("doc_id") % 3 + 1).cast("int"))
    rows = table(spark, sf, "documents").select(
        "text", F.col("lang").alias("label"), style.alias("language_style"), F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("author")
    )
    corpus.write_csv(rows, path)
    return corpus.scan_text(spark, path, corpus.MESSAGE_SCHEMA, multiline=True)


@query("s10_pii_case_scan", f"WITH {CASES} SELECT kind, pii, text FROM cases")
def _(spark, sf):
    path = fresh_path(spark, "cases")
    corpus.write_csv(pii_cases(spark, sf).select("kind", "pii", "text"), path)
    return corpus.scan_text(spark, path, corpus.CASE_SCHEMA, multiline=True)


# --- generated corpus: one message per event ------------------------------------------------


def _synthetic_sql() -> str:
    label = pick_sql(synthetic.LABELS, u_sql("42label", "event_id"))
    text = "CASE label0 " + " ".join(
        f"WHEN '{name}' THEN {pick_sql(synthetic.TEMPLATES[name], u_sql('42text', 'event_id'))}" for name in synthetic.LABELS
    ) + " END"
    for name, values in synthetic.FILLERS.items():
        text = f"replace({text}, '{{{name}}}', {pick_sql(values, u_sql(f'42{name}', 'event_id'))})"
    noisy = f"CASE WHEN {u_sql('42noise', 'event_id')} < 0.1 THEN {pick_sql(synthetic.LABELS, u_sql('42redraw', 'event_id'))} ELSE label0 END"
    return f"SELECT event_id, {text} AS text, {noisy} AS label FROM (SELECT event_id, {label} AS label0 FROM events)"


@query("m15_synthetic_corpus", _synthetic_sql())
def _(spark, sf):
    return synthetic.synthetic_corpus(table(spark, sf, "events").select("event_id"), "event_id")
