"""Queries that fit or apply models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.functions.hashing import uniform
from ticketloom.functions.scores import top_class
from ticketloom.functions.text import clean_text, redact
from ticketloom.operators import drift, evaluation, features, mapping, ranks, resampling, textdrift
from ticketloom.operators.bayesgrid import Setting, held_out_predictions
from ticketloom.operators.classifiers import (
    MajorityHead,
    TextModel,
    class_names,
    fit_candidates,
    fit_text_model,
    load_model,
    predict_featured,
    save_model,
)
from ticketloom.plans.evaluation import per_class_sql
from ticketloom.plans.monitoring import TICKETS
from ticketloom.plans.registry import query
from ticketloom.plans.views import W, balanced, clean_sql, r6, redact_sql, stream, table, tickets, training_texts, u_sql
from ticketloom.session import fresh_path, settle
from ticketloom.sources import logs
from ticketloom.streaming.runner import drain, drain_table
from ticketloom.streaming.scoring import log_records, score_and_route


def _sides(df: DataFrame, seed: str = "side") -> tuple[DataFrame, DataFrame]:
    """Three quarters train, one quarter test, by key."""
    u = uniform(seed, "doc_id")
    return df.where(u >= F.lit(0.25)), df.where(u < F.lit(0.25))



def _fitted(spark: SparkSession, sf: str, name: str) -> TextModel:
    """A model fitted on the labelled documents; every query pays for its own."""
    return fit_text_model(training_texts(spark, sf), name)


# --- TF-IDF and complement naive Bayes in SQL -----------------------------------------------------


def grams_sql(ngram_max: int) -> str:
    pairs = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return f"list_concat(w, {pairs})" if ngram_max == 2 else "w"


def tfidf_sql(source: str, out: str, ngram_max: int = 2) -> str:
    """(id, term, w) of a table (id, text) with the idf of ``vocab``."""
    return f"""{out}_w AS (SELECT id, regexp_extract_all(lower(text), '[{W}]{{2,}}') AS w FROM {source}),
{out}_g AS (SELECT id, unnest({grams_sql(ngram_max)}) AS term FROM {out}_w),
{out}_t AS (SELECT id, term, count(*) AS tf FROM {out}_g GROUP BY 1, 2),
{out}_r AS (SELECT id, t.term, tf * idf AS w FROM {out}_t t JOIN vocab v ON t.term = v.term),
{out} AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM {out}_r)"""


def vocab_sql(ngram_max: int = 2, max_features: int = 5000) -> str:
    return f"""vw AS (SELECT id, regexp_extract_all(lower(text), '[{W}]{{2,}}') AS w FROM train),
vg AS (SELECT id, unnest({grams_sql(ngram_max)}) AS term FROM vw),
vocab AS (SELECT term, ln((1.0::DOUBLE + (SELECT count(*) FROM train)) / (1.0::DOUBLE + count(DISTINCT id))) + 1.0::DOUBLE AS idf
  FROM vg GROUP BY term ORDER BY count(*) DESC, term LIMIT {max_features})"""


def nb_sql(source: str, ngram_max: int = 2, max_features: int = 5000) -> str:
    """Complement naive Bayes of ``train`` (id, text, label) applied to ``source`` (id, text): (id, c, p)."""
    return f"""{vocab_sql(ngram_max, max_features)}, {tfidf_sql('train', 'tw', ngram_max)},
classes AS (SELECT DISTINCT label AS c FROM train),
total AS (SELECT term, sum(weight) AS n FROM tw GROUP BY term),
own AS (SELECT term, label AS c, sum(weight) AS n FROM tw JOIN train ON tw.id = train.id GROUP BY 1, 2),
rest AS (SELECT t.term, k.c, 1.0::DOUBLE + coalesce(t2.n, 0) - coalesce(o.n, 0) AS n FROM vocab t CROSS JOIN classes k
  LEFT JOIN total t2 ON t2.term = t.term LEFT JOIN own o ON o.term = t.term AND o.c = k.c),
theta AS (SELECT term, c, -ln(n / sum(n) OVER (PARTITION BY c)) AS w FROM rest),
{tfidf_sql(source, 'sw', ngram_max)},
raw AS (SELECT s.id, k.c, coalesce(x.score, 0) AS score FROM {source} s CROSS JOIN classes k
  LEFT JOIN (SELECT sw.id, theta.c, sum(sw.weight * theta.w) AS score FROM sw JOIN theta ON sw.term = theta.term GROUP BY 1, 2) x
  ON x.id = s.id AND x.c = k.c),
probs AS (SELECT id, c, exp(score - max(score) OVER (PARTITION BY id)) / sum(exp(score)) OVER (PARTITION BY id)
  * exp(max(score) OVER (PARTITION BY id)) AS p FROM raw),
best AS (SELECT id, max(p) AS confidence, arg_min(c, (-p, c)) AS predicted_label FROM probs GROUP BY id)"""


TRAIN = f"train AS (SELECT d.doc_id AS id, {clean_sql('d.text')} AS text, CAST(l.quality AS VARCHAR) AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"
ALL_DOCS = f"docs AS (SELECT doc_id AS id, {clean_sql('text')} AS text FROM documents)"


def _all_docs(spark, sf):
    return balanced(table(spark, sf, "documents").select("doc_id", "text")).withColumn("text", clean_text(F.col("text")))


@query(
    "m01_tfidf",
    f"WITH {TRAIN}, {ALL_DOCS}, {vocab_sql()}, {tfidf_sql('docs', 'dw')} SELECT id AS doc_id, term, round(weight, 6) AS weight FROM dw",
)
def _(spark, sf):
    """Vocabulary and idf from the labelled documents, weights for all documents."""
    model = _fitted(spark, sf, "complementnb").features
    rows = features.long_form(model.transform(_all_docs(spark, sf)), model, "doc_id")
    return rows.withColumn("weight", r6("weight"))


@query(
    "m02_majority",
    f"""WITH {TRAIN}, m AS (SELECT label FROM train GROUP BY label ORDER BY count(*) DESC, label LIMIT 1)
    SELECT doc_id, m.label AS predicted_label, 1.0::DOUBLE AS confidence FROM documents, m""",
)
def _(spark, sf):
    train = training_texts(spark, sf)
    winner = evaluation.majority_class(train, "label").first()["majority_class"]
    head = MajorityHead(class_names(train, "label"), True, winner)
    return predict_featured(table(spark, sf, "documents").select("doc_id"), head).drop("scores")


@query(
    "m03_complement_bayes",
    f"WITH {TRAIN}, {ALL_DOCS}, {nb_sql('docs')} SELECT id AS doc_id, predicted_label, round(confidence, 6) AS confidence FROM best",
)
def _(spark, sf):
    rows = _fitted(spark, sf, "complementnb").predict(_all_docs(spark, sf))
    return rows.select("doc_id", "predicted_label", r6("confidence").alias("confidence"))


def _scored(spark, sf, name, max_iter=50):
    """What a fitted optimiser says of the test side: label, predicted label and the score of every class."""
    train, test = _sides(training_texts(spark, sf))
    rows = fit_text_model(train, name, max_iter=max_iter).predict(test)
    scores = F.transform("scores", r6)
    kept = [r6("confidence").alias("confidence")] if "confidence" in rows.columns else []
    return rows.select("doc_id", "label", "predicted_label", *kept, scores.alias("scores"))


def _stated(spark, sf, name, max_iter=50):
    """What SQL can say of a fitted optimiser: the rows, that scores are probabilities, that it is no worse than the majority."""
    train, test = _sides(training_texts(spark, sf))
    model = fit_text_model(train, name, max_iter=max_iter)
    total = F.aggregate("scores", F.lit(0.0), lambda a, x: a + x)
    if model.head.probabilistic:
        sound = F.col("confidence").between(0, 1) & (F.abs(total - 1) < 1e-6) & (F.array_max("scores") == F.col("confidence"))
    else:  # margins of two classes are one margin and its opposite, and the prediction is the larger one
        sound = (F.abs(total) < 1e-6) & (top_class(F.col("scores"), model.head.classes) == F.col("predicted_label"))
    rows = model.predict(test).select("doc_id", "label", "predicted_label", sound.alias("scores_sound"))
    rows = settle(rows, "scored")
    winner = evaluation.majority_class(train, "label").first()["majority_class"]
    f1 = [
        evaluation.score(rows.withColumn("floor", F.lit(winner)), "label", guess).first()["f1_macro"]
        for guess in ("predicted_label", "floor")
    ]
    return rows.select("doc_id", "label", "scores_sound", F.lit(f1[0] >= f1[1]).alias("reaches_majority"))


STATED = f"""WITH {TRAIN.replace("train AS", "labelled AS")}
    SELECT id AS doc_id, label, TRUE AS scores_sound, TRUE AS reaches_majority FROM labelled WHERE {u_sql("side", "id")} < 0.25"""

FITTED = {
    "m04_logistic_regression": "logreg",
    "m05_linear_svm": "linearsvc",
    "m06_calibrated_svm": "linearsvc_calibrated",
    "m07_isotonic_svm": "linearsvc_isotonic",
}
for _name, _head in FITTED.items():
    # predictions and scores, which no SQL repeats; and beside them the flags, which SQL states
    query(_name)(lambda spark, sf, head=_head: _scored(spark, sf, head))
    query(f"{_name}_stated", STATED)(lambda spark, sf, head=_head: _stated(spark, sf, head))


@query("m09_all_documents_scored")
def _(spark, sf):
    """All documents scored with the production model, the calibrated machines, in one multiply for each."""
    rows = _fitted(spark, sf, "linearsvc_calibrated").predict(_all_docs(spark, sf))
    return rows.select("doc_id", "predicted_label", r6("confidence").alias("confidence"))


CANDIDATES = ["majority", "complementnb", "logreg", "linearsvc", "linearsvc_calibrated"]


def _cells_of(test: DataFrame, models: dict[str, TextModel]) -> DataFrame:
    """Confusion cells per model, kept as a table; the texts become features once."""
    shared = next(iter(models.values())).features.transform(test).select("doc_id", "label", "features").persist()
    out = None
    for name, model in models.items():
        part = predict_featured(shared, model.head).select(F.lit(name).alias("model"), "doc_id", "label", "predicted_label")
        out = part if out is None else out.unionByName(part)
    cells = settle(evaluation.confusion_cells(out, "label", "predicted_label", ("model",)), "candidate-cells")
    shared.unpersist()
    return cells


def _board(spark, sf):
    """Every candidate on one feature space: macro F1 with its interval, and the support it was scored on."""
    train, test = _sides(training_texts(spark, sf))
    cells = _cells_of(test, fit_candidates(train, CANDIDATES, max_iter=50))
    per_class = evaluation.class_scores(cells, ("model",))
    table_ = evaluation.summary_scores(per_class, ("model",)).select("model", "accuracy", "f1_macro")
    rows = per_class.groupBy("model").agg(F.sum("support").cast("long").alias("support"))
    bounds = None
    for name in CANDIDATES:
        part = resampling.percentile_interval(resampling.bootstrap_f1(cells.where(F.col("model") == name).drop("model")))
        part = part.select(F.lit(name).alias("model"), "ci_low", "ci_high")
        bounds = part if bounds is None else bounds.unionByName(part)
    return settle(table_.join(bounds, "model").join(rows, "model"), "board")


@query("m11_candidate_sweep")
def _(spark, sf):
    """The board: scores, intervals, and how far each candidate is from the best."""
    board = _board(spark, sf)
    best = board.agg(F.max("f1_macro")).scalar()
    scores = [F.round(c, 4).alias(c) for c in ("accuracy", "f1_macro")]
    return board.select("model", "support", *scores, "ci_low", "ci_high", F.round(best - F.col("f1_macro"), 4).alias("behind_best"))


@query(
    "m11_candidate_sweep_stated",
    f"""WITH {TRAIN.replace("train AS", "labelled AS")}, n AS (SELECT count(*) AS support FROM labelled WHERE {u_sql("side", "id")} < 0.25)
    SELECT unnest({CANDIDATES}) AS model, support, TRUE AS reaches_majority,
    TRUE AS interval_holds_score FROM n""",
)
def _(spark, sf):
    board = _board(spark, sf)
    floor = board.where("model = 'majority'").select("f1_macro").scalar()
    return board.select(
        "model",
        "support",
        (F.col("f1_macro") >= floor).alias("reaches_majority"),
        F.round("f1_macro", 4).between(F.col("ci_low"), F.col("ci_high")).alias("interval_holds_score"),
    )


SIDES = f"train AS (SELECT * FROM labelled WHERE {u_sql('side', 'id')} >= 0.25), test AS (SELECT * FROM labelled WHERE {u_sql('side', 'id')} < 0.25)"


def nb_scores_sql(labelled: str, keys: str, ngram_max: int = 2, max_features: int = 5000) -> str:
    """Accuracy and macro F1 of complement naive Bayes on the test side of ``labelled``."""
    return f"""SELECT * FROM (WITH {labelled}, {SIDES}, {nb_sql('test', ngram_max, max_features)},
    cells AS (SELECT t.label AS truth, b.predicted_label AS predicted, count(*) AS n FROM best b JOIN test t ON b.id = t.id GROUP BY 1, 2),
    {per_class_sql()} SELECT {keys}, sum(hits)::DOUBLE / sum(support) AS accuracy, avg(f1_) AS f1_macro FROM per_class)"""


@query(
    "m12_parameter_sweep",
    "SELECT ngram_max, max_features, round(accuracy, 6) AS accuracy, round(f1_macro, 6) AS f1_macro FROM ("
    + " UNION ALL ".join(
        nb_scores_sql(TRAIN.replace("train AS", "labelled AS"), f"{n} AS ngram_max, {m} AS max_features", n, m)
        for n in (1, 2)
        for m in (1000, 5000)
    )
    + ")",
)
def _(spark, sf):
    """Scores by n-gram length and vocabulary size, all from one tokenisation and one cube."""
    grid = [(n, m) for n in (1, 2) for m in (1000, 5000)]
    settings = [Setting(f"{n},{m}", "label", n, m) for n, m in grid]
    found = held_out_predictions(training_texts(spark, sf), uniform("side", "doc_id") < F.lit(0.25), settings)
    scores = evaluation.score(found, "label", "predicted_label", ("setting",))
    told = F.split("setting", ",").cast("array<int>")
    return scores.select(
        told[0].alias("ngram_max"), told[1].alias("max_features"), r6("accuracy").alias("accuracy"), r6("f1_macro").alias("f1_macro")
    )


def _mapped_sql(version: str, north: str) -> str:
    labelled = f"labelled AS (SELECT doc_id AS id, {clean_sql('text')} AS text, CASE WHEN lang IN ({north}) THEN 'north' ELSE 'south' END AS label FROM documents)"
    return nb_scores_sql(labelled, f"'{version}' AS mapping")


@query(
    "m13_mapping_sensitivity",
    f"""WITH s AS (SELECT mapping, round(f1_macro, 4) AS f1_macro FROM ({_mapped_sql('author', "'en', 'de'")}
    UNION ALL {_mapped_sql('majority', "'en'")}))
    SELECT mapping, f1_macro, round(f1_macro - (SELECT f1_macro FROM s WHERE mapping = 'author'), 4) AS delta_f1_macro FROM s""",
)
def _(spark, sf):
    """Refit under the author's and another mapping of sources to queues; how far F1 moves."""
    docs = balanced(table(spark, sf, "documents").select("doc_id", "text", "source", "lang"))
    rows = docs.withColumn("text", clean_text(F.col("text")))
    fine = F.concat_ws("/", "lang", (F.col("doc_id") % 2).cast("string"))
    rows = rows.withColumn("intent", fine)
    names = rows.select("intent").distinct()
    author = F.when(F.col("intent").rlike("^(en|de)"), F.lit("north")).otherwise(F.lit("south"))
    other = F.when(F.col("intent").rlike("^en"), F.lit("north")).otherwise(F.lit("south"))
    maps = names.select(
        "intent",
        F.inline(
            F.array(
                F.struct(F.lit("author").alias("version"), author.alias("queue")),
                F.struct(F.lit("majority").alias("version"), other.alias("queue")),
            )
        ),
    )
    labelled = mapping.relabel(rows, maps, ["author", "majority"], "intent")
    settings = [Setting(version, f"queue_{version}") for version in ("author", "majority")]
    found = held_out_predictions(labelled, uniform("side", "doc_id") < F.lit(0.25), settings)
    scores = evaluation.score(found, "label", "predicted_label", ("setting",))
    out = settle(scores.select(F.col("setting").alias("mapping"), F.round("f1_macro", 4).alias("f1_macro")), "sensitivity")
    base = out.where("mapping = 'author'").select("f1_macro").scalar()
    return out.withColumn("delta_f1_macro", F.round(F.col("f1_macro") - base, 4))


@query(
    "m14_text_drift",
    f"""WITH n AS (SELECT 'same_corpus' AS "column", count(*) AS rows_, FALSE AS over FROM documents WHERE NOT ({u_sql("half", "doc_id")} < 0.5)
      UNION ALL SELECT 'other_language', count(*), TRUE FROM documents WHERE lang <> 'en')
    SELECT "column", rows_ AS "rows", 0.55::DOUBLE AS threshold, CASE WHEN rows_ >= 200 THEN over END AS drifted, TRUE AS in_order FROM n""",
)
def _(spark, sf):
    """Texts of one corpus split in two, and English against the rest, with verdicts."""
    rows = _text_drifts(spark, sf)
    in_order = rows[0][1] < rows[1][1]
    return _drift_verdicts(spark, rows).drop("score").withColumn("in_order", F.lit(in_order))


@query("m14_text_drift_scores")
def _(spark, sf):
    """The same comparisons with their scores, which no SQL repeats: the classifier is a fitted optimum."""
    return _drift_verdicts(spark, _text_drifts(spark, sf)).withColumn("score", r6("score"))


@query(
    "m14_rank_auc",
    f"""WITH {TRAIN.replace("train AS", "labelled AS")}, train AS (SELECT * FROM labelled WHERE {u_sql("side", "id")} >= 0.25),
    test AS (SELECT * FROM labelled WHERE {u_sql("side", "id")} < 0.25), {nb_sql("test")},
    scored AS (SELECT p.c, round(p.p, 6) AS s, t.label = p.c AS hit FROM probs p JOIN test t ON p.id = t.id),
    ranked AS (SELECT c, hit, rank() OVER (PARTITION BY c ORDER BY s) + (count(*) OVER (PARTITION BY c, s) - 1) / 2.0::DOUBLE AS r,
      count(*) OVER (PARTITION BY c, s) AS t FROM scored),
    sums AS (SELECT c, count(*) FILTER (WHERE hit) AS n1, count(*) FILTER (WHERE NOT hit) AS n2, count(*)::DOUBLE AS n,
      sum(r) FILTER (WHERE hit) AS w, sum(t * t - 1)::DOUBLE AS ties FROM ranked GROUP BY c),
    won AS (SELECT *, w - n1 * (n1 + 1) / 2.0::DOUBLE AS u, n1 * n2 / 12.0::DOUBLE * (n + 1 - ties / (n * (n - 1))) AS spread FROM sums)
    SELECT c AS label, n1 AS positives, n2 AS negatives, CASE WHEN n1 * n2 > 0 THEN round(u / (n1 * n2), 6) END AS auc,
    CASE WHEN n1 * n2 > 0 AND spread > 0 THEN round((u - n1 * n2 / 2.0::DOUBLE) / sqrt(spread), 6) END AS z FROM won""",
)
def _(spark, sf):
    """How well each class's score tells it from the rest, by rank sums over held-out texts."""
    train, test = _sides(training_texts(spark, sf))
    model = fit_text_model(train, "complementnb")
    names = F.array(*[F.lit(c) for c in model.head.classes])
    long = model.predict(test).select("label", F.inline(F.arrays_zip(names.alias("c"), F.col("scores").alias("p"))).alias("c", "p"))
    found = ranks.rank_auc(long.withColumn("p", F.round("p", 6)), "p", F.col("label") == F.col("c"), ("c",))
    return found.select(F.col("c").alias("label"), "positives", "negatives", r6("auc").alias("auc"), r6("z").alias("z"))


def _drift_verdicts(spark, rows):
    scores = spark.createDataFrame(rows, "column string, score double, rows long")
    return drift.column_verdicts(scores.withColumn("threshold", F.lit(drift.TEXT_THRESHOLD)))


def _text_drifts(spark, sf):
    docs = balanced(table(spark, sf, "documents").select("doc_id", "text", "lang")).persist()
    try:
        halves = uniform("half", "doc_id") < F.lit(0.5)
        english = F.col("lang") == "en"
        cases = {"same_corpus": (halves, ~halves), "other_language": (english, ~english)}
        return [
            (name, textdrift.text_drift(docs.where(a), docs.where(b), "text", "doc_id"), docs.where(b).count())
            for name, (a, b) in cases.items()
        ]
    finally:
        docs.unpersist()


@query(
    "m10_saved_model",
    f"""WITH {TRAIN.replace("train AS", "labelled AS")}, train AS (SELECT * FROM labelled WHERE {u_sql("side", "id")} >= 0.25),
    test AS (SELECT * FROM labelled WHERE {u_sql("side", "id")} < 0.25), {nb_sql("test")}
    SELECT b.id AS doc_id, t.label, predicted_label, round(confidence, 6) AS confidence FROM best b JOIN test t ON b.id = t.id""",
)
def _(spark, sf):
    """Fit, save, load and score with what was loaded."""
    train, test = _sides(training_texts(spark, sf))
    path = fresh_path(spark, "model")
    save_model(fit_text_model(train, "complementnb"), path)
    scored = load_model(spark, path).predict(test)
    return scored.select("doc_id", "label", "predicted_label", r6("confidence").alias("confidence"))


@query(
    "m09_batch_scores",
    f"""WITH {TRAIN}, {ALL_DOCS}, {nb_sql('docs')} SELECT b.id AS doc_id, predicted_label, round(confidence, 6) AS confidence,
    (SELECT round(sum(p), 9) FROM probs p WHERE p.id = b.id) AS score_sum FROM best b""",
)
def _(spark, sf):
    """All documents scored once; the class scores sum to 1."""
    rows = _fitted(spark, sf, "complementnb").predict(_all_docs(spark, sf))
    total = F.aggregate("scores", F.lit(0.0), lambda a, x: a + x)
    return rows.select("doc_id", "predicted_label", r6("confidence").alias("confidence"), F.round(total, 9).alias("score_sum"))


# --- scoring and routing ---------------------------------------------------------------------------

REASON = "CASE WHEN text IS NULL OR length(text) < 1 THEN 'empty' WHEN length(text) > 5000 THEN 'too_long' WHEN length({0}) = 0 THEN 'blank' END"


def admitted_sql(source: str, key: str, clean: str) -> str:
    return f"""tagged AS (SELECT *, {REASON.format(clean)} AS reason FROM {source}),
shown AS (SELECT {key} AS id, CASE WHEN reason IS NULL THEN {clean} ELSE '' END AS text FROM tagged)"""


TICKET_SCORES = f"{TRAIN}, {TICKETS}, {admitted_sql('tickets', 'ticket_id', clean_sql('text'))}, {nb_sql('shown')}"
ROUTE = "CASE WHEN b.confidence >= 0.7 THEN b.predicted_label ELSE 'needs_review' END"


@query(
    "t01_score_and_route_stream",
    f"""WITH {TICKET_SCORES} SELECT t.ticket_id, t.reason, CASE WHEN t.reason IS NULL THEN {ROUTE} END AS label,
    CASE WHEN t.reason IS NULL THEN b.predicted_label END AS predicted_label,
    CASE WHEN t.reason IS NULL THEN round(b.confidence, 6) END AS confidence FROM tagged t JOIN best b ON b.id = t.ticket_id""",
)
def _(spark, sf):
    routed = score_and_route(tickets(stream(spark, sf, "conversations")), _fitted(spark, sf, "complementnb"))
    rows = drain_table(routed.select("ticket_id", "reason", "label", "predicted_label", "confidence", "status"), "routed")
    return rows.select("ticket_id", "reason", "label", "predicted_label", r6("confidence").alias("confidence"))


@query(
    "s06_prediction_log_stream",
    f"""WITH {TICKET_SCORES} SELECT strftime(t.ts, '%Y-%m-%d %H:%M:%S') AS ts, {redact_sql('s.text')} AS text, b.predicted_label AS label,
    strftime(t.ts, '%Y-%m-%d') AS dt
    FROM tagged t JOIN best b ON b.id = t.ticket_id JOIN shown s ON s.id = t.ticket_id WHERE t.reason IS NULL""",
)
def _(spark, sf):
    """The redacted log a stream appends by day, read back as the drift monitor does."""
    routed = score_and_route(tickets(stream(spark, sf, "conversations")), _fitted(spark, sf, "complementnb"))
    path = drain(log_records(routed), "prediction-log", "json", ("dt",))
    log = logs.load_predictions(spark, path)
    if log is None:  # no ticket was accepted
        return spark.createDataFrame([], "ts string, text string, label string, dt string")
    return log.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).withColumn("dt", F.col("dt").cast("string"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Admit, clean, score, route, redact and count: what becomes of every document."""
    docs = balanced(table(spark, sf, "documents").select("doc_id", "text"))
    routed = score_and_route(docs, _fitted(spark, sf, "complementnb"))
    outcome = F.coalesce("label", F.concat(F.lit("refused_"), F.col("reason")))
    rows = routed.select(outcome.alias("outcome"), "confidence", (redact(F.col("text")) != F.col("text")).alias("masked"))
    return rows.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("confidence")).alias("mean_confidence"), F.count_if("masked").alias("masked")
    )


query(
    "t01_document_outcomes",
    f"""WITH {TRAIN}, {admitted_sql('documents', 'doc_id', clean_sql('text'))}, {nb_sql('shown')}
    SELECT CASE WHEN t.reason IS NULL THEN {ROUTE} ELSE 'refused_' || t.reason END AS outcome,
    count(*) AS n, round(avg(CASE WHEN t.reason IS NULL THEN b.confidence END), 6) AS mean_confidence,
    count(*) FILTER ({redact_sql('s.text')} <> s.text) AS masked
    FROM tagged t JOIN best b ON b.id = t.doc_id JOIN shown s ON s.id = t.doc_id GROUP BY 1""",
)(flagship)
