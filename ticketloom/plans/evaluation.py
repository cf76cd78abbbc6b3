"""Queries over predictions: scores, calibration, paired tests, label folding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketloom.functions.hashing import uniform
from ticketloom.functions.scores import map_confidence, map_top_class, route, score_map
from ticketloom.functions.statistics import mcnemar_exact
from ticketloom.operators import calibration, evaluation, mapping, paired, resampling
from ticketloom.operators.percentiles import grouped_percentiles, latency_summary
from ticketloom.plans.registry import query
from ticketloom.plans.views import CLASSES, DIM, FINE, PRED, balanced, fine, intent_dim, pred, r6, table, u_sql
from ticketloom.session import settle


def right():
    return F.col("a") == F.col("y")


CELLS = "cells AS (SELECT y AS truth, a AS predicted, count(*) AS n FROM pred GROUP BY 1, 2)"


def per_class_sql(cells: str = "cells", by: str = "", out: str = "per_class") -> str:
    key = f"{by}, " if by else ""
    return f"""sides_{out} AS (
  SELECT {key}truth AS class, n AS support, 0 AS claimed, CASE WHEN truth = predicted THEN n ELSE 0 END AS hits
    FROM {cells} UNION ALL SELECT {key}predicted, 0, n, 0 FROM {cells}),
{out} AS (SELECT {key}class, CAST(sum(support) AS BIGINT) AS support, CAST(sum(hits) AS BIGINT) AS hits,
  coalesce(sum(hits)::DOUBLE / nullif(sum(claimed), 0), 0) AS precision_,
  coalesce(sum(hits)::DOUBLE / nullif(sum(support), 0), 0) AS recall_,
  coalesce(2.0::DOUBLE * sum(hits) / nullif(sum(support) + sum(claimed), 0), 0) AS f1_
  FROM sides_{out} GROUP BY {key}class)"""


@query("a01_accuracy", f"WITH {PRED} SELECT round(avg(CASE WHEN a = y THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy FROM pred")
def _(spark, sf):
    return pred(spark, sf).agg(r6(F.avg(right().cast("double"))).alias("accuracy"))


@query(
    "a02_class_scores",
    f"""WITH {PRED}, {CELLS}, {per_class_sql()} SELECT class, round(precision_, 6) AS "precision",
    round(recall_, 6) AS recall, round(f1_, 6) AS f1, support FROM per_class""",
)
def _(spark, sf):
    scores = evaluation.class_scores(evaluation.confusion_cells(pred(spark, sf), "y", "a"))
    return scores.select("class", r6("precision").alias("precision"), r6("recall").alias("recall"), r6("f1").alias("f1"), "support")


@query(
    "a03_macro_scores",
    f"""WITH {PRED}, {CELLS}, {per_class_sql()} SELECT round(avg(f1_), 6) AS f1_macro,
    round(avg(precision_), 6) AS precision_macro, round(avg(recall_), 6) AS recall_macro FROM per_class""",
)
def _(spark, sf):
    row = evaluation.score(pred(spark, sf), "y", "a")
    return row.select(*[r6(c).alias(c) for c in ("f1_macro", "precision_macro", "recall_macro")])


@query(
    "a04_weighted_scores",
    f"""WITH {PRED}, {CELLS}, {per_class_sql()} SELECT round(sum(f1_ * support) / sum(support), 6) AS f1_weighted,
    round(sum(precision_ * support) / sum(support), 6) AS precision_weighted,
    round(sum(recall_ * support) / sum(support), 6) AS recall_weighted, CAST(sum(support) AS BIGINT) AS "rows"
    FROM per_class""",
)
def _(spark, sf):
    row = evaluation.score(pred(spark, sf), "y", "a")
    names = ("f1_weighted", "precision_weighted", "recall_weighted")
    return row.select(*[r6(c).alias(c) for c in names], "rows")


@query(
    "a05_confusion_matrix",
    f"""WITH {PRED} SELECT y AS truth, {', '.join(f"count(*) FILTER (a = '{c}') AS {c}" for c in CLASSES)}
    FROM pred GROUP BY y""",
)
def _(spark, sf):
    return evaluation.confusion_matrix(evaluation.confusion_cells(pred(spark, sf), "y", "a"), CLASSES)


THRESHOLD_COUNTS = f"""t AS (SELECT unnest([{', '.join(f'{t}::DOUBLE' for t in calibration.COVERAGE_THRESHOLDS)}]) AS threshold),
counts AS (SELECT threshold, (SELECT count(*) FROM pred) AS n,
  (SELECT count(*) FROM pred WHERE confidence >= threshold) AS routed,
  (SELECT count(*) FROM pred WHERE confidence >= threshold AND a = y) AS hits FROM t)"""


@query("j08_threshold_counts", f'WITH {PRED}, {THRESHOLD_COUNTS} SELECT n, threshold, routed, hits AS "right" FROM counts')
def _(spark, sf):
    return calibration.threshold_counts(pred(spark, sf), F.col("confidence"), right())


@query(
    "a06_coverage",
    f"""WITH {PRED}, {THRESHOLD_COUNTS} SELECT threshold, round(routed::DOUBLE / n, 4) AS coverage,
    round(hits::DOUBLE / nullif(routed, 0), 4) AS accuracy, n - routed AS to_review FROM counts""",
)
def _(spark, sf):
    counts = calibration.threshold_counts(pred(spark, sf), F.col("confidence"), right())
    return calibration.coverage_table(counts).drop("wrong_routes")


@query("a07_wrong_routes", f"WITH {PRED}, {THRESHOLD_COUNTS} SELECT threshold, routed - hits AS wrong_routes FROM counts")
def _(spark, sf):
    counts = calibration.threshold_counts(pred(spark, sf), F.col("confidence"), right())
    return calibration.coverage_table(counts).select("threshold", "wrong_routes")


BINS = """bins AS (SELECT least(CAST(floor(confidence * 10.0::DOUBLE) AS BIGINT), 9) AS bin, count(*) AS n,
  avg(confidence) AS mean_confidence, avg(CASE WHEN a = y THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM pred GROUP BY 1)"""


@query(
    "a08_reliability",
    f"""WITH {PRED}, {BINS} SELECT bin / 10.0::DOUBLE AS bin_low, (bin + 1) / 10.0::DOUBLE AS bin_high, n,
    round(mean_confidence, 6) AS mean_confidence, round(accuracy, 6) AS accuracy FROM bins""",
)
def _(spark, sf):
    bins = calibration.reliability_table(pred(spark, sf), F.col("confidence"), right())
    return bins.select("bin_low", "bin_high", "n", r6("mean_confidence").alias("mean_confidence"), r6("accuracy").alias("accuracy"))


@query(
    "a09_calibration_error",
    f"WITH {PRED}, {BINS} SELECT round(sum(n * abs(accuracy - mean_confidence)) / sum(n), 6) AS ece FROM bins",
)
def _(spark, sf):
    bins = calibration.reliability_table(pred(spark, sf), F.col("confidence"), right())
    return calibration.expected_calibration_error(bins).select(r6("ece").alias("ece"))


POISSON = " + ".join(f"CASE WHEN u >= {s}::DOUBLE THEN 1 ELSE 0 END" for s in resampling.poisson_steps())


def replicates_sql(count: int, rows: str = "pred", key: str = "id", kept: str = "") -> str:
    return f"""draws AS (SELECT r AS replicate, y AS truth, a AS predicted,
      CAST('0x' || substr(md5('42|' || (r // 4) || '|' || {key}), 1 + 8 * CAST(r % 4 AS INT), 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
    FROM {rows}, (SELECT unnest(range({count})) AS r)),
    cells AS (SELECT replicate, truth, predicted, sum({POISSON}) AS n FROM draws GROUP BY ALL{kept}),
    {per_class_sql(by='replicate')},
    replicates AS (SELECT replicate, avg(f1_) AS f1_macro FROM per_class GROUP BY replicate)"""


REPLICATES = replicates_sql(50)


def _replicates(spark, sf):
    return resampling.bootstrap_f1_weighted(balanced(pred(spark, sf).select("id", "y", "a")), "y", "a", "id")


@query("a10_bootstrap_weighted", f"WITH {PRED}, {REPLICATES} SELECT replicate, round(f1_macro, 6) AS f1_macro FROM replicates")
def _(spark, sf):
    return _replicates(spark, sf).select(F.col("replicate").cast("long").alias("replicate"), r6("f1_macro").alias("f1_macro"))


CELL_REPLICATES = f"""spans AS (SELECT *, greatest(0, CAST(floor(n - 12 * sqrt(n) - 12) AS BIGINT)) AS low FROM cells),
    steps AS (SELECT truth, predicted, n, low, unnest(range(low, CAST(ceil(n + 12 * sqrt(n) + 12) AS BIGINT) + 1)) AS k FROM spans),
    below AS (SELECT truth, predicted, k, sum(exp(k * ln(n::DOUBLE) - n - lgamma(k + 1)))
      OVER (PARTITION BY truth, predicted ORDER BY k) AS f FROM steps),
    uniforms AS (SELECT r AS replicate, truth, predicted, low,
      CAST('0x' || substr(md5('42|' || r || '|' || truth || '|' || predicted), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
      FROM spans, (SELECT unnest(range(1000)) AS r)),
    every AS (SELECT u.replicate, u.truth, u.predicted, coalesce(b.k + 1, u.low) AS n
      FROM uniforms u ASOF LEFT JOIN below b ON u.truth = b.truth AND u.predicted = b.predicted AND u.u >= b.f),
    drawn AS (SELECT * FROM every WHERE n > 0),
    {per_class_sql('drawn', by='replicate', out='per_draw')},
    replicates AS (SELECT replicate, avg(f1_) AS f1_macro FROM per_draw GROUP BY replicate)"""


def _cell_replicates(spark, sf):
    return resampling.bootstrap_f1_from_cells(evaluation.confusion_cells(pred(spark, sf), "y", "a"))


@query("a10_bootstrap_cells", f"WITH {PRED}, {CELLS}, {CELL_REPLICATES} SELECT replicate, round(f1_macro, 6) AS f1_macro FROM replicates")
def _(spark, sf):
    """A thousand replicates drawn from the cells."""
    return _cell_replicates(spark, sf).select("replicate", r6("f1_macro").alias("f1_macro"))


# every row has a name of its own; a class that a replicate has not drawn is not in its average
NAMED = """numbered AS (SELECT y, a, id, row_number() OVER (PARTITION BY id ORDER BY y NULLS FIRST, a NULLS FIRST) - 1 AS number FROM pred),
    named AS (SELECT y, a, coalesce(CAST(id AS VARCHAR), '') || CASE WHEN number > 0 THEN '|' || number ELSE '' END AS name FROM numbered)"""
ROW_REPLICATES = f"{NAMED}, {replicates_sql(1000, 'named', 'name', ' HAVING n > 0')}"


@query(
    "a10_bootstrap_interval",
    f"""WITH {PRED}, {ROW_REPLICATES} SELECT round(quantile_cont(f1_macro, 0.025), 4) AS ci_low,
    round(quantile_cont(f1_macro, 0.975), 4) AS ci_high FROM replicates""",
)
def _(spark, sf):
    """The interval of a thousand replicates that draw every row, whose draws SQL can repeat."""
    rows = resampling.named_rows(pred(spark, sf).select("id", "y", "a"), "y", "a", "id", "name")
    return resampling.percentile_interval(resampling.bootstrap_f1_weighted(rows, "y", "a", "name", 1000))


def p_sql(b: str, c: str) -> str:
    """Two-sided exact binomial over i = 0..min(b, c)."""
    return f"""CASE WHEN {b} + {c} = 0 THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE, 2 * list_sum(list_transform(
      range(0, least({b}, {c}) + 1), lambda i: exp(lgamma({b} + {c} + 1) - lgamma(i + 1) - lgamma({b} + {c} - i + 1)
      - ({b} + {c}) * ln(2.0::DOUBLE))))) END"""


@query(
    "a11_mcnemar",
    f"""WITH {PRED}, d AS (SELECT slice, count(*) FILTER (a = y AND b <> y) AS only_a,
    count(*) FILTER (a <> y AND b = y) AS only_b FROM pred GROUP BY 1)
    SELECT slice, only_a, only_b, round({p_sql('only_a', 'only_b')}, 9) AS p_value FROM d""",
)
def _(spark, sf):
    a_right, b_right = right(), F.col("b") == F.col("y")
    counts = pred(spark, sf).groupBy("slice").agg(
        F.count_if(a_right & ~b_right).alias("only_a"), F.count_if(~a_right & b_right).alias("only_b")
    )
    return counts.withColumn("p_value", F.round(mcnemar_exact(F.col("only_a"), F.col("only_b")), 9))


@query(
    "j04_paired_predictions",
    f"WITH {PRED} SELECT a.id, a.y, a.a, b.b FROM (SELECT id, y, a FROM pred) a JOIN (SELECT id, b FROM pred) b ON a.id = b.id",
)
def _(spark, sf):
    rows = pred(spark, sf)
    return paired.pair_predictions(rows.select("id", "y", "a"), rows.select("id", "b"), "id")


SLICED = """sliced AS (SELECT slice, y AS truth, a AS predicted, count(*) AS n FROM pred GROUP BY ALL
  UNION ALL SELECT 'overall', y, a, count(*) FROM pred GROUP BY ALL)"""


def _slice_scores(spark, sf):
    cells = evaluation.confusion_cells(pred(spark, sf), "y", "a", ("slice",))
    both = evaluation.with_overall(cells, "slice")
    return evaluation.summary_scores(evaluation.class_scores(both, ("slice",)), ("slice",))


@query(
    "a12_slice_scores",
    f"""WITH {PRED}, {SLICED}, {per_class_sql('sliced', 'slice')} SELECT slice, CAST(sum(support) AS BIGINT) AS "rows",
    round(sum(hits)::DOUBLE / sum(support), 4) AS accuracy, round(avg(f1_), 4) AS f1_macro FROM per_class GROUP BY slice""",
)
def _(spark, sf):
    return _slice_scores(spark, sf).select(
        "slice", "rows", F.round("accuracy", 4).alias("accuracy"), F.round("f1_macro", 4).alias("f1_macro")
    )


@query(
    "j09_slice_drop",
    f"""WITH {PRED}, {SLICED}, {per_class_sql('sliced', 'slice')},
    s AS (SELECT slice, avg(f1_) AS f1 FROM per_class GROUP BY slice)
    SELECT slice, round(f1, 6) AS f1_macro, round((SELECT f1 FROM s WHERE slice = 'overall') - f1, 6) AS f1_macro_drop
    FROM s WHERE slice <> 'overall'""",
)
def _(spark, sf):
    scores = _slice_scores(spark, sf)
    reference = evaluation.score(pred(spark, sf), "y", "a").select("f1_macro").scalar()
    drop = F.round(reference - F.col("f1_macro"), 6).alias("f1_macro_drop")
    return scores.where(F.col("slice") != evaluation.OVERALL).select("slice", r6("f1_macro").alias("f1_macro"), drop)


@query(
    "a13_majority_floor",
    f"""WITH {PRED}, c AS (SELECT y, count(*) AS n FROM pred GROUP BY y), m AS (SELECT y, n FROM c ORDER BY n DESC, y LIMIT 1)
    SELECT m.y AS majority_class, round(m.n::DOUBLE / (SELECT sum(n) FROM c), 6) AS accuracy,
    round(2.0::DOUBLE * m.n / (m.n + (SELECT sum(n) FROM c)) / (SELECT count(*) FROM c), 6) AS f1_macro FROM m""",
)
def _(spark, sf):
    rows = pred(spark, sf)
    winner = evaluation.majority_class(rows, "y").select("majority_class").scalar()
    cells = evaluation.confusion_cells(rows.withColumn("guess", winner), "y", "guess")
    row = evaluation.summary_scores(evaluation.class_scores(cells))
    return row.select(winner.alias("majority_class"), r6("accuracy").alias("accuracy"), r6("f1_macro").alias("f1_macro"))


@query(
    "a14_class_shares",
    f"WITH {PRED} SELECT y AS class, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM pred), 6) AS share FROM pred GROUP BY y",
)
def _(spark, sf):
    return evaluation.class_shares(pred(spark, sf), "y").select("class", "n", r6("share").alias("share"))


def _model_cells(spark, sf):
    """Cells of four 'models' on the same rows, from one scan."""
    rows = pred(spark, sf)
    models = F.inline(
        F.array(
            *[
                F.struct(F.lit(name).alias("model"), guess.alias("guess"))
                for name, guess in (
                    ("production", F.col("a")),
                    ("challenger", F.col("b")),
                    ("agreed", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.lit(CLASSES[0]))),
                    ("majority", F.lit(CLASSES[0])),
                )
            ]
        )
    )
    return evaluation.confusion_cells(rows.select("y", models), "y", "guess", ("model",))


MODEL_CELLS = """mcells AS (SELECT model, y AS truth, guess AS predicted, count(*) AS n FROM (
  SELECT 'production' AS model, y, a AS guess FROM pred UNION ALL SELECT 'challenger', y, b FROM pred
  UNION ALL SELECT 'agreed', y, CASE WHEN a = b THEN a ELSE 'click' END FROM pred
  UNION ALL SELECT 'majority', y, 'click' FROM pred) GROUP BY ALL)"""
MODEL_SCORES = f"""{MODEL_CELLS}, {per_class_sql('mcells', 'model')},
scores AS (SELECT model, round(avg(f1_), 4) AS f1_macro FROM per_class GROUP BY model)"""


def _model_scores(spark, sf):
    cells = _model_cells(spark, sf)
    scores = evaluation.summary_scores(evaluation.class_scores(cells, ("model",)), ("model",))
    return scores.select("model", F.round("f1_macro", 4).alias("f1_macro"))


@query(
    "a15_leaderboard",
    f"""WITH {PRED}, {MODEL_SCORES}, best AS (SELECT model, f1_macro FROM scores
    WHERE model NOT IN ('production', 'majority') ORDER BY f1_macro DESC, model DESC LIMIT 1),
    p AS (SELECT f1_macro FROM scores WHERE model = 'production')
    SELECT best.model AS best_alternative, best.f1_macro AS best_f1_macro, p.f1_macro AS production_f1_macro,
    round(best.f1_macro - p.f1_macro, 4) AS margin, round(best.f1_macro - p.f1_macro, 4) > 0.01 AS production_beaten
    FROM best, p""",
)
def _(spark, sf):
    return evaluation.leaderboard(_model_scores(spark, sf), "production", "majority")


@query("o06_best_model", f"WITH {PRED}, {MODEL_SCORES} SELECT model, f1_macro FROM scores ORDER BY f1_macro DESC, model DESC LIMIT 1")
def _(spark, sf):
    rank = F.struct("f1_macro", "model")
    return _model_scores(spark, sf).agg(F.max_by("model", rank).alias("model"), F.max("f1_macro").alias("f1_macro"))


@query(
    "p11_errors",
    f"""WITH {PRED} SELECT id, y AS true_queue, a AS predicted_queue, round(confidence, 4) AS confidence, intent
    FROM pred WHERE y <> a""",
)
def _(spark, sf):
    return evaluation.errors(pred(spark, sf), "y", "a", "confidence", "id", keep=("intent",))


@query(
    "o01_least_confident",
    f"""WITH {PRED} SELECT id, y AS true_queue, a AS predicted_queue, round(confidence, 4) AS confidence
    FROM pred WHERE y <> a ORDER BY round(confidence, 4), id""",
)
def _(spark, sf):
    return evaluation.least_confident(evaluation.errors(pred(spark, sf), "y", "a", "confidence", "id"), "id")


@query("a22_errors_by_intent", f"WITH {PRED} SELECT intent, count(*) AS errors FROM pred WHERE y <> a GROUP BY intent")
def _(spark, sf):
    return pred(spark, sf).where(~right()).groupBy("intent").agg(F.count(F.lit(1)).alias("errors"))


@query(
    "a22_error_profile",
    f"""WITH {PRED} SELECT count(*) FILTER (y <> a) AS errors, count(*) FILTER (y <> a AND confidence >= 0.9) AS confident_errors,
    round(avg(confidence) FILTER (y = a), 6) AS mean_confidence_right,
    round(avg(confidence) FILTER (y <> a), 6) AS mean_confidence_wrong FROM pred""",
)
def _(spark, sf):
    row = evaluation.error_profile(pred(spark, sf), "y", "a", "confidence")
    return row.select(
        "errors",
        "confident_errors",
        r6("mean_confidence_right").alias("mean_confidence_right"),
        r6("mean_confidence_wrong").alias("mean_confidence_wrong"),
    )


ROUTED = "routed AS (SELECT *, CASE WHEN confidence >= 0.7 THEN a ELSE 'needs_review' END AS label FROM pred)"


@query("p10_review_route", f"WITH {PRED}, {ROUTED} SELECT id, label, a AS predicted_label, round(confidence, 6) AS confidence FROM routed")
def _(spark, sf):
    label = route(F.col("a"), F.col("confidence"))
    return pred(spark, sf).select("id", label.alias("label"), F.col("a").alias("predicted_label"), r6("confidence").alias("confidence"))


@query(
    "a23_routed_counts",
    f"""WITH {PRED}, {ROUTED} SELECT label, count(*) AS n,
    round(count(*) FILTER (label = 'needs_review')::DOUBLE / count(*), 6) AS review_rate FROM routed GROUP BY label
    UNION ALL SELECT 'all', count(*), round(count(*) FILTER (label = 'needs_review')::DOUBLE / count(*), 6) FROM routed""",
)
def _(spark, sf):
    label = route(F.col("a"), F.col("confidence"))
    rows = pred(spark, sf).select(label.alias("label"))
    totals = rows.rollup("label").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg((F.col("label") == "needs_review").cast("double"))).alias("review_rate")
    )
    return totals.na.fill("all", ["label"]).select(
        "label", "n", F.when(F.col("label") == "needs_review", F.lit(1.0)).otherwise(F.col("review_rate")).alias("review_rate")
    )


# scores of the five classes as a map: md5 numbers with two decimals, so that ties occur
def _score_values():
    return F.array(*[F.floor(uniform(f"s{i}", "event_id") * 100.0) / 100.0 for i in range(5)])


SCORES = "scored AS (SELECT event_id, " + ", ".join(
    f"floor({u_sql(f's{i}', 'event_id')} * 100.0::DOUBLE) / 100.0::DOUBLE AS s{i}" for i in range(5)
) + " FROM events)"
BEST = "greatest(s0, s1, s2, s3, s4)"


@query(
    "p09_top_class",
    f"""WITH {SCORES} SELECT event_id, CASE WHEN s0 = {BEST} THEN 'click' WHEN s1 = {BEST} THEN 'error'
    WHEN s2 = {BEST} THEN 'purchase' WHEN s3 = {BEST} THEN 'signup' ELSE 'view' END AS predicted_label,
    {BEST} AS confidence FROM scored""",
)
def _(spark, sf):
    classes = F.array(*[F.lit(c) for c in CLASSES])
    rows = table(spark, sf, "events").select("event_id", score_map(classes, _score_values()).alias("scores"))
    scores = F.col("scores")
    return rows.select("event_id", map_top_class(scores).alias("predicted_label"), map_confidence(scores).alias("confidence"))


@query(
    "f13_score_map",
    f"""WITH {SCORES} SELECT event_id, 'click=' || printf('%.2f', s0) || ';error=' || printf('%.2f', s1) || ';purchase='
    || printf('%.2f', s2) || ';signup=' || printf('%.2f', s3) || ';view=' || printf('%.2f', s4) AS all_scores FROM scored""",
)
def _(spark, sf):
    classes = F.array(*[F.lit(c) for c in CLASSES])
    rows = table(spark, sf, "events").select("event_id", score_map(classes, _score_values()).alias("scores"))
    shown = F.transform(F.map_entries("scores"), lambda e: F.concat(e["key"], F.lit("="), F.format_string("%.2f", e["value"])))
    return rows.select("event_id", F.array_join(shown, ";").alias("all_scores"))


# --- fine and coarse labels -------------------------------------------------------------


def folded(spark, sf):
    rows, dim = fine(spark, sf), intent_dim(spark, sf)
    return mapping.fold(mapping.fold(rows, dim, "intent", "y"), dim, "predicted_intent", "mapped")


@query("j01_intent_lookup", f"WITH {FINE} SELECT id, intent, y AS queue FROM folded")
def _(spark, sf):
    return mapping.fold(fine(spark, sf), intent_dim(spark, sf), "intent", "queue").select("id", "intent", "queue")


@query(
    "j02_unmapped",
    f"""WITH {DIM} SELECT CAST(json_extract_string(props, '$.k') AS INT) AS intent, count(*) AS n FROM events
    WHERE CAST(json_extract_string(props, '$.k') AS INT) NOT IN (SELECT intent FROM dim WHERE intent % 10 <> 7) GROUP BY 1""",
)
def _(spark, sf):
    partial = intent_dim(spark, sf).where(F.col("intent") % 10 != 7)
    return mapping.unmapped(fine(spark, sf), partial, "intent")


@query("j03_folded_predictions", f"WITH {FINE} SELECT id, predicted_intent, mapped FROM folded")
def _(spark, sf):
    return folded(spark, sf).select("id", "predicted_intent", "mapped")


MAPPINGS = f"""{DIM}, mappings AS (SELECT 'author' AS version, intent, queue FROM dim UNION ALL
  SELECT 'majority', intent, CASE WHEN intent % 9 = 0 THEN 'view' ELSE queue END FROM dim)"""


def _mappings(spark, sf):
    dim = intent_dim(spark, sf)
    other = F.when(F.col("intent") % 9 == 0, F.lit("view")).otherwise(F.col("queue"))
    entries = F.array(
        F.struct(F.lit("author").alias("version"), F.col("queue").alias("queue")),
        F.struct(F.lit("majority").alias("version"), other.alias("queue")),
    )
    return dim.select("intent", F.inline(entries))


@query(
    "j10_relabelled",
    f"""WITH {MAPPINGS} SELECT e.event_id AS id, a.queue AS queue_author, m.queue AS queue_majority
    FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e
    JOIN mappings a ON a.intent = e.k AND a.version = 'author' JOIN mappings m ON m.intent = e.k AND m.version = 'majority'""",
)
def _(spark, sf):
    rows = mapping.relabel(fine(spark, sf), _mappings(spark, sf), ["author", "majority"], "intent")
    return rows.select("id", "queue_author", "queue_majority")


@query(
    "u03_moved_intents",
    f"""WITH {MAPPINGS} SELECT a.intent, a.queue AS queue_before, m.queue AS queue_after FROM mappings a JOIN mappings m
    ON a.intent = m.intent AND a.version = 'author' AND m.version = 'majority' WHERE a.queue <> m.queue""",
)
def _(spark, sf):
    maps = _mappings(spark, sf)
    return mapping.moved(maps.where("version = 'author'"), maps.where("version = 'majority'"))


@query("u04_class_domain", f"WITH {FINE} SELECT intent AS class FROM fine UNION SELECT predicted_intent FROM fine")
def _(spark, sf):
    return evaluation.class_domain(evaluation.confusion_cells(fine(spark, sf), "intent", "predicted_intent"))


VARIANTS = f"""vcells AS (SELECT 'direct' AS variant, y AS truth, direct AS predicted, count(*) AS n FROM folded GROUP BY ALL
  UNION ALL SELECT 'fine_mapped', y, mapped, count(*) FROM folded GROUP BY ALL
  UNION ALL SELECT 'fine', CAST(intent AS VARCHAR), CAST(predicted_intent AS VARCHAR), count(*) FROM folded GROUP BY ALL),
{per_class_sql('vcells', 'variant')},
v AS (SELECT variant, round(sum(hits)::DOUBLE / sum(support), 4) AS accuracy, round(avg(f1_), 4) AS f1_macro
  FROM per_class GROUP BY variant)"""


@query("a20_granularity", f"WITH {FINE}, {VARIANTS} SELECT variant, accuracy, f1_macro FROM v")
def _(spark, sf):
    variants = F.inline(
        F.array(
            F.struct(F.lit("direct").alias("variant"), F.col("y").alias("truth"), F.col("direct").alias("predicted")),
            F.struct(F.lit("fine_mapped").alias("variant"), F.col("y").alias("truth"), F.col("mapped").alias("predicted")),
            F.struct(
                F.lit("fine").alias("variant"),
                F.col("intent").cast("string").alias("truth"),
                F.col("predicted_intent").cast("string").alias("predicted"),
            ),
        )
    )
    cells = evaluation.confusion_cells(folded(spark, sf).select(variants), "truth", "predicted", ("variant",))
    rows = evaluation.summary_scores(evaluation.class_scores(cells, ("variant",)), ("variant",))
    return rows.select("variant", F.round("accuracy", 4).alias("accuracy"), F.round("f1_macro", 4).alias("f1_macro"))


@query(
    "a20_mapped_vs_direct",
    f"""WITH {FINE}, {VARIANTS}, d AS (SELECT count(*) FILTER (mapped = y AND direct <> y) AS only_a,
    count(*) FILTER (mapped <> y AND direct = y) AS only_b FROM folded)
    SELECT only_a AS only_mapped, only_b AS only_direct, round({p_sql('only_a', 'only_b')}, 9) AS p_value FROM d""",
)
def _(spark, sf):
    row = paired.mcnemar(folded(spark, sf), F.col("mapped") == F.col("y"), F.col("direct") == F.col("y"))
    return row.select(F.col("only_a").alias("only_mapped"), F.col("only_b").alias("only_direct"), F.round("p_value", 9).alias("p_value"))


@query(
    "a21_sibling_share",
    f"""WITH {FINE} SELECT count(*) AS fine_errors, round(avg(CASE WHEN y = mapped THEN 1.0::DOUBLE WHEN y <> mapped THEN 0 END), 6)
    AS sibling_share FROM folded WHERE intent <> predicted_intent""",
)
def _(spark, sf):
    row = mapping.sibling_share(folded(spark, sf), "intent", "predicted_intent", "y", "mapped")
    return row.select("fine_errors", r6("sibling_share").alias("sibling_share"))


# --- latency and the decision rule -------------------------------------------------------

PERCENTILES = """lat AS (SELECT count(value) AS n, avg(value) AS mean, quantile_cont(value, 0.5) AS p50,
  quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99 FROM events)"""


@query(
    "a24_grouped_percentiles",
    """SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS p50,
    round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type""",
)
def _(spark, sf):
    """Percentiles of every kind of event, from one sketch for each and one exact pass."""
    rows = grouped_percentiles(table(spark, sf, "events"), "value", ("event_type",))
    return rows.select("event_type", "n", *[r6(c).alias(c) for c in ("mean", "p50", "p95", "p99")])


@query(
    "a24_latency_percentiles",
    f"""WITH {PERCENTILES} SELECT n, round(mean, 6) AS mean, round(p50, 6) AS p50, round(p95, 6) AS p95,
    round(p99, 6) AS p99 FROM lat""",
)
def _(spark, sf):
    row = latency_summary(table(spark, sf, "events"), "value")
    return row.select("n", *[r6(c).alias(c) for c in ("mean", "p50", "p95", "p99")])


@query(
    "a27_decision_rule",
    f"""WITH {PRED}, {MODEL_SCORES.replace("round(avg(f1_), 4)", "avg(f1_)")}, {PERCENTILES},
    d AS (SELECT count(*) FILTER (a = y AND b <> y) AS only_a, count(*) FILTER (a <> y AND b = y) AS only_b FROM pred),
    ea AS (SELECT sum(n * abs(acc - conf)) / sum(n) AS ece FROM (SELECT count(*) AS n, avg(confidence) AS conf,
      avg(CASE WHEN a = y THEN 1.0::DOUBLE ELSE 0 END) AS acc FROM pred GROUP BY least(floor(confidence * 10.0::DOUBLE), 9))),
    eb AS (SELECT sum(n * abs(acc - conf)) / sum(n) AS ece FROM (SELECT count(*) AS n, avg(confidence_b) AS conf,
      avg(CASE WHEN b = y THEN 1.0::DOUBLE ELSE 0 END) AS acc FROM pred GROUP BY least(floor(confidence_b * 10.0::DOUBLE), 9))),
    c AS (SELECT (SELECT f1_macro FROM scores WHERE model = 'production') AS fa,
      (SELECT f1_macro FROM scores WHERE model = 'challenger') AS fb, {p_sql('only_a', 'only_b')} AS p,
      (SELECT ece FROM ea) AS ea, (SELECT ece FROM eb) AS eb, (SELECT p95 FROM lat) AS p95 FROM d)
    SELECT round(fa, 6) AS f1_challenger, round(fb, 6) AS f1_incumbent, round(ea, 6) AS ece_challenger,
    round(eb, 6) AS ece_incumbent, round(p, 9) AS p_value, round(p95, 6) AS p95, fa - fb >= 0.01 AS f1_ok, p < 0.05 AS p_ok,
    ea <= eb + 0.02 AS ece_ok, p95 <= 100.0 AS latency_ok,
    (fa - fb >= 0.01) AND p < 0.05 AND ea <= eb + 0.02 AND p95 <= 100.0 AS switch FROM c""",
)
def _(spark, sf):
    profile = paired.paired_profile(pred(spark, sf), "y", "a", "b", "confidence", "confidence_b")
    scores = paired.profile_scores(settle(profile, "paired-profile"))
    p95 = latency_summary(table(spark, sf, "events"), "value", (0.95,)).first()["p95"]
    comparison = scores.select(
        F.col("f1_a").alias("f1_challenger"),
        F.col("f1_b").alias("f1_incumbent"),
        F.col("ece_a").alias("ece_challenger"),
        F.col("ece_b").alias("ece_incumbent"),
        "p_value",
        F.lit(p95).alias("p95"),
    )
    ruled = paired.decision(comparison, p95_limit=100.0)
    rounded = {c: r6(c) for c in ("f1_challenger", "f1_incumbent", "ece_challenger", "ece_incumbent", "p95")}
    return ruled.withColumns({**rounded, "p_value": F.round("p_value", 9)})
