"""Queries over logs, drift, rates and alerts, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketloom.functions.scores import route
from ticketloom.operators import alerts, drift, evaluation, retention
from ticketloom.plans.registry import query
from ticketloom.plans.evaluation import CELLS, per_class_sql
from ticketloom.plans.views import PRED, pred, pred_of, r6, stream, table, tickets
from ticketloom.session import fresh_path, settle
from ticketloom.sources import logs, reports
from ticketloom.streaming import monitoring
from ticketloom.streaming.runner import drain, drain_table, start

HALF = "2024-01-16 00:00:00"
STAMP = "yyyy-MM-dd HH:mm:ss"


def _stamp(column):
    return F.date_format(column, STAMP)


def _zoned(df, ts="ts"):
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


# --- logs ------------------------------------------------------------------------------------

TICKETS = "tickets AS (SELECT conv_id * 1000 + turn AS ticket_id, TIMESTAMP '2024-01-01' + to_seconds(CAST(conv_id * 60 + turn AS BIGINT)) AS ts, text FROM conversations WHERE role = 'user')"


def _written_log(spark, sf):
    path = fresh_path(spark, "log")
    served = tickets(table(spark, sf, "conversations")).withColumn("label", F.concat(F.lit("q"), (F.col("ticket_id") % 5).cast("string")))
    logs.write_log(served.select("ts", "text", "label"), path)
    return path


@query(
    "s04_log_scan",
    f"""WITH {TICKETS} SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, text, 'q' || CAST(ticket_id % 5 AS VARCHAR) AS label,
    strftime(ts, '%Y-%m-%d') AS dt FROM tickets""",
)
def _(spark, sf):
    log = logs.load_predictions(spark, _written_log(spark, sf))
    return log.withColumn("ts", _stamp("ts")).withColumn("dt", F.col("dt").cast("string"))


@query(
    "s05_current_source",
    f"""WITH {TICKETS} SELECT 'prediction_log' AS current_source, count(*) AS n, count(DISTINCT text) AS texts FROM tickets
    UNION ALL SELECT 'test_split_fallback', count(*), count(DISTINCT text) FROM documents WHERE doc_id % 4 = 0
    UNION ALL SELECT 'documents', count(*), count(DISTINCT text) FROM documents""",
)
def _(spark, sf):
    """The three cases in turn: a log with rows, no log, an explicit table."""
    docs = table(spark, sf, "documents").select("doc_id", "text", F.col("lang").alias("label"))
    test = docs.where(F.col("doc_id") % 4 == 0)
    nothing = fresh_path(spark, "no-log")
    picks = [
        logs.resolve_current(spark, None, "", _written_log(spark, sf), test),
        logs.resolve_current(spark, None, "", nothing, test),
        logs.resolve_current(spark, docs, "documents", nothing, test),
    ]
    rows = picks[0].unionByName(picks[1]).unionByName(picks[2])
    return rows.groupBy("current_source").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("text").alias("texts"))


LINES = """lines AS (SELECT event_id, event_type AS log, strftime(ts, '%Y-%m-%d') AS day, event_type || props AS line,
  octet_length(encode(event_type || props)) + 1 AS bytes FROM events)"""
BUDGET = 8000


@query(
    "s07_retained_days",
    f"""WITH {LINES}, s AS (SELECT log, day, CAST(sum(bytes) AS BIGINT) AS bytes FROM lines GROUP BY 1, 2),
    r AS (SELECT *, coalesce(sum(bytes) OVER (PARTITION BY log ORDER BY day DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM s)
    SELECT log, day, bytes FROM r WHERE used < {BUDGET}""",
)
def _(spark, sf):
    return retention.retained_days(
        table(spark, sf, "events"), F.date_format("ts", "yyyy-MM-dd"), F.concat("event_type", "props"), BUDGET, F.col("event_type")
    )


@query(
    "s07_retained_rows",
    f"""WITH {LINES}, s AS (SELECT day, sum(bytes) AS bytes FROM lines GROUP BY 1),
    r AS (SELECT *, coalesce(sum(bytes) OVER (ORDER BY day DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM s)
    SELECT event_id FROM lines WHERE day IN (SELECT day FROM r WHERE used < {5 * BUDGET})""",
)
def _(spark, sf):
    rows = table(spark, sf, "events")
    kept = retention.retain(rows, F.date_format("ts", "yyyy-MM-dd"), F.concat("event_type", "props"), 5 * BUDGET)
    return kept.select("event_id")


@query(
    "s11_report_sinks",
    f"""WITH {PRED}, {CELLS}, {per_class_sql()} SELECT class, round(p.precision_, 6) AS "precision", round(p.f1_, 6) AS f1,
    round((SELECT avg(f1_) FROM per_class), 6) AS f1_macro, support FROM per_class p""",
)
def _(spark, sf):
    """Per-class scores through a nested JSON report and a CSV table, read back and joined."""
    base = fresh_path(spark, "reports")
    per_class = evaluation.class_scores(evaluation.confusion_cells(pred(spark, sf), "y", "a")).drop("hits")
    reports.write_json(reports.metrics_document(evaluation.summary_scores(per_class.withColumn("hits", F.lit(0))), per_class), f"{base}/metrics")
    reports.write_table(per_class, f"{base}/classes")
    entry = "struct<precision: double, recall: double, `f1-score`: double, support: bigint>"
    document = spark.read.schema(f"summary struct<accuracy: double, f1_macro: double>, per_class map<string, {entry}>").json(f"{base}/metrics")
    nested = document.select(F.col("summary.f1_macro").alias("f1_macro"), F.explode("per_class").alias("class", "s"))
    flat = spark.read.schema(per_class.schema).option("header", "true").csv(f"{base}/classes").select("class", "precision", "support")
    return nested.join(flat, "class").select(
        "class", r6("precision").alias("precision"), r6(F.col("s")["f1-score"]).alias("f1"), r6("f1_macro").alias("f1_macro"), "support"
    )


# --- drift: first half of January against the second ------------------------------------------

SHARES = f"""ref AS (SELECT event_type AS label, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM events WHERE ts < TIMESTAMP '{HALF}' GROUP BY 1),
cur AS (SELECT event_type AS label, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM events WHERE ts >= TIMESTAMP '{HALF}' GROUP BY 1)"""


def _halves(spark, sf):
    events = table(spark, sf, "events")
    half = F.to_timestamp_ntz(F.lit(HALF))
    return events.where(F.col("ts") < half), events.where(F.col("ts") >= half)


@query(
    "j07_aligned_shares",
    f"""WITH {SHARES} SELECT coalesce(ref.label, cur.label) AS label, round(coalesce(ref.share, 0), 6) AS reference_share,
    round(coalesce(cur.share, 0), 6) AS current_share FROM ref FULL JOIN cur ON ref.label = cur.label""",
)
def _(spark, sf):
    ref, cur = _halves(spark, sf)
    rows = drift.align(drift.label_shares(ref, "event_type"), drift.label_shares(cur, "event_type"))
    return rows.select("label", r6("reference_share").alias("reference_share"), r6("current_share").alias("current_share"))


def js_sql(ref: str, cur: str) -> str:
    """Distance between two (label, share) tables over the union of their labels."""
    return f"""(SELECT sqrt(greatest(0.0::DOUBLE, 0.5::DOUBLE * sum(
      CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END)))
      FROM (SELECT coalesce(r.share, 0) AS p, coalesce(c.share, 0) AS q FROM {ref} r FULL JOIN {cur} c ON r.label = c.label))"""


@query(
    "a25_label_drift",
    f"WITH {SHARES} SELECT round({js_sql('ref', 'cur')}, 6) AS distance, {js_sql('ref', 'cur')} > 0.1 AS drifted",
)
def _(spark, sf):
    ref, cur = _halves(spark, sf)
    row = drift.js_distance(drift.label_shares(ref, "event_type"), drift.label_shares(cur, "event_type"))
    return row.select(r6("distance").alias("distance"), (F.col("distance") > F.lit(drift.LABEL_THRESHOLD)).alias("drifted"))


KSHARES = f"""kref AS (SELECT json_extract_string(props, '$.k') AS label, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM events WHERE ts < TIMESTAMP '{HALF}' GROUP BY 1),
kcur AS (SELECT json_extract_string(props, '$.k') AS label, count(*)::DOUBLE / sum(count(*)) OVER () AS share FROM events WHERE ts >= TIMESTAMP '{HALF}' GROUP BY 1),
scores AS (SELECT 'event_type' AS "column", {js_sql('ref', 'cur')} AS score, 0.1::DOUBLE AS threshold
  UNION ALL SELECT 'k', {js_sql('kref', 'kcur')}, 0.1::DOUBLE),
n AS (SELECT count(*) AS rows_ FROM events WHERE ts >= TIMESTAMP '{HALF}')"""


def _column_scores(spark, sf):
    ref, cur = _halves(spark, sf)
    return drift.column_scores(ref, cur, {"event_type": F.col("event_type"), "k": F.get_json_object("props", "$.k")})


@query(
    "a26_column_verdicts",
    f"""WITH {SHARES}, {KSHARES} SELECT "column", round(score, 6) AS score, threshold, rows_ AS "rows",
    CASE WHEN rows_ >= 200 THEN score > threshold END AS drifted FROM scores, n""",
)
def _(spark, sf):
    return drift.column_verdicts(_column_scores(spark, sf)).withColumn("score", r6("score"))


@query(
    "a26_drift_summary",
    f"""WITH {SHARES}, {KSHARES} SELECT count(*) AS columns_checked, count(*) FILTER (score > threshold) AS columns_drifted,
    max(rows_) AS current_rows, round(count(*) FILTER (score > threshold)::DOUBLE / count(*), 4) AS drift_share,
    max(rows_) >= 200 AS sufficient_sample, CASE WHEN max(rows_) >= 200 THEN 'ok' ELSE 'insufficient_data' END AS status,
    CASE WHEN max(rows_) >= 200 THEN count(*) FILTER (score > threshold)::DOUBLE / count(*) > 0.5 END AS dataset_drifted FROM scores, n""",
)
def _(spark, sf):
    return drift.drift_summary(_column_scores(spark, sf))


# --- rates and alerts ---------------------------------------------------------------------------

ROUTED = "routed AS (SELECT ts, CASE WHEN confidence >= 0.7 THEN a ELSE 'needs_review' END AS label FROM pred)"


def rate_sql(source: str, flagged: str, length: int, slide: int, out: str = "rates") -> str:
    """Sliding windows of ``length`` minutes every ``slide`` minutes."""
    n = length // slide
    return f"""{out} AS (SELECT s AS window_start, s + INTERVAL {length} MINUTE AS window_end, count(*) AS total,
  count(*) FILTER ({flagged}) AS flagged, count(*) FILTER ({flagged})::DOUBLE / count(*) AS rate FROM (
  SELECT *, time_bucket(INTERVAL {slide} MINUTE, ts) - to_minutes(CAST({slide} * i AS BIGINT)) AS s FROM {source}, (SELECT unnest(range({n})) AS i)) GROUP BY 1, 2)"""


def _shown(rates):
    return rates.select(_stamp("window_start").alias("window_start"), _stamp("window_end").alias("window_end"), "total", "flagged", r6("rate").alias("rate"))


SHOWN = "strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, total, flagged, round(rate, 6) AS rate"


def _routed(spark, sf):
    return pred(spark, sf).select("ts", route(F.col("a"), F.col("confidence")).alias("label"))



def review():
    return F.col("label") == "needs_review"


REVIEW_RATES = f"{PRED}, {ROUTED}, {rate_sql('routed', chr(39).join(['label = ', 'needs_review', '']), 60, 5)}"


@query("t03_review_rate_batch", f"WITH {REVIEW_RATES} SELECT {SHOWN} FROM rates")
def _(spark, sf):
    return _shown(alerts.window_rate(_zoned(_routed(spark, sf)), "ts", review(), "1 hour", "5 minutes"))


def _event_stream(spark, sf):
    """The events as a stream that ends: a row far in the future closes every window before it."""
    return stream(spark, sf, "events").unionByName(monitoring.end_marker(table(spark, sf, "events"), "ts"))


def _pred_stream(spark, sf):
    """The routed predictions as a stream: the same projection over a streaming scan."""
    rows = pred_of(_event_stream(spark, sf))
    return monitoring.event_time(rows.select("ts", route(F.col("a"), F.col("confidence")).alias("label")))


@query("t03_review_rate_stream", f"WITH {REVIEW_RATES} SELECT {SHOWN} FROM rates")
def _(spark, sf):
    rates = monitoring.windowed_rate(_pred_stream(spark, sf), "ts", review(), "1 hour", "5 minutes")
    return _shown(drain_table(rates, "review-rate"))


REQUESTS = "requests AS (SELECT ts, event_type AS status, CASE WHEN user_id % 10 = 0 THEN '/metrics' ELSE '/predict' END AS handler FROM events)"
SERVED = "served AS (SELECT * FROM requests WHERE handler <> '/metrics')"
ERROR_RATES = f"{REQUESTS}, {SERVED}, {rate_sql('served', chr(39).join(['status = ', 'error', '']), 5, 5)}"


def _served(events):
    handler = F.when(F.col("user_id") % 10 == 0, F.lit(alerts.SCRAPE_HANDLER)).otherwise(F.lit("/predict"))
    rows = events.select("ts", F.col("event_type").alias("status"), handler.alias("handler"))
    return rows.where(F.col("handler") != alerts.SCRAPE_HANDLER)


def failed():
    return F.col("status") == "error"


@query("t04_error_rate_batch", f"WITH {ERROR_RATES} SELECT {SHOWN} FROM rates")
def _(spark, sf):
    return _shown(alerts.window_rate(_zoned(_served(table(spark, sf, "events"))), "ts", failed(), "5 minutes"))


@query("t04_error_rate_stream", f"WITH {ERROR_RATES} SELECT {SHOWN} FROM rates")
def _(spark, sf):
    rows = monitoring.event_time(_served(_event_stream(spark, sf)))
    return _shown(drain_table(monitoring.windowed_rate(rows, "ts", failed(), "5 minutes"), "error-rate"))


def held_sql(limit: float, hold: int, step: int) -> str:
    """Runs of high evaluations without a gap; firing once a run has lasted ``hold`` minutes."""
    return f"""ev AS (SELECT alert, window_end, rate, rate > {limit} AS high,
  lag(window_end) OVER w AS before, lag(rate > {limit}) OVER w AS was FROM alerts WINDOW w AS (PARTITION BY alert ORDER BY window_end)),
runs AS (SELECT *, sum(CASE WHEN high AND (before IS NULL OR window_end - before > INTERVAL {step} MINUTE OR NOT was) THEN 1 ELSE 0 END)
  OVER (PARTITION BY alert ORDER BY window_end) AS run FROM ev),
held AS (SELECT alert, window_end, rate, high AND window_end - min(window_end) OVER (PARTITION BY alert, high, run) >= INTERVAL {hold} MINUTE AS firing FROM runs)"""


ALERTS = f"{REVIEW_RATES}, alerts AS (SELECT 'ReviewRateHigh' AS alert, window_end, rate FROM rates)"
HELD_SHOWN = "alert, strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, round(rate, 6) AS rate, firing"


def _held_shown(held):
    return held.select("alert", _stamp("window_end").alias("window_end"), r6("rate").alias("rate"), "firing")


@query("w06_held_alert", f"WITH {ALERTS}, {held_sql(0.2, 15, 5)} SELECT {HELD_SHOWN} FROM held")
def _(spark, sf):
    rates = alerts.window_rate(_zoned(_routed(spark, sf)), "ts", review(), "1 hour", "5 minutes")
    named = rates.withColumn("alert", F.lit("ReviewRateHigh"))
    return _held_shown(alerts.held_alerts(named, alerts.REVIEW_LIMIT, "15 minutes", "5 minutes"))


@query(
    "w06_held_error_alert",
    f"""WITH {ERROR_RATES}, alerts AS (SELECT 'ApiErrorRateHigh' AS alert, window_end, rate FROM rates), {held_sql(0.05, 10, 5)}
    SELECT {HELD_SHOWN} FROM held""",
)
def _(spark, sf):
    rates = alerts.window_rate(_zoned(_served(table(spark, sf, "events"))), "ts", failed(), "5 minutes")
    named = rates.withColumn("alert", F.lit("ApiErrorRateHigh"))
    return _held_shown(alerts.held_alerts(named, alerts.ERROR_LIMIT, "10 minutes", "5 minutes"))


@query("t05_held_alert_stream", f"WITH {ALERTS}, {held_sql(0.2, 15, 5)} SELECT {HELD_SHOWN} FROM held")
def _(spark, sf):
    """Two chained streams: closed windows to a table, and a state per alert over that table."""
    rates = monitoring.windowed_rate(_pred_stream(spark, sf), "ts", review(), "1 hour", "5 minutes")
    closed = spark.readStream.schema(rates.schema).parquet(drain(rates, "closed-windows"))
    named = closed.select(F.lit("ReviewRateHigh").alias("alert"), "window_end", "rate")
    held = monitoring.held_alert_stream(named, alerts.REVIEW_LIMIT, "15 minutes", "5 minutes")
    return _held_shown(drain_table(held, "held-alerts"))


HOURLY = f"{PRED}, {ROUTED}, hourly AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, label, count(*) AS n FROM routed GROUP BY 1, 2)"


@query(
    "t06_routed_counts_stream",
    f"""WITH {HOURLY} SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, label, n FROM hourly""",
)
def _(spark, sf):
    counts = monitoring.windowed_counts(_pred_stream(spark, sf), "ts", "label", "1 hour")
    return drain_table(counts, "routed-counts").select(_stamp("window_start").alias("window_start"), "label", "n")


DAILY = f"""{SHARES}, days AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS d, event_type AS label, count(*) AS n FROM events GROUP BY 1, 2),
closed AS (SELECT d, label, n::DOUBLE / sum(n) OVER (PARTITION BY d) AS share, CAST(sum(n) OVER (PARTITION BY d) AS BIGINT) AS rows_ FROM days),
labels_ AS (SELECT DISTINCT d, rows_, r.label FROM closed, ref r UNION SELECT d, rows_, label FROM closed),
dist AS (SELECT l.d, l.rows_, sqrt(greatest(0.0::DOUBLE, 0.5::DOUBLE * sum(
  CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END))) AS distance
  FROM (SELECT l.d, l.rows_, coalesce(r.share, 0) AS p, coalesce(c.share, 0) AS q FROM labels_ l LEFT JOIN ref r ON r.label = l.label
    LEFT JOIN closed c ON c.d = l.d AND c.label = l.label) l GROUP BY 1, 2)"""


@query(
    "t07_windowed_drift",
    f"""WITH {DAILY} SELECT strftime(d, '%Y-%m-%d %H:%M:%S') AS window_start, rows_ AS "rows", round(distance, 6) AS distance,
    CASE WHEN rows_ >= 200 THEN 'ok' ELSE 'insufficient_data' END AS status, CASE WHEN rows_ >= 200 THEN distance > 0.1 END AS drifted FROM dist""",
)
def _(spark, sf):
    """Distance and verdict of each day, both in the stream, from the shares of a reference table."""
    rows = monitoring.event_time(_event_stream(spark, sf))
    reference = settle(drift.label_shares(_halves(spark, sf)[0], "event_type"), "reference-shares")
    days = drift.window_verdicts(monitoring.windowed_drift(rows, "ts", "event_type", reference, "1 day"))
    return drain_table(days, "daily-drift").select(
        _stamp("window_start").alias("window_start"), "rows", r6("distance").alias("distance"), "status", "drifted"
    )


@query(
    "t08_late_rows",
    f"""WITH d AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type AS label, count(*) AS n FROM events
    WHERE ts >= TIMESTAMP '{HALF}' GROUP BY 1, 2)
    SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, label, n FROM d""",
)
def _(spark, sf):
    """Late data: the second half of the month arrives first, then the first half, then the end marker.

    Each arrival is a run of the same query on its checkpoint. The first run moves the
    watermark to the end of the month, so the rows of the second are late and dropped.
    """
    path, out = fresh_path(spark, "late"), fresh_path(spark, "late-counts")
    events = table(spark, sf, "events")
    newer = F.col("ts") >= F.to_timestamp_ntz(F.lit(HALF))
    for part in (events.where(newer), events.where(~newer), monitoring.end_rows(events, "ts")):
        part.write.mode("append").parquet(path)
        arriving = monitoring.event_time(spark.readStream.schema(events.schema).parquet(path))
        counts = monitoring.windowed_counts(arriving, "ts", "event_type", "1 day")
        start(counts, out, f"{out}-checkpoint").awaitTermination()
    found = spark.read.schema(counts.schema).parquet(out)
    return found.select(_stamp("window_start").alias("window_start"), "label", "n")
