from __future__ import annotations

import json
import math
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ticketloom import jobs
from ticketloom.operators import alerts, drift
from ticketloom.operators.classifiers import fit_text_model, save_model
from ticketloom.operators.synthetic import synthetic_corpus
from ticketloom.plans.views import stream as table_stream
from ticketloom.session import fresh_path
from ticketloom.streaming import monitoring
from ticketloom.streaming.runner import drain, drain_table, start
from ticketloom.streaming.scoring import log_records, score_and_route


def events(spark, n, minutes=1):
    return spark.range(n).select(
        "id",
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60 * minutes).alias("ts"),
        F.when(F.col("id") % 3 == 0, "needs_review").otherwise("billing").alias("label"),
    )


def source(spark, df, parts=1):
    path = fresh_path(spark, "source")
    for i in range(parts):
        df.where(F.col("id") % parts == i).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def test_closed_windows_equal_the_batch(spark):
    df = events(spark, 300)
    flagged = F.col("label") == "needs_review"
    stream = monitoring.event_time(source(spark, df, 3))
    got = rows(drain_table(monitoring.windowed_rate(stream, "ts", flagged, "1 hour", "5 minutes"), "w"), "window_start")
    batch = alerts.window_rate(df, "ts", flagged, "1 hour", "5 minutes")
    last = df.agg(F.max("ts")).first()[0]
    want = rows(batch.where(F.col("window_end") <= F.lit(last) - F.expr("INTERVAL 15 MINUTES")), "window_start")
    assert got == want and len(got) > 50


def test_end_marker_closes_every_window(spark):
    df = events(spark, 300)
    stream = source(spark, df, 3).unionByName(monitoring.end_marker(df, "ts"))
    flagged = F.col("label") == "needs_review"
    for slide in (None, "5 minutes"):
        rates = monitoring.windowed_rate(monitoring.event_time(stream), "ts", flagged, "1 hour", slide)
        got = rows(drain_table(rates, "all-windows"), "window_start")
        assert got == rows(alerts.window_rate(df, "ts", flagged, "1 hour", slide), "window_start")


def test_restart_continues_without_repeating(spark):
    path = fresh_path(spark, "source")
    df = events(spark, 200)
    df.where("id < 100").write.parquet(path)
    stream = spark.readStream.schema(df.schema).parquet(path)
    out = fresh_path(spark, "sink")
    start(stream, out, out + "-checkpoint").awaitTermination()
    df.where("id >= 100").write.mode("append").parquet(path)
    start(stream, out, out + "-checkpoint").awaitTermination()
    assert spark.read.parquet(out).count() == 200


def test_held_alert_state_crosses_batches(spark):
    rates = [0.3, 0.3, 0.3, 0.3, 0.1, 0.3, 0.3, 0.3, 0.3, 0.3]
    data = [(i, "A", r) for i, r in enumerate(rates)]
    df = spark.createDataFrame(data, "id long, alert string, rate double").withColumn(
        "window_end", F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 300)
    )
    path = fresh_path(spark, "rates")
    for low, high in ((0, 2), (2, 6), (6, 10)):
        df.where(F.col("id").between(low, high - 1)).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    held = monitoring.held_alert_stream(stream.select("alert", "window_end", "rate"), 0.2, "15 minutes", "5 minutes")
    got = [r["firing"] for r in drain_table(held, "held").orderBy("window_end").collect()]
    batch = alerts.held_alerts(df, 0.2, "15 minutes", "5 minutes").orderBy("window_end")
    assert got == [r["firing"] for r in batch.collect()]
    assert got == [False, False, False, True, False, False, False, False, True, True]


def test_held_alert_ends_when_traffic_stops(spark):
    path = fresh_path(spark, "rates")

    def put(*rows):
        data = [(alert, 1704067200 + 300 * at, rate) for alert, at, rate in rows]
        df = spark.createDataFrame(data, "alert string, at long, rate double")
        df.select("alert", F.timestamp_seconds("at").alias("window_end"), "rate").coalesce(1).write.mode("append").parquet(path)

    # A fires and falls silent, B is low and falls silent, C goes on, A comes back high much later
    put(*[("A", i, 0.3) for i in range(5)], *[("B", i, 0.1) for i in range(5)], ("C", 4, 0.3))
    put(*[("C", i, 0.3) for i in range(5, 9)])
    put(("C", 9, 0.3))
    put(("A", 20, 0.3), ("C", 10, 0.1))
    stream = spark.readStream.schema("alert string, window_end timestamp, rate double").option("maxFilesPerTrigger", 1).parquet(path)
    timed = monitoring.held_alert_stream(stream.withWatermark("window_end", "0 seconds"), 0.2, "15 minutes", "5 minutes", resolve=True)
    got = drain_table(timed, "timed").select("alert", ((F.unix_timestamp("window_end") - 1704067200) / 300).cast("int").alias("at"), "rate", "firing")
    found = {alert: sorted((r["at"], r["rate"], r["firing"]) for r in got.where(F.col("alert") == alert).collect()) for alert in "ABC"}
    assert found["A"] == [*[(i, 0.3, i >= 3) for i in range(5)], (5, None, False), (20, 0.3, False)]
    assert found["B"] == [(i, 0.1, False) for i in range(5)]
    assert [(at, firing) for at, _, firing in found["C"]][:6] == [(i, i >= 7) for i in range(4, 10)]


def test_drift_is_judged_inside_the_stream(spark, tmp_path):
    labels = ["a"] * 6 + ["b"] * 3 + [None]
    data = [(day, i, labels[(i * (1 + day)) % 10] if day < 2 else "new") for day in range(3) for i in range(300 if day else 50)]
    df = spark.createDataFrame(data, "day long, i long, label string").select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("day") * 86400 + F.col("i")).alias("ts"), "label", F.col("i").alias("id")
    )
    end = monitoring.end_rows(df, "ts").fillna({"id": 0})
    reference = spark.createDataFrame([(x,) for x in labels], "label string")
    out = str(tmp_path / "verdicts")
    jobs.watch_drift(source(spark, df.unionByName(end)), reference, "1 day", out).awaitTermination()
    got = spark.read.parquet(out).orderBy("window_start").collect()
    shares = drift.label_shares(reference, "label")
    current = drift.label_shares(df.withColumn("day", F.date_trunc("day", "ts")), "label", ("day",))
    batch = drift.js_distance(shares, current, ("day",)).orderBy("day").collect()
    assert [r["rows"] for r in got] == [50, 300, 300] == [r["rows"] for r in batch]
    assert [r["distance"] for r in got] == pytest.approx([r["distance"] for r in batch], abs=1e-7)
    assert [(r["status"], r["drifted"]) for r in got] == [("insufficient_data", None), ("ok", got[1]["distance"] > 0.1), ("ok", True)]
    assert got[2]["distance"] == pytest.approx(math.log(2) ** 0.5)


def test_score_route_quarantine_and_log(spark):
    texts = synthetic_corpus(spark.range(300), "id")
    model = fit_text_model(texts, "complementnb", key="id")
    messages = spark.createDataFrame(
        [(0, "  "), (1, ""), (2, "x" * 5001), (3, "The GOLD bill shows 12 euro more, mail a@b.co"), (4, "card 4111 1111 1111 1111 never reached me")],
        "id long, text string",
    ).withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400))
    stream = source(spark, messages)
    routed = score_and_route(stream, model, threshold=1.01)
    got = {r["id"]: r for r in drain_table(routed.drop("all_scores"), "routed").collect()}
    assert [got[i]["reason"] for i in range(5)] == ["blank", "empty", "too_long", None, None]
    assert got[3]["label"] == "needs_review" and got[3]["predicted_label"] == "billing"
    assert got[0]["label"] is None and got[0]["status"] == "quarantined"
    assert got[2]["text"] == "x" * 5001
    path = drain(log_records(score_and_route(source(spark, messages), model)), "log", "json", ("dt",))
    lines = [json.loads(x) for f in Path(path).rglob("*.json") for x in f.read_text().splitlines()]
    assert {x["label"] for x in lines} <= set(model.head.classes) and len(lines) == 2
    shown = " ".join(x["text"] for x in lines)
    assert "[email]" in shown and "[number]" in shown and "4111" not in shown and "GOLD" not in shown
    batch = score_and_route(messages, model).where("status = 'accepted'").first()
    assert abs(sum(batch["all_scores"].values()) - 1) < 1e-9 and set(batch["all_scores"]) == set(model.head.classes)
    raw = log_records(score_and_route(messages, model), redacted=False)
    assert raw.where(F.contains("text", F.lit("a@b.co"))).count() == 1


def test_stream_jobs_serve_log_and_watch(spark, tmp_path):
    texts = synthetic_corpus(spark.range(200), "id")
    model, out = str(tmp_path / "model"), str(tmp_path / "served")
    save_model(fit_text_model(texts, "complementnb", key="id"), model)
    rows_in = texts.select("id", F.when(F.col("id") % 50 == 0, " ").otherwise(F.col("text")).alias("text"))
    rows_in = rows_in.withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 60))
    jobs.serve(source(spark, rows_in), model, out).awaitTermination()
    served = spark.read.parquet(out)
    counts = {r["status"]: r["count"] for r in served.groupBy("status").count().collect()}
    assert counts == {"accepted": 196, "quarantined": 4}
    assert served.where("status = 'quarantined'").first()["reason"] == "blank"
    jobs.keep_log(spark, out, str(tmp_path / "log")).awaitTermination()
    assert spark.read.json(str(tmp_path / "log")).count() == 196
    accepted = spark.readStream.schema(served.schema).parquet(out).where("status = 'accepted'").select("ts", "label")
    accepted = accepted.unionByName(monitoring.end_marker(served.select("ts", "label"), "ts"))
    watched = str(tmp_path / "watched")
    for query in jobs.watch(accepted, "ReviewRateHigh", F.col("label") == "needs_review", 0.0, "10 minutes", "1 hour", "5 minutes", watched):
        query.awaitTermination()
    rates = spark.read.parquet(f"{watched}/rates")
    batch = alerts.window_rate(served.where("status = 'accepted'"), "ts", F.col("label") == "needs_review", "1 hour", "5 minutes")
    assert rates.count() == batch.count() == spark.read.parquet(f"{watched}/alerts").count()


def test_a_table_in_a_folder_of_files_is_streamed_whole(spark):
    sf = fresh_path(spark, "tables")
    df = events(spark, 60)
    df.repartition(3).write.parquet(f"{sf}/several.parquet")
    spark.range(5).write.parquet(f"{sf}/other.parquet")
    assert rows(drain_table(table_stream(spark, sf, "several"), "several"), "id") == rows(df, "id")


def test_prediction_log_query_on_folders_and_without_tickets(spark):
    texts = ["refund my card please", "the card was lost", "app crashes on start", "login page crashes"] * 3
    docs = [(i, t, "en", "web", len(t)) for i, t in enumerate(texts)]
    said = [(c, 1, role, f"card lost {c}") for c in range(4) for role in ("user", "assistant")]
    for kept, want in (("role IS NOT NULL", 4), ("role = 'assistant'", 0)):
        sf = fresh_path(spark, "tables")
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(i, (i // 2) % 2, 0) for i in range(len(docs))], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
        talk = spark.createDataFrame(said, "conv_id long, turn long, role string, text string").where(kept)
        talk.repartition(2).write.parquet(f"{sf}/conversations.parquet")
        log = entry.queries()["s06_prediction_log_stream"](spark, sf)
        assert log.columns == ["ts", "text", "label", "dt"] and log.count() == want
