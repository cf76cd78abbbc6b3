from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from ticketloom.operators import retention
from ticketloom.sources import commits, corpus, logs, reports


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_files_are_tagged_by_stem(spark, tmp_path):
    write(tmp_path / "train.csv", ["text,category", '"a ""quoted""\nsecond line",x', "NA,y"])
    write(tmp_path / "test.csv", ["text,category", "plain,x"])
    df = corpus.scan_corpus(spark, [str(tmp_path / "train.csv"), str(tmp_path / "test.csv")], multiline=True)
    assert sorted(rows(df)) == [("NA", "y", "train"), ('a "quoted"\nsecond line', "x", "train"), ("plain", "x", "test")]


def test_sheets_name_their_rater(spark, tmp_path):
    write(tmp_path / "ann lee.csv", ["intent,queue", "i1, Billing ", "i2,"])
    write(tmp_path / "bo.csv", ["intent,queue", "i1,general"])
    got = sorted(rows(corpus.scan_sheets(spark, str(tmp_path))))
    assert got == [("ann lee", "i1", "billing"), ("ann lee", "i2", ""), ("bo", "i1", "general")]


def test_messages_are_text_with_blanks_filled(spark, tmp_path):
    write(tmp_path / "m.csv", ["text,label,language_style,author", "007,,english,", ""])
    got = rows(corpus.scan_text(spark, str(tmp_path / "m.csv"), corpus.MESSAGE_SCHEMA))
    assert got == [("007", "", "english", "")]


def test_log_reads_rotated_files_and_skips_blank_lines(spark, tmp_path):
    line = json.dumps({"ts": "2024-01-01T00:00:00Z", "text": "é", "label": "q"})
    write(tmp_path / "log" / "p.jsonl", [line, "", line])
    write(tmp_path / "log" / "p.jsonl.1", [line, "   "])
    log = logs.load_predictions(spark, str(tmp_path / "log"))
    assert log.count() == 3 and log.select("text", "label").distinct().count() == 1


def test_broken_log_line_fails(spark, tmp_path):
    write(tmp_path / "log" / "p.jsonl", ['{"ts": "2024-01-01T00:00:00Z", "text": "a", "label": "q"}', '{"text": '])
    with pytest.raises(Exception, match="MALFORMED_RECORD|malformed|Malformed"):
        logs.scan_log(spark, str(tmp_path / "log")).collect()


def test_no_rows_is_not_rows(spark, tmp_path):
    assert logs.load_predictions(spark, str(tmp_path / "absent")) is None
    write(tmp_path / "log" / "p.jsonl", [""])
    assert logs.load_predictions(spark, str(tmp_path / "log")) is None


def test_current_source_order(spark, tmp_path):
    frame = spark.createDataFrame([("t", "l")], "text string, label string")
    line = json.dumps({"ts": "2024-01-01T00:00:00Z", "text": "a", "label": "q"})
    write(tmp_path / "log" / "p.jsonl", [line])
    log, none = str(tmp_path / "log"), str(tmp_path / "absent")

    def source(*args):
        return logs.resolve_current(spark, *args).first()["current_source"]

    assert source(frame, "mine.csv", log, frame) == "mine.csv"
    assert source(None, "", log, frame) == logs.SOURCE_PREDICTION_LOG
    assert source(None, "", none, frame) == logs.SOURCE_TEST_SPLIT


def test_split_read_lists_one_folder(spark, tmp_path):
    df = spark.range(20).select("id", F.when(F.col("id") % 4 == 0, "test").otherwise("train").alias("split"))
    corpus.write_splits(df, str(tmp_path / "d"))
    side = corpus.read_split(spark, str(tmp_path / "d"), "test")
    assert side.columns == ["id"] and side.count() == 5
    assert "PartitionFilters: [isnotnull(split" in plan(side)


def test_reports_nest(spark, tmp_path):
    per_class = spark.createDataFrame(
        [("a", 1.0, 0.5, 0.75, 2), ("b", 0.5, 0.25, 0.25, 6)],
        "class string, precision double, recall double, f1 double, support long",
    )
    summary = spark.createDataFrame([(0.5, 0.66)], "accuracy double, f1_macro double")
    reports.write_document(reports.metrics_document(summary, per_class), str(tmp_path / "r"))
    files = list((tmp_path / "r").glob("part-*"))
    assert len(files) == 1 and files[0].stat().st_size > 0
    assert json.loads(spark.read.text(str(tmp_path / "r")).first()["value"]) == {
        "summary": {"accuracy": 0.5, "f1_macro": 0.66},
        "accuracy": 0.5,
        "per_class": {
            "a": {"precision": 1.0, "recall": 0.5, "f1-score": 0.75, "support": 2},
            "b": {"precision": 0.5, "recall": 0.25, "f1-score": 0.25, "support": 6},
        },
        "macro avg": {"precision": 0.75, "recall": 0.375, "f1-score": 0.5, "support": 8},
        "weighted avg": {"precision": 0.625, "recall": 0.3125, "f1-score": 0.375, "support": 8},
    }


def test_columns_are_found_by_name(spark, tmp_path):
    write(tmp_path / "a.csv", ["category,extra,text", "x,1,hello"])
    assert rows(corpus.scan_corpus(spark, [str(tmp_path / "a.csv")])) == [("hello", "x", "a")]
    write(tmp_path / "b.csv", ["text,kind", "hello,x"])
    with pytest.raises(ValueError, match="category"):
        corpus.scan_corpus(spark, [str(tmp_path / "b.csv")])


def test_plain_files_are_read_in_splits(spark, tmp_path):
    write(tmp_path / "big.csv", ["text,category", *[f"row {i} {'x' * 90},c" for i in range(20_000)]])
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        path = [str(tmp_path / "big.csv")]
        assert corpus.scan_corpus(spark, path).rdd.getNumPartitions() > 4
        assert corpus.scan_corpus(spark, path).count() == 20_000
        assert corpus.scan_corpus(spark, path, multiline=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


def test_log_days_are_pruned(spark, tmp_path):
    log = spark.range(3).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400).alias("ts"), F.lit("t").alias("text"), F.lit("l").alias("label")
    )
    logs.write_log(log, str(tmp_path / "log"))
    day = logs.scan_log(spark, str(tmp_path / "log")).where("dt = date'2024-01-02'")
    assert day.count() == 1 and "PartitionFilters: [isnotnull(dt" in plan(day)


def test_headers_in_another_order_are_put_together_by_name(spark, tmp_path):
    write(tmp_path / "a b.csv", ["intent,queue", "i1, Billing ", "i2,"])
    write(tmp_path / "bo.csv", ["queue,note,intent", "general,why not,i1"])
    write(tmp_path / "cy.csv", ["intent,queue", "i3,general"])
    (tmp_path / "blank.csv").write_text("")
    got = sorted(rows(corpus.scan_sheets(spark, str(tmp_path))))
    assert got == [("a b", "i1", "billing"), ("a b", "i2", ""), ("bo", "i1", "general"), ("cy", "i3", "general")]
    groups = corpus.files_by_header(spark, f"{tmp_path}/*.csv")
    assert [[f.rsplit("/", 1)[1] for f in g] for g in groups] == [["a b.csv", "cy.csv"], ["bo.csv"]]
    write(tmp_path / "dee.csv", ["intent,kue", "i1,general"])
    with pytest.raises(ValueError, match=r"missing columns \['queue'\].*dee.csv"):
        corpus.scan_sheets(spark, str(tmp_path))


def test_retention_hides_days_at_once_and_deletes_them_a_run_later(spark, tmp_path):
    path = str(tmp_path / "log")
    assert logs.prune_log(spark, path, 1) == []
    days = [f"2024-01-0{d}" for d in range(1, 7)]
    log = spark.createDataFrame([(f"{d} 08:00:00", f"text {i}", "billing") for d in days for i in range(10)], "ts string, text string, label string")
    logs.write_log(log.withColumn("ts", F.col("ts").cast("timestamp")), path)
    size = {p.parent.name: 0 for p in (tmp_path / "log").rglob("*.json")}
    for p in (tmp_path / "log").rglob("*.json"):
        size[p.parent.name] += p.stat().st_size
    per_day = size["dt=2024-01-01"]
    assert set(size.values()) == {per_day}

    before = logs.scan_live(spark, path)
    assert logs.prune_log(spark, path, 2 * per_day + 1) == []
    # a reader from before finds all its files, a new one sees the kept days only
    assert before.count() == 60
    live = logs.scan_live(spark, path)
    assert sorted({r[0] for r in live.select(F.col("dt").cast("string")).distinct().collect()}) == days[3:]
    assert "dt" in plan(live).split("PartitionFilters", 1)[1]
    assert logs.load_predictions(spark, path).count() == 30

    # the same sizes by lines, as the query has them
    lines = spark.read.text(f"{path}/dt=*").withColumn("day", F.regexp_extract(F.input_file_name(), "dt=([0-9-]+)", 1))
    kept = retention.retained_days(lines, F.col("day"), F.col("value"), 2 * per_day + 1)
    assert sorted(r["day"] for r in kept.collect()) == days[3:]

    assert logs.prune_log(spark, path, 10 * per_day) == days[:3]
    assert live.count() == 30 and logs.scan_live(spark, path).count() == 30
    assert logs.first_days(spark, path) == [days[3], days[3]]
    assert sorted(p.name for p in (tmp_path / "log").glob("dt=*")) == [f"dt={d}" for d in days[3:]]


def test_commits_of_writers_that_meet(spark, tmp_path):
    folder = str(tmp_path / "commits")
    assert commits.numbers(spark, folder) == [] and commits.read(spark, folder, "n long").count() == 0
    assert commits.put_if_absent(spark, folder, 1, {"n": 1}) and not commits.put_if_absent(spark, folder, 1, {"n": 9})
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: commits.append(spark, folder, lambda n: {"n": n}), range(16)))
    assert sorted(got) == list(range(2, 18))
    assert sorted(r["n"] for r in commits.read(spark, folder, "n long").collect()) == list(range(1, 18))
    assert not list((tmp_path / "commits").glob(".[!.]*"))
