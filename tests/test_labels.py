from __future__ import annotations

import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from ticketloom.functions.hashing import uniform
from ticketloom.operators import alerts, drift, percentiles, ranks, raters, registry, retention, sampling

QUEUES = ["a", "b", "c"]


def ratings_frame(spark, table):
    data = [(item, r, q) for item, line in table.items() for r, q in line.items()]
    return spark.createDataFrame(data, "item string, rater string, queue string")


def test_identical_raters_agree_fully(spark):
    table = {str(i): {r: QUEUES[i % 3] for r in ("x", "y")} for i in range(9)}
    wide = raters.wide_ratings(ratings_frame(spark, table), ["x", "y"])
    assert raters.cohen_kappa(wide, ["x", "y"]).first()["kappa"] == 1.0
    assert raters.fleiss_kappa(wide, ["x", "y"], QUEUES).first()["fleiss_kappa"] == 1.0
    assert tuple(raters.dispute_counts(wide, ["x", "y"]).first()) == (9, 9, 0)


def test_kappa_against_pairs_of_rows(spark):
    rng = random.Random(3)
    names = ["author", "r1", "r2", "r3"]
    table = {str(i): {r: rng.choice(QUEUES) if rng.random() < 0.4 else QUEUES[i % 3] for r in names} for i in range(120)}
    wide = raters.wide_ratings(ratings_frame(spark, table), names)
    got = {(r["rater_a"], r["rater_b"]): r["kappa"] for r in raters.cohen_kappa(wide, names).collect()}
    for a, b in combinations(names, 2):
        n = len(table)
        po = sum(t[a] == t[b] for t in table.values()) / n
        ca, cb = Counter(t[a] for t in table.values()), Counter(t[b] for t in table.values())
        pe = sum(ca[q] * cb[q] for q in QUEUES) / n**2
        assert got[a, b] == pytest.approx((po - pe) / (1 - pe))
    counts = np.array([[list(t.values()).count(q) for q in QUEUES] for t in table.values()])
    p = counts.sum(0) / counts.sum()
    po = np.mean((np.sum(counts**2, 1) - 4) / 12)
    want = (po - np.sum(p**2)) / (1 - np.sum(p**2))
    assert raters.fleiss_kappa(wide, names, QUEUES).first()["fleiss_kappa"] == pytest.approx(want)


def test_kappa_is_unknown_when_chance_agreement_is_one(spark):
    wide = raters.wide_ratings(ratings_frame(spark, {"1": {"x": "a", "y": "a"}}), ["x", "y"])
    assert raters.cohen_kappa(wide, ["x", "y"]).first()["kappa"] is None


def test_majority_and_ties(spark):
    table = {
        "clear": {"author": "a", "r1": "b", "r2": "b"},
        "three_way": {"author": "c", "r1": "a", "r2": "b"},
        "same": {"author": "a", "r1": "a", "r2": "b"},
    }
    wide = raters.wide_ratings(ratings_frame(spark, table), ["author", "r1", "r2"])
    got = dict(rows(raters.majority_vote(wide, ["author", "r1", "r2"], "author", QUEUES)))
    assert got == {"clear": "b", "three_way": "c", "same": "a"}


def test_tie_without_the_author_keeps_the_author(spark):
    table = {"i": {"author": "c", "r1": "a", "r2": "a", "r3": "b", "r4": "b"}}
    names = ["author", "r1", "r2", "r3", "r4"]
    wide = raters.wide_ratings(ratings_frame(spark, table), names)
    assert raters.majority_vote(wide, names, "author", QUEUES).first()["queue"] == "c"


def test_sheet_problems(spark):
    items = spark.createDataFrame([("1",), ("2",), ("3",)], "item string")
    sheet = ratings_frame(spark, {"1": {"x": "a", "y": ""}, "2": {"x": "zz", "y": "b"}})
    got = rows(raters.sheet_problems(items, sheet, ["x", "y"], QUEUES), "item", "rater")
    assert got == [("1", "y", "missing"), ("2", "x", "unknown queue zz"), ("3", "x", "missing"), ("3", "y", "missing")]


def test_no_pairs_of_rows_in_rater_plans(spark):
    frame = ratings_frame(spark, {"1": {"x": "a", "y": "b"}})
    text = plan(raters.pair_agreement(raters.wide_ratings(frame, ["x", "y"]), ["x", "y"]))
    assert "Join" not in text


def test_split_is_exact_per_label_and_ignores_partitions(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 700, "big").otherwise("small").alias("label"))
    for buckets in (4, 65536):
        split = sampling.stratified_split(df, "label", "id", 0.2, buckets=buckets)
        counts = dict(rows(split.where("split = 'test'").groupBy("label").count()))
        assert counts == {"big": 140, "small": 60}
    one = {r["id"] for r in split.where("split = 'test'").collect()}
    two = {r["id"] for r in sampling.stratified_split(df.repartition(13), "label", "id", 0.2).where("split = 'test'").collect()}
    renamed = df.withColumn("label", F.concat(F.lit("new_"), "label"))
    three = {r["id"] for r in sampling.stratified_split(renamed, "label", "id", 0.2).where("split = 'test'").collect()}
    assert one == two == three


def test_split_with_a_null_label_and_an_empty_side(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id int, label string")
    got = {r["id"]: r["split"] for r in sampling.stratified_split(df, "label", "id", 0.5).collect()}
    assert sorted(got) == [1, 2, 3] and sorted([got[1], got[2]]) == ["test", "train"]


def test_copies_stay_on_one_side(spark):
    df = spark.range(900).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("key"), F.lit("l").alias("label"))
    sides = sampling.stratified_split(df, "label", "key", 0.3).groupBy("key").agg(F.countDistinct("split").alias("n"))
    assert sides.where("n > 1").count() == 0


@pytest.mark.parametrize("n", [0, 1, 100, 250, 899, 900, 2000])
def test_sample_is_exact_even_with_a_hot_key(spark, n):
    df = spark.range(900).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("key"))
    assert sampling.sample_rows(df, "key", n).count() == min(n, 900)


def test_sample_equals_the_sorted_prefix(spark):
    df = spark.range(500)
    want = {r["id"] for r in df.orderBy(uniform(42, "id"), "id").limit(77).collect()}
    for buckets in (8, 65536):
        assert {r["id"] for r in sampling.sample_rows(df, "id", 77, buckets=buckets).collect()} == want


def test_annotation_sheet(spark):
    df = spark.createDataFrame([(i, intent, f"{intent}{i}") for i in range(4) for intent in ("Zeta", "alpha")] + [(9, "one", "only")], "id int, intent string, text string")
    sheet = sampling.annotation_sheet(df, "intent", "text", "id")
    assert sheet.columns == ["intent", "example_1", "example_2", "example_3", "queue"]
    got = {r["intent"]: r for r in sheet.collect()}
    assert got["one"]["example_1"] == "only" and got["one"]["example_2"] is None
    assert len({got["Zeta"][f"example_{i}"] for i in (1, 2, 3)}) == 3
    assert [r["intent"] for r in sampling.by_name(sheet, "intent").collect()] == ["alpha", "one", "Zeta"]
    picks = sampling.picks_per_group(df, "intent", "id")
    assert plan(picks).count("WindowGroupLimit") >= 2  # before and after the shuffle
    assert "BroadcastHashJoin" in plan(sheet)


def sequential_gate(history):
    incumbent, out = None, []
    for metric, source in history:
        promoted = incumbent is None or incumbent[1] != source or metric > incumbent[0]
        incumbent = (metric, source) if promoted else incumbent
        out.append(promoted)
    return out


def test_promotion_replay_is_the_sequential_rule(spark):
    rng = random.Random(8)
    data, want = [], {}
    for m in range(150):
        history = [(rng.choice([0.1, 0.2, 0.3, 0.4]), rng.choice("ab")) for _ in range(rng.randint(1, 9))]
        want[f"m{m}"] = sequential_gate(history)
        data += [(f"m{m}", v + 1, f, s) for v, (f, s) in enumerate(history)]
    df = spark.createDataFrame(data, "model string, version int, f1_macro double, data_source string")
    got: dict = {}
    for r in registry.promotion_replay(df).orderBy("model", "version").collect():
        got.setdefault(r["model"], []).append(r["promoted"])
    assert got == want


def test_latest_version_is_numeric(spark):
    df = spark.createDataFrame([("m", "9", 0.1), ("m", "10", 0.2)], "model string, version string, f1_macro double")
    assert tuple(registry.latest_version(df).first()) == ("m", 10, 0.2)


@pytest.mark.parametrize("shape", ["normal", "ties", "two", "one", "huge", "ten", "many"])
def test_percentiles_are_exact(spark, shape):
    rng = np.random.default_rng(4)
    data = {
        "normal": rng.normal(size=701),
        "ties": np.concatenate([np.full(300, 7.0), rng.integers(0, 12, 401).astype(float)]),
        "two": np.array([1.0] * 40 + [2.0] * 60),
        "one": np.full(90, 3.5),
        "ten": rng.normal(size=10),
        "many": rng.normal(size=100_000),
        "huge": np.concatenate([[-1e300, 1e300], rng.exponential(size=99)]),
    }[shape]
    df = spark.createDataFrame([(float(x),) for x in data], "x double").repartition(3)
    row = percentiles.latency_summary(df, "x").first()
    want = np.percentile(data, [50, 95, 99])
    assert row["n"] == len(data)
    assert [row["p50"], row["p95"], row["p99"]] == pytest.approx(list(want))


def test_percentiles_of_nothing_are_unknown(spark):
    assert tuple(percentiles.latency_summary(spark.createDataFrame([], "x double"), "x").first()) == (0, None, None, None, None)


def test_percentiles_leave_nan_out(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), *[(nan,)] * 5], "x double")
    row = percentiles.latency_summary(df, "x").first()
    assert (row["n"], row["mean"], row["p50"]) == (2, 1.5, 1.5)
    assert percentiles.latency_summary(df.where("isnan(x)"), "x").first()["n"] == 0


def shares(spark, counts):
    df = spark.createDataFrame([(k,) for k, n in counts.items() for _ in range(n)], "label string")
    return drift.label_shares(df, "label")


def test_js_distance(spark):
    same = drift.js_distance(shares(spark, {"a": 3, "b": 1}), shares(spark, {"a": 6, "b": 2})).first()["distance"]
    apart = drift.js_distance(shares(spark, {"a": 3}), shares(spark, {"b": 2})).first()["distance"]
    partly = drift.js_distance(shares(spark, {"a": 1, "b": 1}), shares(spark, {"a": 1, "c": 3})).first()["distance"]
    assert same == pytest.approx(0, abs=1e-9) and apart == pytest.approx(np.log(2) ** 0.5)
    p, q = np.array([0.5, 0.5, 0]), np.array([0.25, 0, 0.75])
    m = (p + q) / 2
    kl = lambda x: sum(a * np.log(a / b) for a, b in zip(x, m, strict=True) if a > 0)
    assert partly == pytest.approx(((kl(p) + kl(q)) / 2) ** 0.5)


def test_aligned_shares_fill_absent_labels(spark):
    aligned = drift.align(shares(spark, {"a": 1}), shares(spark, {"b": 1}))
    assert rows(aligned, "label") == [("a", 1.0, 0.0), ("b", 0.0, 1.0)]


@pytest.mark.parametrize(
    ("scores", "n", "status", "dataset"),
    [
        ([(0.17, 0.1), (0.99, 0.55)], 5, "insufficient_data", None),
        ([(0.0003, 0.1), (0.5089, 0.55)], 2617, "ok", False),
        ([(0.0003, 0.1), (0.9969, 0.55)], 200, "ok", False),  # a share of exactly one half
        ([(0.17, 0.1), (0.99, 0.55)], 200, "ok", True),
        ([(0.17, 0.1), (0.99, 0.55)], 199, "insufficient_data", None),
    ],
)
def test_drift_summary(spark, scores, n, status, dataset):
    df = spark.createDataFrame([(str(i), s, t, n) for i, (s, t) in enumerate(scores)], "column string, score double, threshold double, rows long")
    row = drift.drift_summary(df).first()
    assert (row["status"], row["dataset_drifted"], row["columns_checked"]) == (status, dataset, len(scores))
    verdicts = [r["drifted"] for r in drift.column_verdicts(df).orderBy("column").collect()]
    assert verdicts == [None if n < 200 else s > t for s, t in scores]


def test_score_at_its_threshold_is_not_drift(spark):
    df = spark.createDataFrame([("x", 0.1, 0.1, 500)], "column string, score double, threshold double, rows long")
    assert drift.column_verdicts(df).first()["drifted"] is False


def test_retention_keeps_newest_days_within_budget(spark):
    df = spark.createDataFrame([(d, "x" * 9) for d in ("d1", "d2", "d3") for _ in range(10)], "day string, line string")
    kept = retention.retain(df, F.col("day"), F.col("line"), 150)
    assert {r["day"] for r in kept.collect()} == {"d2", "d3"} and kept.count() == 20
    assert "BroadcastHashJoin" in plan(kept)


def test_held_alert_needs_its_time(spark):
    highs = [1, 1, 1, 1, 0, 1, 1, None, 1, 1, 1, 1]  # None: no traffic, no row
    data = [("a", f"2024-01-01 00:{5 * i:02d}:00", float(h)) for i, h in enumerate(highs) if h is not None]
    df = spark.createDataFrame(data, "alert string, e string, rate double").withColumn("window_end", F.to_timestamp("e"))
    held = alerts.held_alerts(df, 0.2, "15 minutes", "5 minutes").orderBy("window_end")
    assert [r["firing"] for r in held.collect()] == [False, False, False, True, False, False, False, False, False, False, True]


def test_rate_at_the_limit_is_not_high(spark):
    df = spark.createDataFrame([("a", 0.2), ("a", 0.20001)], "alert string, rate double").withColumn("window_end", F.current_timestamp())
    assert sorted(r["high"] for r in alerts.held_alerts(df, 0.2, "0 minutes", "5 minutes").collect()) == [False, True]


def test_published_label_drift(spark):
    # label counts behind the published score, rebuilt from published support columns
    train = {"billing": 3945, "technical": 1615, "account": 2200, "card_delivery": 750, "general": 1495}
    test = {"billing": 1000, "technical": 560, "account": 760, "card_delivery": 240, "general": 520}

    def frame(counts):
        total = sum(counts.values())
        data = [(k, n, n / total) for k, n in counts.items()]
        return spark.createDataFrame(data, "label string, n long, share double")

    row = drift.js_distance(frame(train), frame(test)).first()
    assert row["rows"] == 3080 and row["distance"] == pytest.approx(0.051817, abs=2e-4)


def test_unknown_labels_are_a_label_of_their_own(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), (None,)], "label string")
    one = drift.label_shares(df, "label")
    assert drift.js_distance(one, one).first()["distance"] == pytest.approx(0.0, abs=1e-9)
    assert drift.align(one, one).count() == 3
    assert drift.align(one, one).where("reference_share <> current_share").count() == 0


def test_unknown_score_gives_no_verdict(spark):
    scores = spark.createDataFrame([("text", None, 0.55, 500), ("label", 0.2, 0.1, 500)], "column string, score double, threshold double, rows long")
    found = {r["column"]: r["drifted"] for r in drift.column_verdicts(scores).collect()}
    assert found == {"text": None, "label": True}


def test_grouped_percentiles_are_exact_whatever_the_sketch(spark):
    """Ties, unmeasured values, groups of one row and of none, and sketches so coarse that bounds matter."""
    draw = random.Random(6)
    rows = [("a", draw.gauss(0, 1)) for _ in range(3000)] + [("b", float(draw.randrange(5))) for _ in range(2000)]
    rows += [("c", 7.5), ("d", None), ("d", float("nan")), (None, 1.0), (None, 4.0)] + [("e", -0.5)] * 400
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    by_group = {}
    for g, x in rows:
        by_group.setdefault(g, [])
        if x is not None and not math.isnan(x):
            by_group[g].append(x)
    for accuracy in (100, 300, 100_000):
        found = percentiles.grouped_percentiles(df, "x", ("g",), (0.0, 0.01, 0.5, 0.95, 1.0), accuracy).collect()
        assert {r["g"] for r in found} == set(by_group)
        for r in found:
            values = by_group[r["g"]]
            assert r["n"] == len(values)
            expected = np.percentile(values, [0, 1, 50, 95, 100]) if values else [None] * 5
            assert [r[f"p{p}"] for p in (0, 1, 50, 95, 100)] == (pytest.approx(expected) if values else expected)


def test_percentiles_scan_twice(spark, tmp_path):
    """Once for the sketch, which is a table then, and once for the ranks, by group or not."""
    spark.range(1000).selectExpr("id % 3 AS g", "CAST(id AS double) AS x").write.parquet(f"{tmp_path}/t")
    source = spark.read.parquet(f"{tmp_path}/t")
    for by in ((), ("g",)):
        text = plan(percentiles.grouped_percentiles(source, "x", by))
        assert text.count(f"{tmp_path}/t") == 1


def brute_auc(pairs):
    pos, neg = ([s for s, p in pairs if p is side and s is not None] for side in (True, False))
    if not pos or not neg:
        return None, None
    won = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    n = len(pos) + len(neg)
    ties = sum(t**3 - t for t in Counter(pos + neg).values())
    spread = len(pos) * len(neg) / 12 * (n + 1 - ties / (n * (n - 1)))
    return won / (len(pos) * len(neg)), (won - len(pos) * len(neg) / 2) / spread**0.5 if spread > 0 else None


def test_rank_auc_equals_all_pairs(spark):
    draw = random.Random(5)
    data = {
        "ties": [(float(draw.randint(0, 9)), draw.random() < 0.4) for _ in range(400)],
        "apart": [(draw.gauss(1.0 if hit else 0.0, 1.0), hit) for hit in (draw.random() < 0.2 for _ in range(600))],
        "equal": [(1.5, i % 3 == 0) for i in range(30)],
        "one side": [(draw.random(), True) for _ in range(20)],
        "nulls": [(None, True), (0.5, None), (0.25, False), (0.75, True), (-0.0, True), (0.0, False)],
        None: [(float(i % 7), i % 2 == 0) for i in range(50)],
    }
    rows = [(g, s, p) for g, pairs in data.items() for s, p in pairs]
    df = spark.createDataFrame(rows, "g string, s double, p boolean")
    for parts in (1, 7, 256):
        got = {r["g"]: r for r in ranks.rank_auc(df, "s", F.col("p"), ("g",), parts).collect()}
        assert set(got) == set(data)
        for g, pairs in data.items():
            auc, z = brute_auc([(s, p) for s, p in pairs if p is not None])
            assert got[g]["auc"] == (auc if auc is None else pytest.approx(auc, abs=1e-12)), g
            assert got[g]["z"] == (z if z is None else pytest.approx(z, abs=1e-9)), g
    whole = ranks.rank_auc(df, "s", F.col("p")).first()
    assert whole["auc"] == pytest.approx(brute_auc([(s, p) for _, s, p in rows if p is not None])[0], abs=1e-12)
    assert ranks.rank_auc(df.where("false"), "s", F.col("p"), ("g",)).count() == 0
