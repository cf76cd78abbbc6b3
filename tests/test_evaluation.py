from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from ticketloom.functions.statistics import mcnemar_exact, safe_ratio
from ticketloom.operators import calibration, evaluation, mapping, paired, resampling
from ticketloom.plans.views import pred

# Published confusion table of the model the numbers below belong to.
LABELS = ["account", "billing", "card_delivery", "general", "technical"]
PUBLISHED = [
    [723, 11, 10, 9, 7],
    [11, 960, 0, 15, 14],
    [10, 4, 219, 6, 1],
    [12, 23, 7, 466, 12],
    [8, 15, 2, 15, 520],
]


@pytest.fixture(scope="module")
def published(spark):
    cells = [(LABELS[i], LABELS[j], n) for i, line in enumerate(PUBLISHED) for j, n in enumerate(line) if n]
    return spark.createDataFrame(cells, "truth string, predicted string, n long")


def test_published_scores(published):
    row = evaluation.summary_scores(evaluation.class_scores(published)).first()
    assert row["rows"] == 3080
    assert row["accuracy"] == pytest.approx(0.9376623376623376, abs=1e-12)
    assert row["f1_macro"] == pytest.approx(0.93129732398264, abs=1e-12)
    assert row["precision_macro"] == pytest.approx(0.9329497680486366, abs=1e-12)
    assert row["f1_weighted"] == pytest.approx(0.9375609063763429, abs=1e-12)
    account = evaluation.class_scores(published).where("class = 'account'").first()
    assert (account["precision"], account["recall"], account["support"]) == pytest.approx(
        (0.9463350785340314, 0.9513157894736842, 760)
    )


def test_published_matrix(published):
    matrix = evaluation.confusion_matrix(published, LABELS)
    assert rows(matrix.select("truth", *LABELS), "truth") == [(n, *line) for n, line in zip(LABELS, PUBLISHED, strict=True)]


def test_matrix_has_absent_classes_and_true_rows(spark):
    df = spark.createDataFrame([("b", "a"), ("b", "b")], "y string, p string")
    matrix = evaluation.confusion_matrix(evaluation.confusion_cells(df, "y", "p"), ["a", "b", "c"])
    assert rows(matrix, "truth") == [("a", 0, 0, 0), ("b", 1, 1, 0), ("c", 0, 0, 0)]


def test_class_only_predicted_counts_in_macro(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b")], "y string, p string")
    row = evaluation.score(df, "y", "p").first()
    assert row["f1_macro"] == pytest.approx((2 / 3 + 0) / 2)


def test_slice_domain_is_its_own(spark):
    df = spark.createDataFrame([("x", "a", "a"), ("z", "b", "b"), ("z", "b", "a")], "s string, y string, p string")
    cells = evaluation.with_overall(evaluation.confusion_cells(df, "y", "p", ("s",)), "s")
    scores = evaluation.summary_scores(evaluation.class_scores(cells, ("s",)), ("s",))
    got = {r["s"]: r["f1_macro"] for r in scores.collect()}
    assert got["x"] == 1.0  # class b does not occur there and is not averaged
    assert set(got) == {"x", "z", "overall"}


def test_errors_keep_intent_only_when_present(spark):
    df = spark.createDataFrame([(1, "a", "b", 0.91239), (2, "a", "b", 0.2), (3, "a", "a", 0.1)], "id int, y string, p string, c double")
    wrong = evaluation.errors(df, "y", "p", "c", "id", keep=("intent",))
    assert wrong.columns == ["id", "true_queue", "predicted_queue", "confidence"]
    assert [r["id"] for r in evaluation.least_confident(wrong, "id", 5).collect()] == [2, 1]
    assert wrong.where("id = 1").first()["confidence"] == 0.9124
    assert "intent" in evaluation.errors(df.withColumn("intent", F.lit("i")), "y", "p", "c", "id", keep=("intent",)).columns


def test_majority_tie_goes_to_first(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",)], "y string")
    assert evaluation.majority_class(df, "y").first()["majority_class"] == "a"


def test_coverage_edges(spark):
    df = spark.createDataFrame([(0.9, True), (0.8, False), (0.6, True), (0.5, True)], "c double, ok boolean")
    table = calibration.coverage_table(calibration.threshold_counts(df, F.col("c"), F.col("ok"), (0.5, 0.8, 0.99)))
    assert rows(table, "threshold") == [
        (0.5, 1.0, 0.75, 0, 1),
        (0.8, 0.5, 0.5, 2, 1),
        (0.99, 0.0, None, 4, 0),
    ]


def test_coverage_is_one_aggregate(spark, sf):
    counts = calibration.threshold_counts(pred(spark, sf), F.col("confidence"), F.col("a") == F.col("y"))
    text = plan(counts)
    assert "NestedLoop" not in text and "Cartesian" not in text and "Window" not in text


def test_reliability_edges(spark):
    df = spark.createDataFrame([(1.0, True), (0.95, True), (0.7, False), (0.05, False)], "c double, ok boolean")
    bins = calibration.reliability_table(df, F.col("c"), F.col("ok"))
    got = {round(r["bin_low"], 1): (r["n"], r["accuracy"]) for r in bins.collect()}
    assert got == {0.9: (2, 1.0), 0.7: (1, 0.0), 0.0: (1, 0.0)}
    ece = calibration.expected_calibration_error(bins).first()["ece"]
    assert ece == pytest.approx((2 * 0.025 + 0.7 + 0.05) / 4)


def brute_mcnemar(b, c):
    n, k = b + c, min(b, c)
    return 1.0 if n == 0 else min(1.0, 2 * sum(math.comb(n, i) for i in range(k + 1)) / 2**n)


def test_mcnemar_against_exact_integers(spark):
    pairs = [(0, 0), (0, 1), (1, 0), (5, 5), (0, 20), (3, 17), (40, 61), (500, 610), (2000, 2001), (7, 3000)]
    df = spark.createDataFrame(pairs, "b long, c long").withColumn("p", mcnemar_exact(F.col("b"), F.col("c")))
    for b, c, p in rows(df):
        want = brute_mcnemar(b, c)
        assert p == pytest.approx(want, rel=1e-9), (b, c)


def test_mcnemar_on_large_counts(spark):
    df = spark.createDataFrame([(10**9, 10**9 + 60000)], "b long, c long")
    p = df.select(mcnemar_exact(F.col("b"), F.col("c"))).first()[0]
    z = (60000 - 1) / math.sqrt(2e9 + 60000)
    assert p == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-3)


def test_paired_rows_must_match(spark):
    a = spark.createDataFrame([(1, "x", "x"), (2, "x", "y")], "id int, y string, a string")
    b = spark.createDataFrame([(2, "x"), (1, "y")], "id int, b string")
    assert rows(paired.pair_predictions(a, b, "id"), "id") == [(1, "x", "x", "y"), (2, "x", "y", "x")]
    for other, key in ((b.where("id = 1"), 2), (b.unionByName(b.where("id = 1")), 1)):
        pairs = paired.pair_predictions(a, other, "id")
        for read in (pairs.collect, pairs.count, pairs.select("y", "a").collect):
            with pytest.raises(Exception, match=f"without one partner: {key}"):
                read()


def test_decision_needs_every_condition(spark):
    base = dict(f1_challenger=0.93, f1_incumbent=0.91, p_value=0.01, ece_challenger=0.05, ece_incumbent=0.04, p95=3.0)
    cases = [base, {**base, "f1_challenger": 0.9199}, {**base, "p_value": 0.05}, {**base, "ece_challenger": 0.0601}, {**base, "p95": 5.1}]
    df = spark.createDataFrame([tuple(c.values()) for c in cases], ", ".join(f"{k} double" for k in base))
    assert [r["switch"] for r in paired.decision(df).collect()] == [True, False, False, False, False]
    exact = spark.createDataFrame([(0.92, 0.91, 0.01, 0.05, 0.04, None)], ", ".join(f"{k} double" for k in base))
    row = paired.decision(exact).first()
    assert row["f1_ok"] is True and row["latency_ok"] is False and row["switch"] is False


def test_bootstrap_brackets_point_and_repeats(spark, sf):
    df = pred(spark, sf).select("id", "y", "a")
    point = evaluation.score(df, "y", "a").first()["f1_macro"]
    first = resampling.bootstrap_f1_ci(df, "y", "a", 300).first()
    again = resampling.bootstrap_f1_ci(df.repartition(7), "y", "a", 300).first()
    assert first == again
    assert first["ci_low"] < point < first["ci_high"]
    wide = resampling.bootstrap_f1_ci(df, "y", "a", 300, alpha=0.5).first()
    assert wide["ci_low"] > first["ci_low"] and wide["ci_high"] < first["ci_high"]


def test_bootstrap_law_matches_direct_resampling(spark, sf):
    import numpy as np

    data = [(r["y"], r["a"]) for r in pred(spark, sf).select("y", "a").collect()]
    names = sorted({v for pair in data for v in pair})
    pairs = np.array([(names.index(y), names.index(a)) for y, a in data])
    rng, direct = np.random.default_rng(1), []
    for _ in range(400):
        y, a = pairs[rng.integers(0, len(pairs), len(pairs))].T
        f1 = [2 * np.sum((y == k) & (a == k)) / (np.sum(y == k) + np.sum(a == k)) for k in range(len(names))]
        direct.append(np.mean(f1))
    row = resampling.bootstrap_f1_ci(pred(spark, sf), "y", "a", 1000).first()
    low, high = np.percentile(direct, [2.5, 97.5])
    assert row["ci_low"] == pytest.approx(low, abs=0.006) and row["ci_high"] == pytest.approx(high, abs=0.006)


def test_perfect_predictions_have_a_point_interval(spark):
    df = spark.createDataFrame([(i, str(i % 3), str(i % 3)) for i in range(30)], "id int, y string, p string")
    assert tuple(resampling.bootstrap_f1_ci(df, "y", "p", 50).first()) == (1.0, 1.0)


def test_mapping_lookup_and_unmapped(spark, tmp_path):
    dim = spark.createDataFrame([("i1", "q1"), ("i2", "q1")], "intent string, queue string")
    dim.write.parquet(str(tmp_path / "dim"))
    stored = spark.read.parquet(str(tmp_path / "dim"))
    df = spark.createDataFrame([("i1",), ("i3",), ("i3",)], "intent string")
    folded = mapping.fold(df, stored, "intent", "queue")
    assert sorted(rows(folded), key=str) == [("i1", "q1"), ("i3", None), ("i3", None)]
    assert "BroadcastHashJoin" in plan(mapping.fold(spark.range(10).select(F.concat(F.lit("i"), "id").alias("intent")), stored, "intent", "queue"))
    with pytest.raises(ValueError, match="2 rows"):
        mapping.require_mapped(df, stored, "intent")


def test_mapped_accuracy_is_not_below_fine(spark, sf):
    from ticketloom.plans.evaluation import folded

    row = folded(spark, sf).agg(
        F.avg((F.col("intent") == F.col("predicted_intent")).cast("double")), F.avg((F.col("y") == F.col("mapped")).cast("double"))
    ).first()
    assert row[1] >= row[0]


def test_unknown_ratio_is_null(spark):
    assert spark.range(1).select(safe_ratio(F.lit(0), F.lit(0))).first()[0] is None


def test_leaderboard_margin_is_strict(spark):
    df = spark.createDataFrame([("prod", 0.90), ("m", 0.1), ("x", 0.91)], "model string, f1_macro double")
    row = evaluation.leaderboard(df, "prod", "m").first()
    assert (row["best_alternative"], row["margin"], row["production_beaten"]) == ("x", 0.01, False)


def test_cell_replicates_follow_the_poisson_law(spark):
    """Counts of each cell have the mean and variance of its size, and repeat; F1 brackets the point estimate."""
    cells = spark.createDataFrame([("a", "a", 900), ("a", "b", 25), ("b", "a", 3), ("b", "b", 400)], "truth string, predicted string, n long")
    first = resampling.bootstrap_f1_from_cells(cells, 2000).toPandas().sort_values("replicate")["f1_macro"].to_numpy()
    again = resampling.bootstrap_f1_from_cells(cells.repartition(3), 2000).toPandas().sort_values("replicate")["f1_macro"].to_numpy()
    assert len(first) == 2000 and (first == again).all()
    direct = np.random.default_rng(1).poisson([900, 25, 3, 400], (20_000, 4))
    f1 = (2 * direct[:, 0] / (2 * direct[:, 0] + direct[:, 1] + direct[:, 2]) + 2 * direct[:, 3] / (2 * direct[:, 3] + direct[:, 1] + direct[:, 2])) / 2
    assert first.mean() == pytest.approx(f1.mean(), abs=4 * f1.std() / 2000**0.5)
    assert first.std() == pytest.approx(f1.std(), rel=0.1)
    assert np.percentile(first, [2.5, 97.5]) == pytest.approx(np.percentile(f1, [2.5, 97.5]), abs=0.002)


def drawn_f1(data, names, n_resamples):
    """Macro F1 of replicates in which every (truth, predicted) row counts its own Poisson(1) number, drawn under its name."""
    scores = []
    for r in range(n_resamples):
        support, hits = {}, {}
        for (y, a), name in zip(data, names, strict=True):
            digest = hashlib.md5(f"42|{r // 4}|{name}".encode()).hexdigest()
            u = int(digest[8 * (r % 4) : 8 * (r % 4) + 8], 16) / 2**32
            n = sum(u >= s for s in resampling.poisson_steps())
            for side in (y, a) if n else ():
                support[side] = support.get(side, 0) + n
                hits[side] = hits.get(side, 0) + (n if y == a and y is not None else 0)
        scores.append(np.mean([hits[c] / support[c] for c in support]))
    return scores


@pytest.fixture(scope="module")
def odd_events(spark, tmp_path_factory):
    """Thirty events, some of them twice or three times, some without a type, one type only once."""
    kinds = ["click", "view", "click", "error", None, "view"]
    data = [(i, kinds[i % 6], i) for i in range(29)] + [(29, "purchase", 29)]
    data += [(i, kinds[i % 6], i) for i in (1, 2, 4, 4, 7)]
    events = spark.createDataFrame(data, "event_id long, event_type string, user_id long").withColumns(
        {"ts": F.timestamp_seconds("event_id"), "value": F.lit(1.0), "props": F.lit('{"k": 1}')}
    )
    folder = tmp_path_factory.mktemp("events")
    events.repartition(3).write.parquet(str(folder / "events.parquet"))
    return str(folder)


def test_interval_draws_every_row_a_thousand_times(spark, odd_events):
    import duckdb

    import __spark_entry__ as entry

    found = rows(pred(spark, odd_events).select("id", "y", "a"), "id")
    copies = [sum(r[0] == s[0] for s in found[:i]) for i, r in enumerate(found)]
    names = [f"{r[0]}|{c}" if c else str(r[0]) for r, c in zip(found, copies, strict=True)]
    assert max(copies) == 2 and len(set(names)) == len(found) == 35
    low, high = np.percentile(drawn_f1([r[1:] for r in found], names, 1000), [2.5, 97.5])
    mine = entry.queries()["a10_bootstrap_interval"](spark, odd_events).first()
    assert tuple(mine) == pytest.approx((low, high), abs=0.00006)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{odd_events}/events.parquet/*.parquet'")
    assert con.execute(entry.oracle_sql()["a10_bootstrap_interval"]).fetchall() == [tuple(mine)]


def test_rows_of_one_key_are_drawn_on_their_own(spark):
    data = [(i, "x", "y" if i % 5 == 0 else "x") for i in range(40)] + [(k, "y", "y") for k in (None, None, None, 3, 3)] + [(3, "y", "x")]
    df = spark.createDataFrame(data, "id long, y string, a string").repartition(3)
    named = rows(resampling.named_rows(df, "y", "a", "id", "name"))
    assert sorted(r[:2] for r in named) == sorted(r[1:] for r in data)
    assert {r[2] for r in named} == {*map(str, range(40)), "", "|1", "|2", "3|1", "3|2", "3|3"}
    mine = resampling.bootstrap_f1_weighted(resampling.named_rows(df, "y", "a", "id", "name"), "y", "a", "name", 90)
    assert [r[1] for r in rows(mine, "replicate")] == pytest.approx(drawn_f1([r[:2] for r in named], [r[2] for r in named], 90))
    # as wide as the resampling of rows: rows that come four times halve the interval
    wide, narrow = (
        resampling.bootstrap_f1_weighted(resampling.named_rows(x, "y", "a", "id", "name"), "y", "a", "name", 1000)
        for x in (df, df.withColumn("_", F.explode(F.array(*map(F.lit, range(4))))).drop("_"))
    )
    wide, narrow = (x.agg(F.stddev("f1_macro")).first()[0] for x in (wide, narrow))
    assert narrow / wide == pytest.approx(0.5, rel=0.15)
