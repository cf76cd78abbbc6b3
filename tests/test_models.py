from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import plan
from pyspark.sql import functions as F

from ticketloom import jobs
from ticketloom.functions.hashing import uniform
from ticketloom.functions.intents import QUEUES, mapping_table
from ticketloom.functions.scores import map_confidence, map_top_class, route, score_map, top_class
from ticketloom.operators import bayesgrid, registry, synthetic, textdrift
from ticketloom.operators.bayesgrid import Setting, held_out_predictions, ranked_terms
from ticketloom.operators.classifiers import HEADS, fit_candidates, fit_text_model, load_model, save_model, stratified_folds
from ticketloom.operators.features import long_form, vocabulary_of
from ticketloom.operators.synthetic import synthetic_corpus
from ticketloom.sources import corpus


@pytest.fixture(scope="module")
def texts(spark):
    """Synthetic messages of five classes, stored once."""
    df = synthetic.synthetic_corpus(spark.range(600).withColumnRenamed("id", "doc_id"), "doc_id").coalesce(2)
    return df.persist()


@pytest.fixture(scope="module")
def models(texts):
    return fit_candidates(texts, list(HEADS), max_iter=10)


def accuracy(df):
    return df.agg(F.avg((F.col("label") == F.col("predicted_label")).cast("double"))).first()[0]


def test_every_head_learns(texts, models):
    floor = accuracy(models["majority"].predict(texts))
    for name, model in models.items():
        if name != "majority":
            assert accuracy(model.predict(texts)) > max(0.8, floor + 0.3), name


def test_probabilities_sum_to_one_and_confidence_is_the_best(texts, models):
    for name, model in models.items():
        scored = model.predict(texts)
        if name == "linearsvc":
            assert "confidence" not in scored.columns
            continue
        row = scored.agg(
            F.max(F.abs(F.aggregate("scores", F.lit(0.0), lambda a, x: a + x) - 1)), F.max(F.abs(F.array_max("scores") - F.col("confidence"))), F.min(F.size("scores"))
        ).first()
        assert row[0] < 1e-9 and row[1] == 0 and row[2] == 5, name


def test_calibrated_confidence_is_close_to_accuracy(texts, models):
    scored = models["linearsvc_calibrated"].predict(texts)
    assert abs(accuracy(scored) - scored.agg(F.avg("confidence")).first()[0]) < 0.1


def test_scoring_has_no_python_and_no_shuffle(texts, models):
    for name in ("complementnb", "logreg", "linearsvc_calibrated"):
        text = plan(models[name].predict(texts))
        assert "Python" not in text and "Exchange" not in text, name


def test_saved_models_score_alike(spark, texts, models, tmp_path):
    for name in ("majority", "logreg", "linearsvc_calibrated"):
        model = models[name]
        path = str(tmp_path / name)
        save_model(model, path)
        loaded = load_model(spark, path)
        a = model.predict(texts).select("doc_id", "predicted_label", "scores")
        b = loaded.predict(texts).select("doc_id", "predicted_label", "scores")
        assert a.exceptAll(b).count() == 0, name


def test_unknown_model_raises(texts):
    with pytest.raises(ValueError, match="unknown model"):
        fit_text_model(texts, "oracle")


def test_two_class_calibration(texts):
    two = texts.where("label IN ('billing', 'account')")
    for name, model in fit_candidates(two, ["linearsvc_calibrated", "linearsvc_isotonic"], max_iter=10).items():
        assert accuracy(model.predict(two)) > 0.8, name


def test_features_are_unit_length_and_bounded(texts):
    model = fit_text_model(texts, "complementnb", max_features=40)
    assert len(vocabulary_of(model.features)) == 40
    long = long_form(model.features.transform(texts), model.features, "doc_id")
    lengths = long.groupBy("doc_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("s"))
    assert lengths.where("abs(s - 1) > 1e-9").count() == 0


def test_text_drift_orders_the_cases(spark, texts):
    half = uniform("h", "doc_id") < F.lit(0.5)
    same = textdrift.text_drift(texts.where(half), texts.where(~half), "text", "doc_id")
    by_label = F.col("label").isin("billing", "general")
    different = textdrift.text_drift(texts.where(by_label), texts.where(~by_label), "text", "doc_id")
    assert abs(same - 0.5) < 0.1 and different > 0.8


def test_noise_share(spark):
    df = synthetic.synthetic_corpus(spark.range(20000), "id")
    clean = synthetic.synthetic_corpus(spark.range(20000), "id", seed=42)
    assert df.exceptAll(clean).count() == 0
    by_label = df.groupBy("label").count().collect()
    assert {r["label"] for r in by_label} == set(synthetic.LABELS) and min(r["count"] for r in by_label) > 3500
    assert df.where(F.contains("text", F.lit("{"))).count() == 0


def test_scores_and_ties(spark):
    df = spark.createDataFrame([(["b", "a", "c"], [0.4, 0.4, 0.2])], "k array<string>, v array<double>")
    m = score_map(F.col("k"), F.col("v"))
    assert tuple(df.select(map_top_class(m), map_confidence(m)).first()) == ("a", 0.4)
    assert df.select(top_class(F.array(F.lit(0.5), F.lit(0.5)), ["x", "y"])).first()[0] == "x"
    with pytest.raises(Exception, match="differ in length"):
        df.select(score_map(F.col("k"), F.array(F.lit(1.0)))).collect()


@pytest.mark.parametrize(("threshold", "want"), [(0.0, "a"), (0.7, "a"), (0.71, "needs_review"), (1.01, "needs_review")])
def test_route(spark, threshold, want):
    assert spark.range(1).select(route(F.lit("a"), F.lit(0.7), threshold)).first()[0] == want


def test_stages_end_to_end(spark, texts, tmp_path):
    """Files of a fine-labelled corpus through every stage."""
    names = {"billing": "request_refund", "technical": "card_not_working", "account": "change_pin", "card_delivery": "card_arrival", "general": "age_limit"}
    fine = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.col("label"))
    rows = texts.select(F.concat("text", F.lit("\nsecond \"line\", "), "doc_id").alias("text"), fine.alias("category"), "doc_id")
    for name, condition in (("train", F.col("doc_id") % 4 != 0), ("test", F.col("doc_id") % 4 == 0)):
        corpus.write_csv(rows.where(condition).drop("doc_id"), str(tmp_path / f"{name}.csv"))
    paths = [str(tmp_path / f"{name}.csv") for name in ("train", "test")]
    raw = corpus.load_labelled(spark, paths, mapping_table(spark), multiline=True)
    assert raw.count() == 600 and raw.where("label IS NULL").count() == 0
    assert corpus.load_labelled(spark, paths, mapping_table(spark), n_samples=50, multiline=True).count() == 50
    with pytest.raises(ValueError, match="missing from the mapping"):
        corpus.load_labelled(spark, paths, mapping_table(spark, {"request_refund": "billing"}), multiline=True)
    data, model, out = str(tmp_path / "data"), str(tmp_path / "model"), str(tmp_path / "out")
    jobs.prepare_corpus(raw, data)
    assert corpus.read_split(spark, data, "test").count() == 150
    assert "PartitionFilters" in plan(corpus.read_split(spark, data, "test"))
    jobs.train(spark, data, model, "complementnb")
    jobs.evaluate(spark, data, model, out)
    metrics = spark.read.json(f"{out}/metrics").first()
    assert metrics["summary"]["accuracy"] > 0.6 and metrics["macro avg"]["support"] == 150
    assert spark.read.option("header", "true").csv(f"{out}/confusion_matrix").count() == len(set(QUEUES) - {"general"})
    jobs.compare_candidates(spark, data, model, ["majority", "logreg"], out)
    board = spark.read.json(f"{out}/leaderboard").first()
    assert board["best_alternative"] == "logreg" and 0 <= board["mcnemar_p"] <= 1
    jobs.train(spark, data, str(tmp_path / "other"), "logreg")
    latencies = spark.range(100).select((F.col("id") / 100).alias("value"))
    ruled = jobs.compare_models(spark, data, model, str(tmp_path / "other"), latencies, out).first()
    assert ruled["latency_ok"] and ruled["p95"] == pytest.approx(0.9405) and 0 <= ruled["p_value"] <= 1
    assert ruled["switch"] == (ruled["f1_ok"] and ruled["p_ok"] and ruled["ece_ok"])
    assert spark.read.option("header", "true").csv(f"{out}/reliability/challenger").count() > 0
    jobs.prepare_corpus(raw, str(tmp_path / "again"), split="random", test_size=0.1)
    assert 55 <= corpus.read_split(spark, str(tmp_path / "again"), "test").count() <= 65
    summary = jobs.monitor(corpus.read_split(spark, data, "train"), corpus.read_split(spark, data, "test")).first()
    assert (summary["columns_checked"], summary["status"]) == (2, "insufficient_data")
    assert [(c["column"], c["method"], c["drifted"]) for c in summary["columns"]] == [
        ("label", "jensen_shannon", None),
        ("text", "classifier_auc", None),
    ]
    named = corpus.read_split(spark, data, "test").withColumn("current_source", F.lit("prediction_log"))
    assert jobs.monitor(corpus.read_split(spark, data, "train"), named).first()["current_source"] == "prediction_log"
    dim = mapping_table(spark)
    jobs.compare_granularity(spark, data, model, dim, "complementnb", out)
    variants = {r["variant"]: r["f1_macro"] for r in spark.read.json(f"{out}/granularity").collect()}
    assert set(variants) == {"direct", "fine", "fine_mapped"}
    sheets = tmp_path / "sheets"
    sheets.mkdir()
    lines = [f"{r['intent']},{'general' if r['intent'] == 'age_limit' else r['queue']}" for r in dim.collect()]
    for rater in ("ann", "bo"):
        (sheets / f"{rater}.csv").write_text("intent,queue\n" + "\n".join(lines) + "\n")
    majority = jobs.mapping_agreement(spark, str(sheets), dim, list(QUEUES), out)
    assert majority.where("intent = 'age_limit'").first()["queue"] == "general" and majority.count() == 77
    assert spark.read.json(f"{out}/disputes").first()["disputed"] == 1
    kappa = {(r["rater_a"], r["rater_b"]): r["kappa"] for r in spark.read.json(f"{out}/cohen_kappa").collect()}
    assert kappa["ann", "bo"] == 1.0 and 0.9 < kappa["ann", "author"] < 1.0
    assert jobs.mapping_sensitivity(spark, data, dim, majority, "complementnb").first()["author"] > 0.5
    (sheets / "cy.csv").write_text("intent,queue\nage_limit,nowhere\n")
    with pytest.raises(ValueError, match="77 problems"):
        jobs.mapping_agreement(spark, str(sheets), dim, list(QUEUES), out)
    assert spark.read.json(f"{out}/sheet_problems").where("rater = 'cy'").count() == 77
    (tmp_path / "m.csv").write_text("text,label,language_style,author\nwhere is the parcel with my new card,Card_Delivery,English ,x\n")
    scores = jobs.evaluate_messages(spark, str(tmp_path / "m.csv"), model, list(QUEUES), ["english"], 0.9, str(tmp_path / "wrong"))
    assert {r["language_style"]: r["rows"] for r in scores.collect()} == {"english": 1, "overall": 1}
    margins = str(tmp_path / "margins")
    jobs.train(spark, data, margins, "linearsvc", max_iter=5)
    errors = str(tmp_path / "wrong-margins")
    assert jobs.evaluate_messages(spark, str(tmp_path / "m.csv"), margins, list(QUEUES), ["english"], None, errors).count() == 2
    empty = str(tmp_path / "none.csv")
    spark.createDataFrame([], corpus.MESSAGE_SCHEMA).write.option("header", "true").csv(empty)
    assert jobs.evaluate_messages(spark, empty, model, list(QUEUES), ["english"]).first()["status"] == "no_messages_yet"


def test_official_split_needs_its_column(spark):
    with pytest.raises(ValueError, match="split"):
        corpus.official_split(spark.range(1), "train")


def test_folds_are_stratified(spark):
    rows = spark.range(503).select("id", F.when(F.col("id") < 480, "a").when(F.col("id") < 498, "b").otherwise("c").alias("label"))
    folds = stratified_folds(rows, "label", "id", 5, 42)
    counts = {}
    for r in folds.groupBy("label", "_fold").count().collect():
        counts.setdefault(r["label"], []).append(r["count"])
    assert {k: (len(v), max(v) - min(v)) for k, v in counts.items()} == {"a": (5, 0), "b": (5, 1), "c": (5, 0)}
    again = stratified_folds(rows.repartition(7), "label", "id", 5, 42)
    assert folds.select("id", "_fold").exceptAll(again.select("id", "_fold")).count() == 0


def test_calibration_needs_rows_of_every_class(texts):
    rare = texts.where("label <> 'billing'").unionByName(texts.where("label = 'billing'").limit(1))
    with pytest.raises(ValueError, match="billing"):
        fit_text_model(rare, "linearsvc_calibrated", max_iter=3)


def test_text_drift_of_nothing_is_unknown(texts):
    assert textdrift.text_drift(texts, texts.where("false"), "text", "doc_id") is None


def test_versions_of_runs_that_end_together(spark, tmp_path):
    path = str(tmp_path / "registry")
    with ThreadPoolExecutor(2) as pool:
        numbers = list(pool.map(lambda run: jobs.register(spark, path, "m", 0.8, "real", f"run {run}"), range(2)))
    assert sorted(numbers) == [1, 2]
    assert [r["promoted"] for r in jobs.versions(spark, path, "m").orderBy("version").collect()] == [True, False]
    jobs.register(spark, path, "m", 0.7, "synthetic", "another corpus")
    jobs.register(spark, path, "m", 0.75, "synthetic", "better")
    assert [r["promoted"] for r in jobs.versions(spark, path, "m").orderBy("version").collect()] == [True, False, True, True]
    assert registry.production_version(jobs.versions(spark, path, "m")).first()["production_version"] == 4


def test_training_records_a_version(spark, tmp_path):
    data, path = str(tmp_path / "data"), str(tmp_path / "registry")
    raw = synthetic_corpus(spark.range(300), "id").withColumn("split", F.when(F.col("id") % 4 == 0, "test").otherwise("train"))
    jobs.prepare_corpus(raw, data)
    first, second = (jobs.train_version(spark, data, path, "synthetic", "complementnb").first() for _ in range(2))
    assert (first["version"], first["promoted"], second["version"], second["promoted"]) == (1, True, 2, False)
    assert first["f1_macro"] == second["f1_macro"] > 0.5 and first["path"] != second["path"]


def test_a_grid_of_settings_equals_separate_fits(spark, texts):
    """All settings from one table of terms; rows without a label in some setting take no part."""
    rows = texts.withColumn("half", F.when(F.col("label") < "d", F.lit("early")).otherwise("late"))
    held = uniform("side", "doc_id") < 0.25
    settings = [Setting("a", "label", 1, 40), Setting("b", "label", 2, 300), Setting("c", "half", 2, 300)]
    unlabelled = rows.limit(20).withColumn("half", F.lit(None).cast("string"))
    found = held_out_predictions(rows.unionByName(unlabelled), held, settings)
    cells = {(r["setting"], r["label"], r["predicted_label"]): r["count"] for r in found.groupBy(*found.columns).count().collect()}
    expected = {}
    for s in settings:
        told = rows.withColumn("label", F.col(s.label))
        model = fit_text_model(told.where(~held), "complementnb", max_features=s.max_features, ngram_max=s.ngram_max)
        for r in model.predict(told.where(held)).groupBy("label", "predicted_label").count().collect():
            expected[s.name, r["label"], r["predicted_label"]] = r["count"]
    assert cells == expected
    assert "regexp_extract_all" not in plan(found).lower()  # texts are split before, once


def test_vocabularies_of_a_grid_are_prefixes(spark):
    rows = spark.createDataFrame([(["a", "b", "a b"],), (["b", "a", "c"],), (["c", "b c", "b c", "b c"],)], "terms array<string>")
    settings = [Setting("x", "l", 1, 2), Setting("y", "l", 1, 3), Setting("z", "l", 2, 4)]
    assert ranked_terms(rows, settings) == [["a", "b"], ["a", "b", "c"], ["b c", "a", "b", "c"]]
    with pytest.raises(ValueError, match="no terms"):
        ranked_terms(rows.limit(0), settings)


def test_vocabularies_are_ranked_without_all_terms_of_a_length_in_one_task(spark):
    """No window over a length, which would hold every term of it: each task sends its first rows only."""
    counts = spark.range(6000).select(
        F.concat_ws(" ", F.concat(F.lit("t"), F.col("id")), F.when(F.col("id") % 3 == 0, "x")).alias("term"),
        (F.col("id") % 7).alias("n"),
        F.when(F.col("id") % 3 == 0, 2).otherwise(1).alias("length"),
    )
    leading = bayesgrid.leading_terms(counts, 2, 1500)
    assert "Window" not in plan(leading)
    want = []
    for length in (1, 2):
        rows_ = [tuple(r) for r in counts.where(F.col("length") == length).collect()]
        want += sorted(rows_, key=lambda r: (-r[1], r[0]))[:1500]
    assert sorted(map(tuple, leading.collect())) == sorted(want)
