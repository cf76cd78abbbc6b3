"""The offline stages end to end. Each reads and writes tables, so each can be rerun alone."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticketloom.functions.text import clean_text
from ticketloom.operators import calibration, drift, evaluation, paired, percentiles, raters, registry, resampling, textdrift
from ticketloom.operators.classifiers import fit_candidates, fit_text_model, load_model, save_model
from ticketloom.operators.mapping import fold, relabel, sibling_share
from ticketloom.operators.sampling import stratified_split
from ticketloom.operators.validation import normalise, prepare, require_choice, require_columns, require_valid, row_problems
from ticketloom.session import settle
from ticketloom.sources import commits, corpus, reports
from ticketloom.streaming import monitoring
from ticketloom.streaming.runner import start
from ticketloom.streaming.scoring import log_records, score_and_route

SPLITS = ("official", "random")


def prepare_corpus(raw: DataFrame, out: str, split: str = "official", test_size: float = 0.2, seed: int = 42) -> None:
    """Clean, drop rows without text or label, split, write by split; rows get a content key."""
    require_choice(split, SPLITS, "split")
    require_columns(raw, ["text", "label"])
    rows = prepare(raw)
    if split == "official":
        require_columns(rows, ["split"])
    else:
        # copies of a row share its content key and stay on one side
        rows = rows.drop("split").withColumn("row_id", F.sha2(F.concat_ws("\x1f", "label", "text"), 256))
        rows = stratified_split(rows, "label", "row_id", test_size, seed).drop("row_id")
    key = F.sha2(F.concat_ws("\x1f", "split", "label", "text"), 256)
    corpus.write_splits(rows.withColumn("row_id", key), out)


def train(spark: SparkSession, data: str, model_path: str, name: str = "linearsvc_calibrated", **settings) -> None:
    rows = corpus.read_split(spark, data, "train")
    save_model(fit_text_model(rows, name, key="row_id", **settings), model_path)


VERSION_SCHEMA = "model string, version long, f1_macro double, data_source string, path string"


def versions(spark: SparkSession, registry_path: str, name: str) -> DataFrame:
    """The version table of a model, each version with the incumbent it met and whether it was promoted."""
    return registry.promotion_replay(commits.read(spark, f"{registry_path}/{name}", VERSION_SCHEMA))


def register(spark: SparkSession, registry_path: str, name: str, f1_macro: float, data_source: str, model_path: str) -> int:
    """Record a trained model as the next version of ``name`` and return its number.

    A number is given to one writer only, and promotions follow from the order of the
    numbers: runs that end together agree on which of them is in production.
    """
    row = {"model": name, "f1_macro": f1_macro, "data_source": data_source, "path": model_path}
    return commits.append(spark, f"{registry_path}/{name}", lambda version: {**row, "version": version})


def train_version(
    spark: SparkSession, data: str, registry_path: str, data_source: str, name: str = "linearsvc_calibrated", **settings
) -> DataFrame:
    """Train, score the test rows, and record a version; its row says whether the gate promoted it.

    The model is written to a folder of its own before its version is: a version always has a model.
    """
    path = f"{registry_path}/_models/{name}-{uuid.uuid4().hex}"
    train(spark, data, path, name, **settings)
    scored = load_model(spark, path).predict(corpus.read_split(spark, data, "test"))
    f1_macro = evaluation.score(scored, "label", "predicted_label").first()["f1_macro"]
    version = register(spark, registry_path, name, f1_macro, data_source, path)
    return versions(spark, registry_path, name).where(F.col("version") == version)


def watch_drift(stream: DataFrame, reference: DataFrame, length: str, out: str, available_now: bool = True) -> StreamingQuery:
    """Windows of a stream of (ts, label, ...) against the labels of ``reference``, verdicts to ``out``."""
    shares = settle(drift.label_shares(reference, "label"), "reference-shares")
    windows = monitoring.windowed_drift(monitoring.event_time(stream), "ts", "label", shares, length)
    return start(drift.window_verdicts(windows), out, f"{out}-checkpoint", available_now=available_now)


def evaluate(spark: SparkSession, data: str, model_path: str, out: str) -> None:
    """Score the test rows once; every report reads the predictions that were written."""
    model = load_model(spark, model_path)
    test = corpus.read_split(spark, data, "test")
    model.predict(test).drop("scores").write.mode("overwrite").parquet(f"{out}/predictions")
    scored = spark.read.parquet(f"{out}/predictions")
    cells = evaluation.confusion_cells(scored, "label", "predicted_label")
    per_class = evaluation.class_scores(cells)
    reports.write_document(reports.metrics_document(evaluation.summary_scores(per_class), per_class), f"{out}/metrics")
    reports.write_table(evaluation.confusion_matrix(cells, model.head.classes), f"{out}/confusion_matrix")
    if model.head.probabilistic:
        wrong = evaluation.errors(scored, "label", "predicted_label", "confidence", "row_id", keep=("text", "intent"))
        reports.write_table(wrong.orderBy("confidence", "row_id"), f"{out}/errors")
        right = F.col("label") == F.col("predicted_label")
        counts = calibration.threshold_counts(scored, F.col("confidence"), right)
        reports.write_table(calibration.coverage_table(counts), f"{out}/coverage_accuracy")


def compare_candidates(
    spark: SparkSession, data: str, model_path: str, names: list[str], out: str, seed: int = 42
) -> None:
    """Alternatives on one feature space against the saved production model."""
    production = load_model(spark, model_path)
    models = fit_candidates(corpus.read_split(spark, data, "train"), names, key="row_id", seed=seed)
    test = corpus.read_split(spark, data, "test")
    scored = test
    for name, model in (("production", production), *models.items()):
        scored = model.predict(scored).drop("scores", "confidence").withColumnRenamed("predicted_label", name)
    scored.drop("text").write.mode("overwrite").parquet(f"{out}/candidate_predictions")
    scored = spark.read.parquet(f"{out}/candidate_predictions")
    every = ["production", *names]
    long = scored.select(
        "label", F.inline(F.array(*[F.struct(F.lit(n).alias("model"), F.col(n).alias("guess")) for n in every]))
    )
    cells = evaluation.confusion_cells(long, "label", "guess", ("model",))
    scores = evaluation.summary_scores(evaluation.class_scores(cells, ("model",)), ("model",))
    board = evaluation.leaderboard(scores, "production", "majority")
    best = board.first()["best_alternative"]
    right = F.col("production") == F.col("label")
    test_row = paired.mcnemar(scored, right, F.col(best) == F.col("label")) if best else None
    reports.write_json(scores, f"{out}/scores")
    reports.write_json(
        board.withColumn("mcnemar_p", test_row.select("p_value").scalar()) if test_row is not None else board, f"{out}/leaderboard"
    )
    for name in every:
        interval = resampling.bootstrap_f1_ci(scored, "label", name, seed=seed)
        reports.write_json(interval.withColumn("model", F.lit(name)), f"{out}/intervals/{name}")


def evaluate_messages(
    spark: SparkSession,
    path: str,
    model_path: str,
    labels: list[str],
    styles: list[str],
    reference_f1: float | None = None,
    errors_path: str | None = None,
    problems_path: str | None = None,
) -> DataFrame:
    """Scores of a hand-written message set, overall and by style; one status row when empty.

    ``f1_macro_drop`` is against the reference score. The misclassified messages are
    written to ``errors_path``, with a confidence if the model has one; invalid rows go
    to ``problems_path`` and fail the job.
    """
    messages = corpus.scan_text(spark, path, corpus.MESSAGE_SCHEMA)
    if messages.isEmpty():
        return spark.range(1).select(F.lit("no_messages_yet").alias("status"))
    rows = normalise(messages, ["label", "language_style"])
    checks = {"label": (F.col("label"), labels), "language_style": (F.col("language_style"), styles)}
    rows = require_valid(rows, "text", row_problems(F.col("text"), checks), problems_path)
    model = load_model(spark, model_path)
    scored = model.predict(rows.withColumn("text", clean_text(F.col("text"))))
    if not model.head.probabilistic:
        scored = scored.withColumn("confidence", F.lit(None).cast("double"))
    if errors_path is not None:
        wrong = evaluation.errors(
            scored, "label", "predicted_label", "confidence", "text", keep=("language_style", "author")
        )
        reports.write_table(wrong.orderBy("confidence", "text"), errors_path)
    cells = evaluation.with_overall(
        evaluation.confusion_cells(scored, "label", "predicted_label", ("language_style",)), "language_style"
    )
    by = ("language_style",)
    scores = evaluation.summary_scores(evaluation.class_scores(cells, by), by).withColumn("status", F.lit("ok"))
    drop = F.round(F.lit(reference_f1).cast("double") - F.col("f1_macro"), 4)
    return scores.withColumn("f1_macro_drop", drop)


def compare_granularity(spark: SparkSession, data: str, model_path: str, mapping: DataFrame, name: str, out: str) -> None:
    """Queues predicted directly against intents predicted and then folded, on the same rows."""
    require_columns(corpus.read_split(spark, data, "train"), ["intent"])
    fine = fit_text_model(corpus.read_split(spark, data, "train"), name, label="intent", key="row_id")
    rows = load_model(spark, model_path).predict(corpus.read_split(spark, data, "test"))
    rows = rows.withColumnRenamed("predicted_label", "direct").drop("scores", "confidence")
    rows = fine.predict(rows).withColumnRenamed("predicted_label", "fine").drop("scores", "confidence", "text")
    fold(rows, mapping, "fine", "fine_mapped").write.mode("overwrite").parquet(f"{out}/granularity_predictions")
    scored = spark.read.parquet(f"{out}/granularity_predictions")
    pairs = {"direct": ("label", "direct"), "fine": ("intent", "fine"), "fine_mapped": ("label", "fine_mapped")}
    variants = [
        F.struct(F.lit(v).alias("variant"), F.col(y).alias("truth"), F.col(p).alias("guess"))
        for v, (y, p) in pairs.items()
    ]
    cells = evaluation.confusion_cells(scored.select(F.inline(F.array(*variants))), "truth", "guess", ("variant",))
    reports.write_json(evaluation.summary_scores(evaluation.class_scores(cells, ("variant",)), ("variant",)), f"{out}/granularity")
    test = paired.mcnemar(scored, F.col("fine_mapped") == F.col("label"), F.col("direct") == F.col("label"))
    siblings = sibling_share(scored, "intent", "fine", "label", "fine_mapped")
    reports.write_json(test.withColumn("sibling_share", siblings.select("sibling_share").scalar()), f"{out}/granularity_test")


def compare_models(
    spark: SparkSession, data: str, incumbent: str, challenger: str, latencies: DataFrame, out: str, p95_limit: float = 5.0
) -> DataFrame:
    """Two saved models on the same test rows: scores, reliability, intervals, the paired test and the decision.

    ``latencies`` has the challenger's response times in ``value``. Both models score the
    rows once; everything else reads the predictions that were written.
    """
    scored = corpus.read_split(spark, data, "test")
    for name, path in (("challenger", challenger), ("incumbent", incumbent)):
        scored = load_model(spark, path).predict(scored).drop("scores")
        scored = scored.withColumnsRenamed({"predicted_label": name, "confidence": f"confidence_{name}"})
    scored.drop("text").write.mode("overwrite").parquet(f"{out}/paired_predictions")
    rows = spark.read.parquet(f"{out}/paired_predictions")
    profile = paired.paired_profile(rows, "label", "challenger", "incumbent", "confidence_challenger", "confidence_incumbent")
    profile = settle(profile, "paired-profile")
    sides = {"a": "challenger", "b": "incumbent"}
    for side, name in sides.items():
        reports.write_table(paired.profile_reliability(profile, side), f"{out}/reliability/{name}")
        cells = profile.groupBy("truth", F.col(side).alias("predicted")).agg(F.sum("n").alias("n"))
        interval = resampling.percentile_interval(resampling.bootstrap_f1(cells))
        reports.write_document(interval, f"{out}/intervals/{name}")
    scores = paired.profile_scores(profile)
    p95 = percentiles.latency_summary(latencies, "value", (0.95,)).first()["p95"]
    named = [F.col(f"{m}_{side}").alias(f"{m}_{name}") for m in ("f1", "ece") for side, name in sides.items()]
    comparison = scores.select(*named, "p_value", F.lit(p95).cast("double").alias("p95"))
    ruled = paired.decision(comparison, p95_limit=p95_limit)
    reports.write_document(ruled, f"{out}/decision")
    return spark.read.schema(ruled.schema).json(f"{out}/decision")


def serve(messages: DataFrame, model_path: str, out: str, available_now: bool = True) -> StreamingQuery:
    """Score and route a stream of (ts, text, ...) into ``out``, scored once.

    The sink has a folder for accepted and one for quarantined messages (``status``); the
    latter keep their redacted text and the reason.
    """
    model = load_model(messages.sparkSession, model_path)
    return start(score_and_route(messages, model), out, f"{out}-checkpoint", partition_by=("status",), available_now=available_now)


def keep_log(spark: SparkSession, served: str, out: str, available_now: bool = True) -> StreamingQuery:
    """The redacted log, by day, from what ``serve`` has written."""
    schema = spark.read.parquet(served).schema
    rows = log_records(spark.readStream.schema(schema).parquet(served))
    return start(rows, out, f"{out}-checkpoint", "json", ("dt",), available_now)


def watch(
    stream: DataFrame, name: str, flagged: Column, limit: float, hold: str, length: str, slide: str, out: str, available_now: bool = True
) -> list[StreamingQuery]:
    """The rate of flagged rows per window and the alert held over it, as two chained streams.

    ``stream`` has ``ts``. Closed windows go to ``out``/rates, evaluations to ``out``/alerts.
    """
    spark = stream.sparkSession
    rates = monitoring.windowed_rate(monitoring.event_time(stream), "ts", flagged, length, slide if slide != length else None)
    first = start(rates, f"{out}/rates", f"{out}/rates-checkpoint", available_now=available_now)
    if available_now:
        first.awaitTermination()
    closed = spark.readStream.schema(rates.schema).parquet(f"{out}/rates").select(F.lit(name).alias("alert"), "window_end", "rate")
    held = monitoring.held_alert_stream(closed.withWatermark("window_end", "0 seconds"), limit, hold, slide, resolve=True)
    return [first, start(held, f"{out}/alerts", f"{out}/alerts-checkpoint", available_now=available_now)]


def mapping_agreement(spark: SparkSession, sheets: str, mapping: DataFrame, queues: list[str], out: str) -> DataFrame:
    """Agreement of the raters' sheets with the author's mapping; returns the majority mapping.

    A sheet with a missing intent or an unknown queue fails; all problems are written to
    ``out``/sheet_problems.
    """
    author = mapping.select(F.lit("author").alias("rater"), F.col("intent").alias("item"), "queue")
    ratings = author.unionByName(corpus.scan_sheets(spark, sheets))
    names = raters.rater_names(ratings)
    problems = raters.sheet_problems(author, ratings, names, queues)
    reports.write_json(problems, f"{out}/sheet_problems")
    count = spark.read.schema(problems.schema).json(f"{out}/sheet_problems").count()
    if count:
        raise ValueError(f"sheets have {count} problems, see {out}/sheet_problems")
    wide = settle(raters.wide_ratings(ratings, names), "ratings")
    reports.write_json(raters.cohen_kappa(wide, names), f"{out}/cohen_kappa")
    reports.write_json(raters.fleiss_kappa(wide, names, queues), f"{out}/fleiss_kappa")
    reports.write_json(raters.dispute_counts(wide, names), f"{out}/disputes")
    reports.write_json(raters.disputed_ratings(wide, names), f"{out}/disputed")
    majority = raters.majority_vote(wide, names, "author", queues).withColumnRenamed("item", "intent")
    reports.write_table(majority.orderBy("intent"), f"{out}/majority_map")
    return majority


def mapping_sensitivity(
    spark: SparkSession, data: str, mapping: DataFrame, alternative: DataFrame, name: str = "linearsvc_calibrated"
) -> DataFrame:
    """Macro F1 when the model is refitted under each mapping, and the difference."""
    maps = mapping.select(F.lit("author").alias("version"), "intent", "queue").unionByName(
        alternative.select(F.lit("alternative").alias("version"), "intent", "queue")
    )
    sides = [
        relabel(corpus.read_split(spark, data, side), maps, ["author", "alternative"], "intent") for side in ("train", "test")
    ]
    f1 = {}
    for version in ("author", "alternative"):
        train_rows, test_rows = (side.withColumn("label", F.col(f"queue_{version}")) for side in sides)
        scored = fit_text_model(train_rows, name, key="row_id").predict(test_rows)
        f1[version] = evaluation.score(scored, "label", "predicted_label").first()["f1_macro"]
    row = (round(f1["author"], 4), round(f1["alternative"], 4), round(f1["alternative"] - f1["author"], 4))
    return spark.createDataFrame([row], "author double, alternative double, delta_f1_macro double")


def monitor(reference: DataFrame, current: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """The drift row for current traffic (from ``resolve_current``) against the training split.

    ``columns`` holds every column's score, threshold, method and verdict, and
    ``current_source`` where the traffic came from (NULL if the frame does not say).
    """
    labels = drift.js_distance(drift.label_shares(reference, label), drift.label_shares(current, label))
    named = F.max("current_source") if "current_source" in current.columns else F.lit(None).cast("string")
    n, source = current.agg(F.count(F.lit(1)), named).first()
    # a text's digest stands in for a row key: equal texts fall on one side of the test
    ref, cur = (
        df.select(F.sha2(text, 256).alias("_key"), F.col(text).alias("text")) for df in (reference, current)
    )
    score = textdrift.text_drift(ref, cur, "text", "_key")
    rows = labels.select(
        F.lit("label").alias("column"),
        F.col("distance").alias("score"),
        F.lit(drift.LABEL_THRESHOLD).alias("threshold"),
        F.lit("jensen_shannon").alias("method"),
        "rows",
    ).unionByName(
        reference.sparkSession.range(1).select(
            F.lit("text").alias("column"),
            F.lit(score).cast("double").alias("score"),
            F.lit(drift.TEXT_THRESHOLD).alias("threshold"),
            F.lit("classifier_auc").alias("method"),
            F.lit(n).cast("long").alias("rows"),
        )
    )
    verdicts = drift.column_verdicts(rows)
    listed = verdicts.agg(F.array_sort(F.collect_list(F.struct("column", "score", "threshold", "method", "drifted"))).alias("columns"))
    summary = drift.drift_summary(rows)
    return summary.withColumn("columns", listed.scalar()).withColumn("current_source", F.lit(source))
