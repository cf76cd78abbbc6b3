"""Text classifiers: one feature pipeline, a head chosen by name, scores per class."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketloom.functions.hashing import uniform
from ticketloom.functions.scores import top_class
from ticketloom.operators import linear
from ticketloom.operators.evaluation import majority_class
from ticketloom.operators.features import MAX_FEATURES, NGRAM_MAX, fit_features


def packed(featured: DataFrame, partitions: int | None = None) -> DataFrame:
    """The features cached, in ``partitions`` partitions if that is set.

    A fit runs one job per optimiser step, so it gains from few partitions when rows
    are few; the number is a setting and never follows from the data, because the order
    of the sums, and with it the last digits of the coefficients, depends on it.
    """
    return (featured.coalesce(partitions) if partitions else featured).persist(StorageLevel.MEMORY_AND_DISK)


def class_names(df: DataFrame, label: str) -> list[str]:
    """The classes in sorted order: the label index needs them on the driver."""
    rows = df.select(F.col(label).cast("string").alias("c")).where("c IS NOT NULL").distinct().collect()
    return sorted(r["c"] for r in rows)


def class_index(label: Column, classes: list[str]) -> Column:
    names = F.array(*[F.lit(c) for c in classes])
    return (F.array_position(names, label.cast("string")) - 1).cast("double")


@dataclass
class Head:
    """Turns ``features`` into the array column ``scores``, one per class."""

    classes: list[str]
    probabilistic: bool = True

    def score(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError


@dataclass
class MlHead(Head):
    """A spark.ml probabilistic classifier."""

    model: Transformer = None

    def score(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df).withColumn("scores", vector_to_array("probability"))
        return out.drop("rawPrediction", "probability", "prediction")


@dataclass
class MajorityHead(Head):
    """Always the commonest training class."""

    winner: str = ""

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumn("scores", F.array(*[F.lit(1.0 if c == self.winner else 0.0) for c in self.classes]))


@dataclass
class SvmHead(Head):
    """Linear SVM, one against the rest. Its scores are margins, not probabilities."""

    model: LogisticRegressionModel = None

    def score(self, df: DataFrame) -> DataFrame:
        return linear.multiplied(df, self.model, "scores")


@dataclass
class Curves:
    """Margin to probability of one member's machines: slopes and offsets of sigmoids, or knots of monotone lines."""

    kind: str
    xs: list
    ys: list

    def apply(self, margins: Column) -> Column:
        if self.kind == "sigmoid":
            return linear.sigmoids(margins, self.xs, self.ys)
        return linear.monotone(margins, list(zip(self.xs, self.ys, strict=True)))


def _normalised(values: Column) -> Column:
    """The values over their sum; all equal when the sum is 0."""
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    even = F.lit(1.0) / F.size(values)
    # the sum is a variable of an inner function, so that it is made once and not for every value
    return F.get(F.transform(F.array(total), lambda t: F.transform(values, lambda x: F.when(t > 0, x / t).otherwise(even))), F.lit(0))


@dataclass
class CalibratedHead(Head):
    """The mean of the members' calibrated, normalised class probabilities.

    One matrix holds the machines of all members, so a row is multiplied once.
    """

    model: LogisticRegressionModel = None
    members: list[Curves] = field(default_factory=list)

    def score(self, df: DataFrame) -> DataFrame:
        df, parts = linear.multiplied(df, self.model, "_margins"), []
        machines = 1 if len(self.classes) == 2 else len(self.classes)
        for i, curves in enumerate(self.members):
            df = df.withColumn(f"_q{i}", curves.apply(F.slice("_margins", i * machines + 1, machines)))
            if machines == 1:
                positive = F.element_at(f"_q{i}", 1)
                df = df.withColumn(f"_q{i}", F.array(1 - positive, positive))
            else:
                df = df.withColumn(f"_q{i}", _normalised(F.col(f"_q{i}")))
            parts.append(F.col(f"_q{i}"))
        total = parts[0]
        for part in parts[1:]:
            total = F.zip_with(total, part, lambda a, b: a + b)
        scores = F.transform(total, lambda x: x / F.lit(float(len(parts))))
        return df.withColumn("scores", scores).drop("_margins", *[f"_q{i}" for i in range(len(parts))])


def stratified_folds(df: DataFrame, label: str, key: str, folds: int, seed: int, buckets: int = 1024) -> DataFrame:
    """``_fold``: rows of a label numbered in the order of a seeded number, modulo ``folds``.

    Rows are numbered within buckets of that number, and a bucket's first number comes
    from the bucket counts, so no label meets in one task.
    """
    rows = df.withColumn("_u", uniform(seed, key)).withColumn("_b", F.floor(F.col("_u") * buckets))
    before = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    firsts = counts.select(
        F.col(label).alias("_l"), F.col("_b").alias("_c"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    place = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_u", key)) - 1
    joined = rows.withColumn("_place", place).join(firsts, F.col(label).eqNullSafe(F.col("_l")) & (F.col("_b") == F.col("_c")))
    fold = ((F.col("_first") + F.col("_place")) % folds).cast("int")
    return joined.withColumn("_fold", fold).drop("_u", "_b", "_l", "_c", "_first", "_place")


def _machines(classes: list[str]) -> list[int]:
    """Labels that a machine is made for; for two classes one plane serves both."""
    return [1] if len(classes) == 2 else list(range(len(classes)))


def _width(featured: DataFrame) -> int:
    return int(featured.select(F.unwrap_udt("features")["size"]).first()[0])


def _fit_svm(df: DataFrame, classes: list[str], c: float, max_iter: int) -> SvmHead:
    width = _width(df)
    blocks = linear.persisted(linear.blocked(df, width))
    try:
        weights = linear.fit_squared_hinge(blocks, width, [linear.Target(k) for k in _machines(classes)], c, max_iter).weights
    finally:
        blocks.unpersist()
    if len(weights) == 1:
        weights = np.concatenate([-weights, weights])
    return SvmHead(classes, False, linear.matrix_model(df.sparkSession, weights))


def _fit_calibrated(
    df: DataFrame, classes: list[str], key: str, c: float, max_iter: int, method: str, folds: int, seed: int
) -> CalibratedHead:
    """``folds`` members, each fitted without one fold and calibrated on it; all their machines in the same passes."""
    if method not in ("sigmoid", "isotonic"):
        raise ValueError(f"unknown calibration {method!r}; expected 'sigmoid' or 'isotonic'")
    data = stratified_folds(df, "_label", key, folds, seed)
    width = _width(df)
    blocks = linear.persisted(linear.blocked(data, width, fold="_fold"))
    margins = None
    try:
        sizes = {r["_label"]: r["count"] for r in df.groupBy("_label").count().collect()}
        few = [name for k, name in enumerate(classes) if sizes.get(float(k), 0) < folds]
        if few or len(classes) < 2:
            raise ValueError(f"calibration in {folds} folds needs two classes and {folds} rows of each; too few: {few}")
        machines = _machines(classes)
        targets = [linear.Target(k, fold) for fold in range(folds) for k in machines]
        weights = linear.fit_squared_hinge(blocks, width, targets, c, max_iter).weights
        margins = linear.persisted(linear.held_margins(blocks, weights, targets))
        fitted = linear.fit_sigmoids(margins, targets) if method == "sigmoid" else linear.fit_monotone(margins, targets)
    finally:
        blocks.unpersist()
        if margins is not None:
            margins.unpersist()
    members = []
    for fold in range(folds):
        xs, ys = zip(*fitted[fold * len(machines) : (fold + 1) * len(machines)], strict=True)
        members.append(Curves(method, list(xs), list(ys)))
    return CalibratedHead(classes, True, linear.matrix_model(df.sparkSession, weights), members)


HEADS = ("majority", "complementnb", "logreg", "linearsvc", "linearsvc_calibrated", "linearsvc_isotonic")


def fit_head(
    name: str, df: DataFrame, classes: list[str], key: str, c: float = 1.0, max_iter: int = 100, seed: int = 42
) -> Head:
    """``df`` has ``features``, ``_label`` (index into ``classes``) and the row key."""
    if name not in HEADS:
        raise ValueError(f"unknown model {name!r}; expected one of {HEADS}")
    if name == "majority":
        winner = majority_class(df, "_label").first()["majority_class"]
        return MajorityHead(classes, True, classes[int(winner)])
    if name == "complementnb":
        model = NaiveBayes(featuresCol="features", labelCol="_label", modelType="complement", smoothing=1.0).fit(df)
        return MlHead(classes, True, model)
    if name == "logreg":
        model = LogisticRegression(
            featuresCol="features",
            labelCol="_label",
            family="multinomial",
            regParam=1.0 / (c * max(df.count(), 1)),
            elasticNetParam=0.0,
            standardization=False,
            maxIter=max_iter,
        ).fit(df)
        return MlHead(classes, True, model)
    if name == "linearsvc":
        return _fit_svm(df, classes, c, max_iter)
    method = "sigmoid" if name == "linearsvc_calibrated" else "isotonic"
    return _fit_calibrated(df, classes, key, c, max_iter, method, 5, seed)


@dataclass
class TextModel:
    """Features and head together."""

    features: PipelineModel
    head: Head
    name: str

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``scores``, ``predicted_label`` and, for probabilistic heads, ``confidence``.

        The frame is scored once; label and confidence come from the same scores.
        """
        return predict_featured(self.features.transform(df), self.head).drop("features")


def save_model(model: TextModel, path: str) -> None:
    """The fitted stages below ``path`` and one JSON line that says how they fit together."""
    head = model.head
    spark = SparkSession.active()
    about: dict = {"name": model.name, "classes": head.classes}
    model.features.write().overwrite().save(f"{path}/features")
    if isinstance(head, MajorityHead):
        about["winner"] = head.winner
    else:
        PipelineModel(stages=[head.model]).write().overwrite().save(f"{path}/head")
    if isinstance(head, CalibratedHead):
        about["curves"] = [asdict(curves) for curves in head.members]
    spark.range(1).select(F.lit(json.dumps(about)).alias("value")).write.mode("overwrite").text(f"{path}/about")


def load_model(spark: SparkSession, path: str) -> TextModel:
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    name, classes = about["name"], about["classes"]
    features = PipelineModel.load(f"{path}/features")
    if "winner" in about:
        return TextModel(features, MajorityHead(classes, True, about["winner"]), name)
    model = PipelineModel.load(f"{path}/head").stages[0]
    if "curves" in about:
        head: Head = CalibratedHead(classes, True, model, [Curves(**c) for c in about["curves"]])
    elif name == "linearsvc":
        head = SvmHead(classes, False, model)
    else:
        head = MlHead(classes, True, model)
    return TextModel(features, head, name)


def predict_featured(featured: DataFrame, head: Head) -> DataFrame:
    out = head.score(featured).withColumn("predicted_label", top_class(F.col("scores"), head.classes))
    return out.withColumn("confidence", F.array_max("scores")) if head.probabilistic else out


def with_label_index(df: DataFrame, label: str, classes: list[str]) -> DataFrame:
    return df.withColumn("_label", class_index(F.col(label), classes))


def fit_text_model(
    train: DataFrame,
    name: str,
    text: str = "text",
    label: str = "label",
    key: str = "doc_id",
    max_features: int = MAX_FEATURES,
    ngram_max: int = NGRAM_MAX,
    c: float = 1.0,
    max_iter: int = 100,
    seed: int = 42,
) -> TextModel:
    return fit_candidates(train, [name], text, label, key, max_features, ngram_max, c, max_iter, seed)[name]


def fit_candidates(
    train: DataFrame,
    names: list[str],
    text: str = "text",
    label: str = "label",
    key: str = "doc_id",
    max_features: int = MAX_FEATURES,
    ngram_max: int = NGRAM_MAX,
    c: float = 1.0,
    max_iter: int = 100,
    seed: int = 42,
) -> dict[str, TextModel]:
    """Several heads over one feature space; features are computed once."""
    for name in names:
        if name not in HEADS:
            raise ValueError(f"unknown model {name!r}; expected one of {HEADS}")
    classes = class_names(train, label)
    features, featured, counts = fit_features(train, text, (key, label), max_features, ngram_max)
    featured = with_label_index(featured, label, classes).select(key, "features", "_label")
    rows = packed(featured)
    try:
        heads = {name: fit_head(name, rows, classes, key, c, max_iter, seed) for name in names}
    finally:
        rows.unpersist()
        counts.unpersist()
    return {name: TextModel(features, head, name) for name, head in heads.items()}
