"""Text drift as a classifier two-sample test (Lopez-Paz and Oquab, 2017)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.hashing import uniform
from ticketloom.functions.text import tokens
from ticketloom.operators.classifiers import packed
from ticketloom.operators.ranks import rank_auc


def text_drift(
    reference: DataFrame,
    current: DataFrame,
    text: str,
    key: str,
    seed: int = 42,
    n_features: int = 1 << 14,
    max_iter: int = 30,
) -> float | None:
    """ROC AUC of telling current from reference text on held-out rows; 0.5 is no drift.

    None, unknown, if a side has no rows to train on or none to score.

    Half of the rows by key train a linear model on hashed words, the other half score
    it. The classes are weighted to the same total, so sizes do not matter.
    """
    both = reference.select(key, text, F.lit(0.0).alias("_label")).unionByName(
        current.select(key, text, F.lit(1.0).alias("_label"))
    )
    words = both.select(
        "_label",
        tokens(F.col(text)).alias("_words"),
        (uniform(seed, key, F.col("_label")) < F.lit(0.5)).alias("_train"),
    )
    hashing = HashingTF(inputCol="_words", outputCol="_tf", numFeatures=n_features)
    rows = hashing.transform(words).drop("_words").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = rows.agg(
            *[F.count_if(F.expr(f"{side} AND _label = {label}")) for side in ("_train", "NOT _train") for label in (0, 1)]
        ).first()
        n_ref, n_cur = counts[0], counts[1]
        if min(counts) == 0:
            return None
        weight = F.when(F.col("_label") == 0, F.lit(0.5 / n_ref)).otherwise(F.lit(0.5 / n_cur)) * (n_ref + n_cur)
        weighting = IDF(inputCol="_tf", outputCol="_features").fit(rows.where("_train"))
        train = weighting.transform(rows.where("_train")).select("_label", "_features", weight.alias("_weight"))
        train = packed(train)
        head = LogisticRegression(
            featuresCol="_features", labelCol="_label", weightCol="_weight", regParam=0.1, maxIter=max_iter
        ).fit(train)
        train.unpersist()
        scored = head.transform(weighting.transform(rows.where("NOT _train")))
        margins = scored.select("_label", vector_to_array("rawPrediction")[1].alias("_margin"))
        return rank_auc(margins, "_margin", F.col("_label") == 1).first()["auc"]
    finally:
        rows.unpersist()
