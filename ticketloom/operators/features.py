"""TF-IDF features as a saveable pipeline of JVM stages."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.text import terms

MAX_FEATURES = 5000
NGRAM_MAX = 2


def term_counts(df: DataFrame, text: str, ngram_max: int = NGRAM_MAX) -> DataFrame:
    """Corpus count per term; hot terms are combined before the shuffle."""
    words = df.select(F.explode(terms(F.col(text), ngram_max)).alias("term"))
    return words.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def top_terms(counts: DataFrame, max_features: int = MAX_FEATURES) -> DataFrame:
    """The most frequent terms, ties at the cut in alphabetical order."""
    return counts.orderBy(F.desc("n"), "term").limit(max_features)


def fit_features(
    train: DataFrame, text: str, keep: tuple[str, ...], max_features: int = MAX_FEATURES, ngram_max: int = NGRAM_MAX
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Terms -> counts -> smoothed idf -> unit length, fitted on ``train`` only.

    Returns the pipeline, the training rows (``keep`` columns and ``features``) and the
    cached counts behind them, which the caller releases. The texts are read twice,
    once for the vocabulary and once for the counts. The vocabulary (at most ``max_features`` terms) is the only thing that reaches the
    driver. ``IDF`` gives ln((N+1)/(df+1)); the weight wanted is that plus 1, so it is
    applied as an element-wise scaling.
    """
    vocabulary = [r["term"] for r in top_terms(term_counts(train, text, ngram_max), max_features).collect()]
    if not vocabulary:
        raise ValueError("no terms in the training text")
    split, gram = _term_stages(text, ngram_max)
    count = CountVectorizerModel.from_vocabulary(sorted(vocabulary), inputCol="terms", outputCol="tf")
    counted = count.transform(gram.transform(split.transform(train.select(*keep, text)))).select(*keep, "tf")
    counted = counted.persist(StorageLevel.MEMORY_AND_DISK)
    idf = IDF(inputCol="tf", outputCol="_idf").fit(counted)
    scale = ElementwiseProduct(
        scalingVec=Vectors.dense([v + 1.0 for v in idf.idf.toArray()]), inputCol="tf", outputCol="weighted"
    )
    unit = Normalizer(inputCol="weighted", outputCol="features", p=2.0)
    drop = SQLTransformer(statement="SELECT * EXCEPT (_words, terms, tf, weighted) FROM __THIS__")
    pipeline = PipelineModel(stages=[split, gram, count, scale, unit, drop])
    return pipeline, unit.transform(scale.transform(counted)).select(*keep, "features"), counted


def _term_stages(text: str, ngram_max: int) -> tuple[SQLTransformer, SQLTransformer]:
    """``functions.text.terms`` in SQL, because a pipeline saves SQL, not columns."""
    words = SQLTransformer(
        statement=rf"SELECT *, regexp_extract_all(lower(`{text}`), r'[\p{{L}}\p{{N}}_]{{2,}}', 0) AS _words FROM __THIS__"
    )
    grams = ["_words"]
    for n in range(2, ngram_max + 1):
        if n == 2:  # as in ``functions.text``: the words beside their followers
            last = "greatest(size(_words) - 1, 0)"
            beside = f"zip_with(slice(_words, 1, {last}), slice(_words, 2, {last}), (a, b) -> concat_ws(' ', a, b))"
            grams.append(f"if(size(_words) >= 2, {beside}, cast(array() as array<string>))")
            continue
        joined = ", ".join(f"_words[i + {k}]" for k in range(n))
        grams.append(
            f"if(size(_words) >= {n}, transform(sequence(0, size(_words) - {n}), i -> concat_ws(' ', {joined})), "
            "cast(array() as array<string>))"
        )
    return words, SQLTransformer(statement=f"SELECT *, concat({', '.join(grams)}) AS terms FROM __THIS__")


def vocabulary_of(features: PipelineModel) -> list[str]:
    return next(s for s in features.stages if isinstance(s, CountVectorizerModel)).vocabulary


def long_form(featured: DataFrame, features: PipelineModel, key: str) -> DataFrame:
    """(key, term, weight) of the sparse vectors, unrolled without a shuffle or a join."""
    words = F.split(F.lit("\x01".join(vocabulary_of(features))), "\x01")
    inner = F.unwrap_udt("features")
    entries = F.arrays_zip(inner["indices"].alias("i"), inner["values"].alias("v"))
    rows = featured.select(key, F.inline(entries)).toDF(key, "index", "weight")
    return rows.select(key, F.element_at(words, F.col("index") + 1).alias("term"), "weight")
