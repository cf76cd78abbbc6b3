"""Complement naive Bayes under many settings at once: texts are tokenised once, one cube of counts serves all."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.feature import IDF, CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.scores import top_class
from ticketloom.functions.text import terms
from ticketloom.operators import linear
from ticketloom.operators.features import MAX_FEATURES, NGRAM_MAX
from ticketloom.session import settle


@dataclass(frozen=True)
class Setting:
    """One fit: the column with the labels, the longest n-gram and the size of the vocabulary."""

    name: str
    label: str
    ngram_max: int = NGRAM_MAX
    max_features: int = MAX_FEATURES


def leading_terms(counts: DataFrame, lengths: int, most: int) -> DataFrame:
    """The ``most`` first rows of (term, n, length) of each length up to ``lengths``, most frequent first, ties in alphabetical order.

    Every task keeps the first rows of its own, and only those meet in one task, whatever the number of terms.
    """
    firsts = [counts.where(F.col("length") == n).orderBy(F.desc("n"), "term").limit(most) for n in range(1, lengths + 1)]
    return reduce(DataFrame.unionByName, firsts)


def ranked_terms(train: DataFrame, settings: list[Setting]) -> list[list[str]]:
    """The vocabulary of each setting, most frequent first, ties in alphabetical order, from one count of ``terms``.

    The first terms among all lengths are among the first of their own length, so only
    those come to the driver. A smaller vocabulary is the beginning of a larger one.
    """
    most = max(s.max_features for s in settings)
    counts = train.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    counts = settle(counts.withColumn("length", F.size(F.split("term", " "))), "term-counts")
    rows = leading_terms(counts, max(s.ngram_max for s in settings), most).collect()
    rows.sort(key=lambda r: (-r["n"], r["term"]))
    found = [[r["term"] for r in rows if r["length"] <= s.ngram_max][: s.max_features] for s in settings]
    if not all(found):
        raise ValueError("no terms in the training text")
    return found


def _weights(cube: list, classes: list[str], setting: Setting, at: int, known: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """(classes, terms): minus the log share of each term in the other classes, times idf; 0 outside the vocabulary."""
    own = np.zeros((len(classes), len(known)))
    place = {c: i for i, c in enumerate(classes)}
    for row in cube:
        own[place[row[setting.label]], row["i"]] += row[f"s{at}"]
    others = (own.sum(axis=0) - own + 1.0) * known
    share = others / others.sum(axis=1, keepdims=True)
    return -np.log(np.where(known, share, 1.0)) * idf


def held_out_predictions(rows: DataFrame, held: Column, settings: list[Setting], text: str = "text") -> DataFrame:
    """(setting, label, predicted_label) of the rows that are ``held`` out, for models fitted on all others.

    1. Texts are split into terms once, and kept as a table with the labels and ``held``.
    2. One count gives every setting's vocabulary; rows are counted over their union, which
       has at most ``max_features`` terms for each n-gram length.
    3. One aggregate over the training rows gives the cube: for every term and label, the sum of
       weights under each setting, rows being scaled to unit length in each. Its size is bounded by
       terms and classes; it alone comes to the driver, and becomes one matrix.
    4. A held-out row is scored for all settings by one multiply. Its length does not
       matter, since it scales all classes of a setting alike.

    Rows without a label in any setting, or where ``held`` is null, take no part.
    """
    labels = sorted({s.label for s in settings})
    longest = max(s.ngram_max for s in settings)
    split = rows.select(
        *[F.col(c).cast("string").alias(c) for c in labels], held.alias("_held"), terms(F.col(text), longest).alias("terms")
    )
    split = settle(split.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in labels])), "terms")
    train, test = split.where(~F.col("_held")), split.where("_held")
    ranked = ranked_terms(train, settings)
    vocabulary = sorted(set().union(*ranked))
    number = {term: i for i, term in enumerate(vocabulary)}
    known = np.zeros((len(settings), len(vocabulary)), bool)
    for s, chosen in enumerate(ranked):
        known[s, [number[t] for t in chosen]] = True

    count = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="terms", outputCol="features")
    counted = count.transform(train).select(*labels, "features")
    idf = IDF(inputCol="features", outputCol="_idf").fit(counted).idf.toArray() + 1.0
    names = train.agg(*[F.collect_set(c).alias(c) for c in labels]).first()
    classes = {c: sorted(names[c]) for c in labels}

    scale, inner = linear.doubles(idf.tolist()), F.unwrap_udt("features")
    inside = [F.split(F.lit(",".join("1" if k else "0" for k in row)), ",").cast("array<int>") for row in known]

    def entry(i: Column, v: Column) -> Column:
        weight = v * F.get(scale, i)
        return F.struct(i.alias("i"), *[(weight * F.get(mask, i)).alias(f"w{s}") for s, mask in enumerate(inside)])

    entries = F.zip_with(inner["indices"], inner["values"], entry)
    norms = [f"_n{s}" for s in range(len(settings))]

    def with_lengths(own: Column) -> Column:
        def length(weight: str) -> Column:
            return F.sqrt(F.aggregate(own, F.lit(0.0), lambda total, e: total + e[weight] * e[weight]))

        return F.struct(own.alias("entries"), *[length(f"w{s}").alias(n) for s, n in enumerate(norms)])

    # a generator around the entries, so that they are made once and not again for each length
    weighted = counted.select(*labels, F.inline(F.transform(F.array(entries), with_lengths)))
    flat = weighted.select(*labels, *norms, F.inline("entries"))
    sums = [F.sum(F.when(F.col(n) > 0, F.col(f"w{s}") / F.col(n)).otherwise(0.0)).alias(f"s{s}") for s, n in enumerate(norms)]
    cube = flat.groupBy("i", *labels).agg(*sums).collect()

    blocks = [_weights(cube, classes[x.label], x, s, known[s], idf) for s, x in enumerate(settings)]
    matrix = np.hstack([np.vstack(blocks), np.zeros((sum(map(len, blocks)), 1))])
    scored = linear.multiplied(count.transform(test).select(*labels, "features"), linear.matrix_model(rows.sparkSession, matrix), "_scores")
    verdicts, first = [], 1
    for x, block in zip(settings, blocks, strict=True):
        best = top_class(F.slice("_scores", first, len(block)), classes[x.label])
        verdicts.append(F.struct(F.lit(x.name).alias("setting"), F.col(x.label).alias("label"), best.alias("predicted_label")))
        first += len(block)
    return scored.select(F.inline(F.array(*verdicts)))
