"""Class scores: the map, the winning class, the review route."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEEDS_REVIEW = "needs_review"
REVIEW_THRESHOLD = 0.7


def score_map(classes: Column, values: Column) -> Column:
    """Class to score; arrays of different length raise."""
    return F.when(F.size(classes) == F.size(values), F.map_from_arrays(classes, values)).otherwise(
        F.raise_error(F.lit("classes and scores differ in length"))
    )


def map_top_class(scores: Column) -> Column:
    """The class with the highest score; a tie goes to the first class in sorted order."""
    best = map_confidence(scores)
    return F.array_min(F.map_keys(F.map_filter(scores, lambda _, v: v == best)))


def map_confidence(scores: Column) -> Column:
    return F.array_max(F.map_values(scores))


def top_class(scores: Column, classes: list[str]) -> Column:
    """As above for an array of scores in the order of the sorted classes."""
    position = F.array_position(scores, F.array_max(scores)).cast("int")
    return F.element_at(F.array(*[F.lit(c) for c in classes]), position)


def route(label: Column, confidence: Column, threshold: float = REVIEW_THRESHOLD) -> Column:
    """The label when it is sure enough, otherwise the review queue."""
    return F.when(confidence >= F.lit(float(threshold)), label).otherwise(F.lit(NEEDS_REVIEW))
