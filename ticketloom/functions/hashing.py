"""Seeded randomness that depends on the row key only, never on the partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(seed: str | int, *keys: str | Column) -> Column:
    """A number in [0, 1): the first 32 bits of md5(seed|key|...)."""
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def pick(choices: list[str], u: Column) -> Column:
    """The element of a literal list that a uniform number points at."""
    index = F.floor(u * F.lit(float(len(choices)))).cast("int") + F.lit(1)
    return F.element_at(F.array(*[F.lit(c) for c in choices]), index)
