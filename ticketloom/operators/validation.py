"""Column checks before a job and row checks inside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.functions.text import admission_reason, clean_text
from ticketloom.session import fresh_path


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    return df


def require_choice(value: str, choices: tuple[str, ...], what: str) -> str:
    if value not in choices:
        raise ValueError(f"unknown {what} {value!r}; expected one of {choices}")
    return value


def normalise(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.lower(F.trim(F.col(c))) for c in columns})


def row_problems(text: Column, checks: dict[str, tuple[Column, list[str]]]) -> Column:
    """Every problem of a row as an array: blank text, and values outside their domain."""
    found = [F.when(F.coalesce(F.length(F.trim(text)), F.lit(0)) == 0, F.lit("empty text"))]
    for name, (value, domain) in checks.items():
        shown = F.concat(F.lit(f"unknown {name} '"), F.coalesce(value, F.lit("")), F.lit("'"))
        found.append(F.when(~F.coalesce(value.isin(domain), F.lit(False)), shown))
    return F.array_compact(F.array(*found))


def invalid_rows(df: DataFrame, key: str, problems: Column) -> DataFrame:
    return df.select(key, problems.alias("problems")).where(F.size("problems") > 0)


def require_valid(df: DataFrame, key: str, problems: Column, path: str | None = None) -> DataFrame:
    """Raise if there are bad rows.

    All of them are written to ``path``, by default a new folder in the shared one; the
    error names their number and that place, never their texts.
    """
    path = path or fresh_path(df.sparkSession, "problems")
    bad = invalid_rows(df, key, problems)
    bad.write.mode("overwrite").json(path)
    count = df.sparkSession.read.schema(bad.schema).json(path).count()
    if count:
        raise ValueError(f"{count} rows have problems, see {path}")
    return df


def admit(df: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """(accepted with cleaned text, quarantined with ``reason``)."""
    tagged = df.withColumn("reason", admission_reason(F.col(text)))
    accepted = tagged.where("reason IS NULL").drop("reason").withColumn(text, clean_text(F.col(text)))
    return accepted, tagged.where("reason IS NOT NULL")


def prepare(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """Clean the text and drop rows without text or label."""
    kept = df.where(F.col(text).isNotNull() & F.col(label).isNotNull())
    return kept.withColumn(text, clean_text(F.col(text))).where(F.length(text) > 0)
