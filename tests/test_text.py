from __future__ import annotations

import random
import re

import duckdb
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from ticketloom.functions import text as tx
from ticketloom.functions.intents import INTENT_QUEUES, QUEUES, mapping_table
from ticketloom.operators import features, pii, validation
from ticketloom.plans.views import REDACT_SQL, redact_sql

def sql_redact(values, rules=tuple(REDACT_SQL)):
    """The rules of the SQL side, in DuckDB's regex engine."""
    listed = duckdb.execute(f"SELECT i, {redact_sql('t', rules)} FROM (SELECT unnest(range(len(?))) AS i, unnest(?) AS t)", [values, values])
    return [t for _, t in sorted(listed.fetchall())]


def column(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i long, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def test_clean_text(spark):
    values = ["  A\tB\n\nc ", "x y z\x1fw", "\x1c", "ÀÉ"]
    assert column(spark, values, tx.clean_text) == [re.sub(r"\s+", " ", v.lower()).strip() for v in values]


def test_redaction_examples(spark):
    cases = {
        "write to ann.lee+x@mail.example.co.in.": "write to [email].",
        "pay 9876500000@ybl now": "pay [upi] now",
        "PAN abcde1234f, IFSC SBIN0001234": "PAN [pan], IFSC [ifsc]",
        "call +91 98765 43210 or 1234-5678-9012": "call [number] or [number]",
        "card ending in 4321, XXXX5678": "card ending in [number], XXXX[number]",
        "order #10231 in 2024 at 10:30 on 12/09/2026, v2.10.3, @support": "order #10231 in 2024 at 10:30 on 12/09/2026, v2.10.3, @support",
        "a@b.c+d@e.f": "[email]" + "[email]",
        "1234 5678a": "1234 5678a",
        "12345678 9a": "[number] 9a",
    }
    assert column(spark, list(cases), tx.redact) == list(cases.values())


def test_redaction_knows_letters_and_digits_of_other_scripts(spark):
    # expected by reading Python's \b, \d and \w, which know Unicode; DuckDB's do not
    cases = {
        "é@ybl": "[upi]",
        "josé@correo.es": "[email]",
        "a@yblé": "a@yblé",
        "a@ſk": "[upi]",
        "abcde1234fé": "abcde1234fé",
        "éabcde1234f": "éabcde1234f",
        "abcde१२३४f": "[pan]",
        "SBIN0१23456": "SBIN0१23456",
        "éSBIN0001234": "éSBIN0001234",
        "९८७६५४३२": "[number]",
        "١٢٣٤٥٦٧٨": "[number]",
        "12345678é": "12345678é",
        "é12345678": "é12345678",
        "ending in १२३४": "ending in [number]",
        "éending in 1234": "éending in 1234",
        "éxx1234": "éxx[number]",
        "xx1234é": "xx1234é",
    }
    assert column(spark, list(cases), tx.redact) == list(cases.values())


def test_redaction_equals_the_other_engine_on_random_text(spark):
    rng = random.Random(5)
    pieces = ["a", "ab@", "x", "xx", "XX ", "1", "12", "1234", "12345678", " ", "-", "+", ".", "@", "_", "ending ", "ending in ",
              "abcde1234f", "sbin0001234", "ok", "b.c", "\n"]
    values = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(20000)]
    got = column(spark, values, tx.redact)
    wrong = [(v, g, w) for v, g, w in zip(values, got, sql_redact(values), strict=True) if g != w]
    assert not wrong, wrong[:5]


def test_each_rule_alone_equals_the_other_engine(spark):
    rng = random.Random(6)
    alphabet = "aAxX01 9-+.@_f"
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(8000)]
    for name in REDACT_SQL:
        got = column(spark, values, lambda c, n=name: tx.redact_rule(c, n))
        want = sql_redact(values, (name,))
        wrong = [(name, v, g, w) for v, g, w in zip(values, got, want, strict=True) if g != w]
        assert not wrong, wrong[:5]


def test_redaction_survives_long_runs(spark):
    values = ["1 " * 200_000 + "a", "x" * 300_000 + "@1", "7" * 300_000, "a@b" + ".c" * 100_000, "-".join(["ab"] * 3000) + "@ 1"]
    got = column(spark, values, lambda c: F.length(tx.redact(c)))
    assert got[2] == len("[number]") and got[3] == len("[email]")


def test_redaction_stays_native(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("t"))
    assert "Python" not in plan(df.select(tx.redact(tx.clean_text(F.col("t")))))


def test_admission_bounds(spark):
    values = ["", "a", "a" * 5000, "a" * 5001, " \n ", None]
    assert column(spark, values, tx.admission_reason) == ["empty", None, None, "too_long", "blank", "empty"]


def test_tokens_and_ngrams(spark):
    assert column(spark, ["I pay 5, twice a-day_x é éa", "", "one"], tx.tokens) == [["pay", "twice", "day_x", "éa"], [], ["one"]]
    assert column(spark, ["aa bb cc", "aa", ""], lambda c: tx.terms(c, 3)) == [
        ["aa", "bb", "cc", "aa bb", "bb cc", "aa bb cc"], ["aa"], []
    ]
    assert column(spark, ["aa bb cc"], lambda c: tx.ngrams(tx.tokens(c), 2)) == [["aa bb", "bb cc"]]


def test_template_tokens_share_their_value(spark):
    assert column(spark, ["{a} and {a} {b} {c}"], lambda c: tx.fill_template(c, {"a": F.lit("1"), "b": F.lit("2")})) == ["1 and 1 2 {c}"]


def test_vocabulary_ties_are_alphabetical(spark):
    df = spark.createDataFrame([("bb aa bb cc aa dd",)], "t string")
    top = features.top_terms(features.term_counts(df, "t", 1), 3)
    assert rows(top) == [("aa", 2), ("bb", 2), ("cc", 1)]


def test_pii_scores(spark):
    cases = spark.createDataFrame(
        [("email", "a@b.co", "to a@b.co"), ("name", "Bob", "dear bob"), ("multi", "a@ok|123456789", "a@ok 123456789"), ("none", "", "pay 49"), ("none", "", "to a@b.co")],
        "kind string, pii string, text string",
    )
    got = {r["kind"]: (r["pii_values"], r["recall"]) for r in pii.recall_by_kind(cases).collect()}
    assert got == {"email": (1, 1.0), "name": (1, 0.0), "multi": (2, 1.0), "overall": (4, 0.75)}
    assert tuple(pii.untouched_share(cases).first()) == (2, 0.5)


def test_row_problems_list_everything(spark, tmp_path):
    df = spark.createDataFrame([(1, " ", " SPAM", "xx"), (2, "hi", "Billing ", "english")], "id int, text string, label string, style string")
    df = validation.normalise(df, ["label", "style"])
    checks = {"label": (F.col("label"), list(QUEUES)), "style": (F.col("style"), ["english"])}
    problems = validation.row_problems(F.col("text"), checks)
    bad = validation.invalid_rows(df, "id", problems)
    assert rows(bad) == [(1, ["empty text", "unknown label 'spam'", "unknown style 'xx'"])]
    path = str(tmp_path / "problems")
    with pytest.raises(ValueError, match="1 rows have problems") as error:
        validation.require_valid(df, "id", problems, path)
    assert "spam" not in str(error.value) and spark.read.json(path).first()["id"] == 1
    validation.require_valid(df.where("id = 2"), "id", problems)
    many = spark.range(60).select("id", F.lit("").alias("text"))
    with pytest.raises(ValueError, match="60 rows"):
        validation.require_valid(many, "id", validation.row_problems(F.col("text"), {}), path)
    assert spark.read.json(path).count() == 60


def test_required_columns_and_choices(spark):
    with pytest.raises(ValueError, match="label"):
        validation.require_columns(spark.range(1), ["id", "label"])
    with pytest.raises(ValueError, match="split"):
        validation.require_choice("odd", ("official", "random"), "split")


def test_null_text_is_dropped(spark):
    df = spark.createDataFrame([(None, "a"), ("  ", "a"), ("X  y", "a"), ("x", None)], "text string, label string")
    assert rows(validation.prepare(df)) == [("x y", "a")]


def test_fixed_mapping_is_complete(spark):
    assert len(INTENT_QUEUES) == 77 and set(INTENT_QUEUES.values()) == set(QUEUES)
    table = mapping_table(spark)
    counts = dict(rows(table.groupBy("queue").count()))
    assert counts == {"billing": 25, "technical": 14, "account": 19, "card_delivery": 6, "general": 13}


def test_bigrams_stand_beside_their_words(spark):
    """The column and the saved pipeline's SQL give the same terms, also of texts too short for one."""
    texts = ["", None, "a", "ab", "ab cd", "ab x cd ab cd", "éé ab_1 12"]
    words = [[w for w in (t or "").split() if len(w) > 1] for t in texts]
    expected = [None if t is None else [*w, *map(" ".join, zip(w, w[1:]))] for t, w in zip(texts, words, strict=True)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    split, gram = features._term_stages("text", 2)
    for made in (rows.withColumn("terms", tx.terms(F.col("text"))), gram.transform(split.transform(rows))):
        assert [r["terms"] for r in made.orderBy("id").collect()] == expected
        assert "sequence(" not in plan(made)
    odd = spark.createDataFrame([(["a", None, "b"],), (None,), ([None],), ([],)], "w array<string>")
    assert [r[0] for r in odd.select(tx.ngrams(F.col("w"), 2)).collect()] == [["a", "b"], [], [], []]
