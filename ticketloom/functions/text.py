"""Cleaning, admission, redaction, tokens and templates as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_CHARS = 1
MAX_CHARS = 5000

_WORD = r"[\p{L}\p{N}_]"
# Word boundaries over Unicode letters and digits, the same on every JVM: before a word
# character, after one, and (for a pattern that may start with a dot) either.
_HEAD = rf"(?<!{_WORD})"
_TAIL = rf"(?!{_WORD})"
_EDGE = rf"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"
# A digit whose run is not glued to a letter on its right.
_LOOSE_DIGIT = rf"\p{{Nd}}(?=\p{{Nd}}*+(?!{_WORD}))"

# What each rule matches, its placeholder, and the order of the rules.
# Email goes before UPI (which would take the first half of an address) and UPI before
# digits (which would take the phone number out of a handle). Quantifiers are possessive
# and starts are anchored where that cannot change a match, so long runs of one
# character cost linear time and no stack.
REDACTION_RULES: tuple[tuple[str, str, str], ...] = (
    (
        "email",
        r"(?:\G|(?<![\p{L}\p{N}_.+-]))[\p{L}\p{N}_.+-]++@[\p{L}\p{N}_-]++(?:\.[\p{L}\p{N}_-]++)++",
        "[email]",
    ),
    ("upi", rf"(?iu){_EDGE}[\p{{L}}\p{{N}}_.-]++@[a-z]{{2,}}{_TAIL}", "[upi]"),
    ("pan", rf"(?iu){_HEAD}[a-z]{{5}}\p{{Nd}}{{4}}[a-z]{_TAIL}", "[pan]"),
    ("ifsc", rf"(?iu){_HEAD}[a-z]{{4}}0[a-z0-9]{{6}}{_TAIL}", "[ifsc]"),
    (
        "number",
        rf"\+?{_HEAD}(?=(?:{_LOOSE_DIGIT}[ -]?){{7}}{_LOOSE_DIGIT})"
        rf"\p{{Nd}}++(?!{_WORD})(?:[ -]\p{{Nd}}++(?!{_WORD}))*+",
        "[number]",
    ),
    (
        "fragment",
        rf"(?iu)({_HEAD}ending(?: in| with)? |(?<!x)x{{2,}}+ ?)\p{{Nd}}{{4}}{_TAIL}",
        "$1[number]",
    ),
)
_RULES = {name: (pattern, token) for name, pattern, token in REDACTION_RULES}


def clean_text(text: Column) -> Column:
    """Lower-case, every run of whitespace to one space, no space at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)[\s\x1c-\x1f]+", " "))


def admission_reason(text: Column) -> Column:
    """Why a message is refused, or NULL when it is accepted."""
    return (
        F.when(text.isNull() | (F.length(text) < MIN_CHARS), F.lit("empty"))
        .when(F.length(text) > MAX_CHARS, F.lit("too_long"))
        .when(F.length(clean_text(text)) == 0, F.lit("blank"))
    )


def redact_rule(text: Column, name: str) -> Column:
    pattern, token = _RULES[name]
    return F.regexp_replace(text, pattern, token)


def redact(text: Column) -> Column:
    """All six rules in order.

    Two cheap tests skip the regexes on the many texts that cannot match: the first
    two rules need an at sign, the other four a digit.
    """
    addressed = F.when(
        F.contains(text, F.lit("@")), redact_rule(redact_rule(text, "email"), "upi")
    ).otherwise(text)
    numbered = addressed
    for name in ("pan", "ifsc", "number", "fragment"):
        numbered = redact_rule(numbered, name)
    return F.when(text.rlike(r"\p{Nd}"), numbered).otherwise(addressed)


def tokens(text: Column) -> Column:
    """Runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(rf"{_WORD}{{2,}}"), F.lit(0))


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _grams(words: Column, n: int) -> Column:
    if n == 2:  # the words beside their followers: quicker than to fetch each by its place
        last = F.greatest(F.size(words) - F.lit(1), F.lit(0))
        beside = [F.slice(words, F.lit(k), last) for k in (1, 2)]
        joined = F.zip_with(*beside, lambda a, b: F.concat_ws(" ", a, b))
    else:
        starts = F.sequence(F.lit(1), F.size(words) - F.lit(n - 1))
        joined = F.transform(
            starts, lambda i: F.concat_ws(" ", *[F.element_at(words, (i + F.lit(k)).cast("int")) for k in range(n)])
        )
    return F.when(F.size(words) >= n, joined).otherwise(F.array().cast("array<string>"))


def ngrams(words: Column, n: int) -> Column:
    """Neighbouring n words joined by a space; an empty array when there are fewer."""
    return _bind(words, lambda w: _grams(w, n))


def terms(text: Column, ngram_max: int = 2) -> Column:
    """1-grams up to n-grams of a text, in one array."""
    if ngram_max == 1:
        return tokens(text)
    return _bind(tokens(text), lambda w: F.concat(w, *[_grams(w, n) for n in range(2, ngram_max + 1)]))


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    """Put a value into every ``{name}``; all places of one name get the same value."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template
