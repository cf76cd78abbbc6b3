"""Secret scans: keyword prefilter, patterns anchored at the hits, checksums."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.llm.common import with_columns

#: Kinds in their order, keywords, patterns and least lengths.
KINDS = ("assign", "access", "hex", "github", "npm")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS_WORD = "akia"
SUMMED_WORDS = {
    "ghp_": "github",
    "gho_": "github",
    "ghu_": "github",
    "ghs_": "github",
    "ghr_": "github",
    "npm_": "npm",
}
ASSIGN = re.compile(
    rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
SUMMED = re.compile(rb"(?:gh[pousr]|npm)_([A-Za-z0-9]{36})(?![A-Za-z0-9])")
HEX = re.compile(rb"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

#: Marks every lower-case hex digit, so that a run of them becomes a literal to look for.
_MARKS = bytes(ord("h") if chr(b) in "0123456789abcdef" else ord(".") for b in range(256))
_RUN = b"h" * LEAST_HEX

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType(), False),
            T.StructField("start", T.LongType(), False),
            T.StructField("end", T.LongType(), False),
        ]
    ),
    False,
)


def checksum_ok(body: bytes) -> bool:
    """Whether the last six of 36 base-62 digits are the CRC32 of the first thirty."""
    value = zlib.crc32(body[:30])
    digits = bytearray()
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits.append(BASE62[digit])
    return bytes(reversed(digits)) == body[30:]


def keywords() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for word in (*ASSIGN_WORDS, ACCESS_WORD, *SUMMED_WORDS):
        kind = "assign" if word in ASSIGN_WORDS else "access" if word == ACCESS_WORD else SUMMED_WORDS[word]
        automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def spans_in_bytes(text: bytes, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, end, place of kind) of every secret, in bytes, by start and kind.

    One automaton pass over the lower-cased bytes finds where a pattern may begin;
    the pattern is tried there only. Hits come by their ends, so each kind's are put
    in order of start first. A pattern that matches takes its text even if it is too
    short to count: matches of a kind never overlap.
    """
    hits: dict[str, list[int]] = {"assign": [], "access": [], "github": [], "npm": []}
    for end, (kind, length) in automaton.iter(text.lower().decode("latin-1")):
        hits[kind].append(end - length + 1)
    found = []
    past = 0
    for start in sorted(hits["assign"]):
        if start >= past and (m := ASSIGN.match(text, start)):
            past = m.end()
            if m.end(1) - m.start(1) >= LEAST_ASSIGN:
                found.append((start, past, 0))
    past = 0
    for start in hits["access"]:
        if start >= past and (m := ACCESS.match(text, start)):
            past = m.end()
            if past - start >= LEAST_ACCESS:
                found.append((start, past, 1))
    marked = text.translate(_MARKS)
    start = marked.find(_RUN)
    while start >= 0:
        m = HEX.match(text, start)
        found.append((start, m.end(), 2))
        start = marked.find(_RUN, m.end())
    for place, kind in ((3, "github"), (4, "npm")):
        for start in hits[kind]:
            m = SUMMED.match(text, start)
            if m and checksum_ok(m[1]):
                found.append((start, m.end(), place))
    found.sort(key=lambda s: (s[0], s[2]))
    return found


def spans_of(text: bytes, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive."""
    found = spans_in_bytes(text, automaton)
    if not found or text.isascii():
        return [(KINDS[k], s, e) for s, e, k in found]
    points, done, count = {}, 0, 0
    for at in sorted({x for s, e, _ in found for x in (s, e)}):
        piece = text[done:at]
        count += len(piece.decode("utf-8"))
        points[at], done = count, at
    return [(KINDS[k], points[s], points[e]) for s, e, k in found]


def _scanner() -> Callable[[list[bytes]], list[list]]:
    automaton = keywords()

    def scan(texts: list[bytes]) -> list[list]:
        return [[[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t, automaton)] for t in texts]]

    return scan


def scan_secrets(docs: DataFrame, text: str = "text", frugal: bool = False) -> DataFrame:
    """``docs`` with ``secrets``: array of (kind, start, end) in code points by start, then kind.

    Kinds: ``assign`` (a named value of 12 characters or more, the span from name to
    value), ``access`` (an access key id of 18 or more), ``hex`` (a run of 16 or more),
    ``github`` and ``npm`` (tokens whose embedded checksum is right).

    Null and empty texts have no spans; repeated rows have equal spans; a column named
    ``secrets`` is replaced; an empty table stays empty. Texts are read whole, in
    batches, and nothing is shuffled. ``frugal`` as in ``with_columns``.
    """
    return with_columns(docs, text, T.StructType([T.StructField("secrets", SPANS, False)]), _scanner, frugal)


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; overlapping spans become one.

    Null stays null, and texts without a secret stay as they are. ``n_chars`` follows
    the text if there is such a column.
    """
    # Python workers idle on through the stages that follow, so they must not keep a batch's memory
    found = scan_secrets(docs, text, frugal=True)

    def merged(spans):
        """The spans by start, each overlapping one folded into its predecessor."""
        start = F.array().cast("array<struct<start:bigint,end:bigint>>")

        def fold(done, span):
            last = F.try_element_at(done, F.lit(-1))
            joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
            new = F.struct(span["start"].alias("start"), span["end"].alias("end"))
            overlaps = F.coalesce(span["start"] < last["end"], F.lit(False))
            return F.when(
                overlaps, F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))
            ).otherwise(F.concat(done, F.array(new)))

        return F.aggregate(spans, start, fold)

    def cut(spans):
        """The text with the spans replaced from the last to the first, so that offsets stay right."""
        return F.aggregate(
            F.reverse(spans),
            F.col(text),
            lambda t, s: F.concat(
                F.substring(t, F.lit(1), s["start"].cast("int")),
                F.lit(mark),
                F.substring(t, s["end"].cast("int") + 1, F.length(t)),
            ),
        )

    cleaned = F.when(F.size("secrets") > 0, cut(merged(F.col("secrets")))).otherwise(F.col(text))
    rows = found.withColumn(text, cleaned)
    if "n_chars" in docs.columns:
        same = F.size("secrets") == 0
        rows = rows.withColumn(
            "n_chars", F.when(same, F.col("n_chars")).otherwise(F.length(text).cast(docs.schema["n_chars"].dataType))
        )
    return rows.select(*[c for c in docs.columns])
