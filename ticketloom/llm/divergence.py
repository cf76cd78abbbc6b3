"""Quality rules: counted rules, and divergence from language references."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.llm.common import slices, with_columns
from ticketloom.llm.components import Stash

#: Characters that count as symbols, and function words of each language.
SYMBOLS = b"#*$%&|<>"
COMMON_WORDS = {
    "de": "der die das und ist in zu den mit von für auf ein eine nicht im des dem als auch es an bei sie er wie wird sich",
    "en": "the of and to in is that for it as was with be by on not he this are or his from at which but have an they you",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ya este",
    "fr": "de la le et les des en un du une que est pour qui dans par pas sur au avec il ce plus ne se son elle ou",
}
#: Classes of characters, by code point: see ``character_class``.
CLASSES = ("lower", "upper", "beyond", "digit", "space", "line", "stop", "symbol", "other")

#: Least counts for a distance to be judged, and the largest distances that pass (0 to 1).
LEAST_WORDS, LEAST_CHARS, LEAST_COMMON = 50, 200, 100
FAR_CHARS, FAR_WORDS = 0.30, 0.75
#: Quartile ranges above the upper quartile where a language's own documents end, and steps
#: of 1 / GRID on which their squared distances are counted.
FENCE, GRID = 3.0, 4096
#: Shares of a document's words that its rules may reach.
FEWEST_WORDS, MOST_REPEATED = 50, 50

_WORDS = sorted({w for words in COMMON_WORDS.values() for w in words.split()})
_PLACE = {w.encode(): i for i, w in enumerate(_WORDS)}
_EDGES = b".,;:!?\"'()[]"


def character_class() -> np.ndarray:
    """The class of each byte of UTF-8; bytes that continue a code point have none (-1)."""
    table = np.full(256, CLASSES.index("other"), np.int64)
    for byte in range(256):
        sign = chr(byte)
        if 0x80 <= byte < 0xC0:
            table[byte] = -1
        elif byte >= 0xC0:
            table[byte] = CLASSES.index("beyond")
        elif sign.islower():
            table[byte] = CLASSES.index("lower")
        elif sign.isupper():
            table[byte] = CLASSES.index("upper")
        elif sign.isdigit():
            table[byte] = CLASSES.index("digit")
        elif sign in "\n":
            table[byte] = CLASSES.index("line")
        elif sign.isspace():
            table[byte] = CLASSES.index("space")
        elif sign in ".,;:!?'\"-()":
            table[byte] = CLASSES.index("stop")
        elif byte in SYMBOLS:
            table[byte] = CLASSES.index("symbol")
    return table


_CLASS_OF = character_class()
_SIZE = len(CLASSES)


def repeated_words(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of each text, the words in 3-word windows that come twice or more in it.

    ``codes`` are the words of all texts as numbers, text after text. A window's key is
    built from its text and its three words by two rounds of numbering, so equal keys
    are equal windows.
    """
    out = np.zeros(len(sizes), np.int64)
    if len(codes) < 3:
        return out
    owner = np.repeat(np.arange(len(sizes)), sizes)
    whole = np.flatnonzero(owner[:-2] == owner[2:])
    if not len(whole):
        return out
    width = np.int64(codes.max()) + 1
    _, pairs = np.unique(codes[whole] * width + codes[whole + 1], return_inverse=True)
    _, windows = np.unique(pairs * width + codes[whole + 2], return_inverse=True)
    _, place, count = np.unique(windows * np.int64(len(sizes)) + owner[whole], return_inverse=True, return_counts=True)
    again = whole[count[place] > 1]
    covered = np.zeros(len(codes), bool)
    for step in range(3):
        covered[again + step] = True
    return np.bincount(owner[covered], minlength=len(sizes))


def counted(texts: list[bytes]) -> list[list]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, char_counts, word_counts of each text."""
    columns: list[list] = [[] for _ in range(7)]
    for start, end in slices(texts):
        part = texts[start:end]
        numbers: dict[bytes, int] = {}
        words = [t.split() for t in part]
        sizes = np.array([len(w) for w in words], np.int64)
        codes = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in words for w in ws), np.int64, int(sizes.sum()))
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        # the classes, lengths and places of distinct words serve all their occurrences
        points = np.array([len(w.decode()) for w in numbers], np.int64) if numbers else np.zeros(1, np.int64)
        places = np.array([_PLACE.get(w.lower().strip(_EDGES), -1) for w in numbers], np.int64)
        owner = np.repeat(np.arange(len(part)), sizes)
        chars = np.bincount(owner, weights=points[codes], minlength=len(part)).astype(np.int64)
        common = places[codes] if len(codes) else np.zeros(0, np.int64)
        found = np.bincount(
            owner[common >= 0] * len(_WORDS) + common[common >= 0], minlength=len(part) * len(_WORDS)
        ).reshape(len(part), len(_WORDS))
        repeats = repeated_words(codes, starts, sizes)
        for i, text in enumerate(part):
            lines = [line for line in text.split(b"\n") if line.strip(b"\x20\t\n\x0b\x0c\r")]
            raw = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
            classes = np.bincount(_CLASS_OF + 1, weights=raw, minlength=_SIZE + 1)[1:].astype(np.int64)
            columns[0].append(int(sizes[i]))
            columns[1].append(int(chars[i]))
            columns[2].append(int(raw[list(SYMBOLS)].sum()))
            columns[3].append(len(lines) - len(set(lines)))
            columns[4].append(int(repeats[i]))
            columns[5].append(classes.tolist())
            columns[6].append(found[i].tolist())
    return columns


COUNTED = T.StructType(
    [
        *[
            T.StructField(n, T.LongType(), False)
            for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        ],
        T.StructField("char_counts", T.ArrayType(T.LongType(), False), False),
        T.StructField("word_counts", T.ArrayType(T.LongType(), False), False),
    ]
)


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts that the rules need; null texts count as empty ones."""
    return with_columns(docs, text, COUNTED, lambda: counted)


def base_failed() -> Column:
    """Too few words, or more than half of them in repeated windows."""
    return (F.col("n_words") < FEWEST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)


def references(counts: DataFrame, lang: str = "lang") -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Histograms of each language (characters, common words, all words) over all its documents that pass the base rules.

    Every document weighs the same whatever its length, so that a few long ones do not
    stand for a language; copies do count. One partial aggregate over the whole table;
    only a row for each language and bin comes to the driver. Documents without a
    language are in none.
    """
    rows = counts.where(~base_failed() & F.col(lang).isNotNull())
    rows = rows.select(F.col(lang).cast("string").alias("lang"), "char_counts", "word_counts", "n_words")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sum of the documents' shares for each language of a batch: one row for each."""
        for batch in batches:
            names, owner = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object), return_inverse=True)
            chars, words = _counts(batch.column("char_counts"), _SIZE), _counts(batch.column("word_counts"), len(_WORDS))
            shares = np.concatenate([_shares(x) for x in (chars, words, _all_words(words, batch.column("n_words")))], axis=1)
            sums = np.zeros((len(names), shares.shape[1]))
            np.add.at(sums, owner, shares)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.tolist(), pa.string()), pa.array(list(sums), pa.list_(pa.float64()))], names=["lang", "sums"]
            )

    summed = rows.mapInArrow(partial, "lang string, sums array<double>").select("lang", F.posexplode("sums").alias("bin", "part"))
    total: dict[str, np.ndarray] = {}
    for row in summed.groupBy("lang", "bin").agg(F.sum("part").alias("total")).collect():
        total.setdefault(row["lang"], np.zeros(_SIZE + 2 * len(_WORDS) + 1))[row["bin"]] = row["total"]
    found = {}
    for name, sums in sorted(total.items()):
        chars, words, every = np.split(sums, [_SIZE, _SIZE + len(_WORDS)])
        if chars.sum() > 0:
            found[name] = (chars / chars.sum(), words / words.sum() if words.sum() > 0 else words, every / every.sum())
    return found


def _counts(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(-1, size)


def _all_words(words: np.ndarray, n_words: pa.Array) -> np.ndarray:
    """Counts of common words with one more bin for all other words."""
    others = n_words.to_numpy().astype(np.float64) - words.sum(axis=1)
    return np.concatenate([words, others[:, None]], axis=1)


def _shares(counts: np.ndarray) -> np.ndarray:
    """Each document's counts over their sum; zeros where there is none."""
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) of each row of p from each row of q, which sum to 1."""
    p, q = p[:, None, :], q[None, :, :]
    middle = (p + q) / 2

    def part(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log2(np.where(x > 0, x / np.where(middle > 0, middle, 1), 1)), 0).sum(axis=2)

    return np.sqrt(np.maximum((part(p) + part(q)) / 2, 0))


DISTANCES = T.StructType(
    [
        T.StructField("nearest", T.StringType()),
        T.StructField("char_distance", T.DoubleType()),
        T.StructField("word_distance", T.DoubleType()),
        T.StructField("all_words_distance", T.DoubleType()),
    ]
)


def measure(counts: DataFrame, known: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    """``counts`` with the nearest reference and the distances from it; null without a reference or counts."""
    names = list(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars, words = _counts(batch.column("char_counts"), _SIZE), _counts(batch.column("word_counts"), len(_WORDS))
            rows = len(chars)
            made: list[list] = [[None] * rows for _ in range(4)]
            if names:
                sums = chars.sum(axis=1, keepdims=True), words.sum(axis=1, keepdims=True)
                of_chars = js_distance(chars / np.maximum(sums[0], 1), np.stack([known[n][0] for n in names]))
                of_words = js_distance(words / np.maximum(sums[1], 1), np.stack([known[n][1] for n in names]))
                of_words = np.where(sums[1] > 0, of_words, 1.0)
                every = _shares(_all_words(words, batch.column("n_words")))
                of_all = js_distance(every, np.stack([known[n][2] for n in names]))
                near = (of_chars**2 + of_words**2).argmin(axis=1)
                for i in np.flatnonzero(sums[0][:, 0] > 0).tolist():
                    name = names[near[i]]
                    made[0][i], made[1][i] = name, float(of_chars[i, near[i]])
                    made[2][i] = float(of_words[i, near[i]]) if known[name][1].any() else None
                    made[3][i] = float(of_all[i, near[i]]) if every[i].any() else None
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.float64())
            new = [pa.array(v, k) for v, k in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *DISTANCES.names])

    return counts.mapInArrow(run, T.StructType([*counts.schema.fields, *DISTANCES.fields]))


def verdict() -> Column:
    """Whether the distances let a document pass; what is too short to be judged passes."""
    long_enough = (F.col("n_words") >= LEAST_WORDS) & (F.col("word_chars") >= LEAST_CHARS)
    strange = F.coalesce(F.col("char_distance") > FAR_CHARS, F.lit(False))
    foreign = (F.col("n_words") >= LEAST_COMMON) & F.coalesce(F.col("word_distance") > FAR_WORDS, F.lit(False))
    return ~(long_enough & (strange | foreign))


def spreads(measured: DataFrame, lang: str = "lang") -> list[tuple[str, float, float]]:
    """(language, slope, limit): how far a language's own documents are from its reference.

    The squared distance over all words falls with a document's length as slope / n_words,
    by least squares; the limit of what is left is FENCE quartile ranges above the upper
    quartile. Own documents pass the base rules and are nearest to their language. Only
    sums and counts on a grid come to the driver.
    """
    own = measured.where(~base_failed() & (F.col("nearest") == F.col(lang).cast("string")))
    own = own.select("nearest", (F.lit(1.0) / F.col("n_words")).alias("x"), (F.col("all_words_distance") ** 2).alias("y"))
    fitted = own.groupBy("nearest").agg(F.regr_slope("y", "x").alias("slope"))
    slopes = {r["nearest"]: max(0.0, r["slope"] or 0.0) for r in fitted.collect()}
    if not slopes:
        return []
    known = F.broadcast(own.sparkSession.createDataFrame(list(slopes.items()), "nearest string, slope double"))
    step = F.floor((F.col("y") - F.col("slope") * F.col("x")) * GRID).alias("step")
    steps: dict[str, list[tuple[int, int]]] = {}
    for r in own.join(known, "nearest").groupBy("nearest", step).count().collect():
        steps.setdefault(r["nearest"], []).append((r["step"], r["count"]))
    found = []
    for name, counted_steps in sorted(steps.items()):
        values, sizes = (np.array(v) for v in zip(*sorted(counted_steps), strict=True))
        lower, upper = (int(values[np.searchsorted(np.cumsum(sizes), part * sizes.sum())]) for part in (0.25, 0.75))
        found.append((name, slopes[name], (upper + 1 + FENCE * (upper + 1 - lower)) / GRID))
    return found


def judge(docs: DataFrame, stash: Stash, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without its text, with counts, distances, ``base_failed`` and ``kept``.

    The histograms of character classes and of common words are counted once and kept as
    a small table; the references are their means over all documents of a language; a
    document is measured against the nearest reference by the Jensen-Shannon distance.
    ``kept`` asks for three things of a document that passes the base rules: that its
    characters and, where it has LEAST_COMMON words, its common words among themselves are
    not far from the reference; and, at every length, that its distance over all
    words, with one bin for all others, lies within the spread of the language's own documents.

    Null and empty texts have no words and fail the base rules; documents without a
    language are measured but are in no reference; without references only the base
    rules count; repeated rows get equal answers; clashing columns are replaced; an
    empty table stays empty.
    """
    counts = stash.put(count_words(docs, text).drop(text), "counts")
    measured = stash.put(measure(counts, references(counts, lang)), "measured")
    judged = measured.withColumn("base_failed", base_failed())
    limits = counts.sparkSession.createDataFrame(spreads(measured, lang), "_near string, _slope double, _limit double")
    judged = judged.join(F.broadcast(limits), F.col("nearest") == F.col("_near"), "left")
    beyond = F.col("all_words_distance") ** 2 - F.col("_slope") / F.nullif(F.col("n_words"), F.lit(0)) > F.col("_limit")
    kept = ~F.col("base_failed") & verdict() & ~F.coalesce(beyond, F.lit(False))
    return judged.withColumn("kept", kept).drop("_near", "_slope", "_limit")
