"""Language identification by partial matching: context trees of bytes with escapes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.llm.common import crc_mod, slices, with_columns

#: Longest context in bytes.
ORDER = 3
#: Bounds of the labelled sample the trees are grown from: rows of each language, bytes of a text.
ROWS_PER_LANGUAGE, LONGEST = 400, 32_768
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")


@dataclass
class Trees:
    """Frozen statistics of all languages, laid out for lookup.

    ``node`` maps the last ORDER symbols to the deepest context that any language
    knows, and ``cost`` holds for each context and symbol the exact length in bits of
    the symbol's code in every language: the escapes down to a context that has the
    symbol, and the symbol there.
    """

    languages: list[str]
    symbol: np.ndarray  # byte -> symbol; 0 stands before a text, 1 is any byte that was never learned
    node: np.ndarray  # ORDER symbols in base ``letters`` -> context
    cost: np.ndarray  # contexts * letters x languages

    @property
    def letters(self) -> int:
        return int(self.symbol.max()) + 1


def _keys(symbols: np.ndarray, length: int, letters: int) -> np.ndarray:
    """Of every place, the ``length`` symbols that end there as one number; 0 stands before the text."""
    key = np.zeros(len(symbols), np.int64)
    for back in range(length - 1, -1, -1):
        shifted = np.concatenate([np.zeros(back, np.int64), symbols[: len(symbols) - back]])
        key = key * letters + shifted[: len(symbols)]
    return key


def grow(samples: dict[str, list[bytes]]) -> Trees:
    """Count every context of up to ORDER bytes in each language and freeze the counts.

    Escape method C: where a context has been followed by d different symbols in n
    places, a new symbol has probability d / (n + d) and a known one count / (n + d).
    Below the empty context all 256 bytes are equally likely. A language that has never
    seen a context goes on with the next shorter one at no cost.
    """
    languages = sorted(samples)
    seen = sorted({b for texts in samples.values() for t in texts for b in t})
    symbol = np.zeros(256, np.int64)
    symbol[:] = 1
    symbol[seen] = np.arange(2, len(seen) + 2)
    letters = len(seen) + 2
    counted = {}  # (language, length) -> contexts with their symbol counts
    for which, language in enumerate(languages):
        for length in range(ORDER + 1):
            total = {"keys": np.zeros(0, np.int64), "counts": np.zeros(0, np.int64)}
            parts = [_keys(symbol[np.frombuffer(t, np.uint8)], length + 1, letters) for t in samples[language] if t]
            if parts:
                total["keys"], total["counts"] = np.unique(np.concatenate(parts), return_counts=True)
            counted[which, length] = total
    # contexts that any language knows, the shorter first; each is a row of ``letters`` symbols
    known = [np.zeros(1, np.int64)]
    for length in range(1, ORDER + 1):
        keys = np.concatenate([counted[w, length]["keys"] // letters for w in range(len(languages))] or [known[0][:0]])
        known.append(np.unique(keys))
    starts = np.concatenate([[0], np.cumsum([len(k) for k in known])])
    cost = np.zeros((int(starts[-1]), letters, len(languages)), np.float32)
    for which in range(len(languages)):
        shorter = np.full((1, letters), 8.0)  # below the empty context: one of 256
        for length in range(ORDER + 1):
            contexts = known[length]
            if length == 0:
                base = shorter
            else:
                # a context without its oldest symbol; every such suffix is known too
                suffix = contexts % (letters ** (length - 1)) if length > 1 else np.zeros(len(contexts), np.int64)
                at = np.minimum(np.searchsorted(known[length - 1], suffix), len(known[length - 1]) - 1)
                base = shorter[at]
            keys, counts = counted[which, length]["keys"], counted[which, length]["counts"]
            row = np.searchsorted(contexts, keys // letters)
            total = np.bincount(row, weights=counts, minlength=len(contexts))
            kinds = np.bincount(row, minlength=len(contexts))
            escape = np.where(kinds > 0, np.log2(np.maximum(total + kinds, 1) / np.maximum(kinds, 1)), 0.0)
            bits = base + escape[:, None]
            bits[row, keys % letters] = np.log2((total + kinds)[row] / counts)
            cost[starts[length] : starts[length + 1], :, which] = bits
            shorter = bits
    node = np.zeros(letters**ORDER, np.int32)
    every = np.arange(letters**ORDER)
    for length in range(1, ORDER + 1):
        ending = every % (letters**length)
        at = np.minimum(np.searchsorted(known[length], ending), max(len(known[length]) - 1, 0))
        if len(known[length]):
            node = np.where(known[length][at] == ending, starts[length] + at, node)
    flat = cost.reshape(cost.shape[0] * letters, len(languages))
    return Trees(languages, symbol, node.astype(np.int32), flat)


def code_lengths(trees: Trees, texts: list[bytes]) -> np.ndarray:
    """texts x languages: bits that each language's tree needs for the whole text."""
    letters, out = trees.letters, np.zeros((len(texts), len(trees.languages)))
    for start, end in slices(texts):
        part = texts[start:end]
        sizes = np.array([len(t) for t in part])
        if not sizes.sum():
            continue
        # ORDER blanks before each text, so that no context reaches into the text before
        joined = np.frombuffer((b"\0" * ORDER).join([b"", *part]), np.uint8)
        symbols = trees.symbol[joined].astype(np.int32)
        firsts = np.cumsum(sizes + ORDER) - sizes
        for f in range(ORDER):
            symbols[firsts - 1 - f] = 0
        context = symbols[:-ORDER].copy()
        for back in range(1, ORDER):
            context *= letters
            context += symbols[back : len(symbols) - ORDER + back]
        rows = trees.node[context].astype(np.int64) * letters + symbols[ORDER:]
        whole = np.flatnonzero(sizes > 0)
        ends = firsts + sizes - ORDER
        bits = np.empty((len(whole), out.shape[1]))
        for which in range(out.shape[1]):
            flow = np.concatenate([[0.0], np.cumsum(trees.cost[rows, which], dtype=np.float64)])
            bits[:, which] = flow[ends[whole]] - flow[firsts[whole] - ORDER]
        out[start + whole] = bits
    return out


def predict(trees: Trees, texts: list[bytes]) -> tuple[list[str], list[float]]:
    """The language with the shortest code and its share of all languages' probabilities."""
    if not trees.languages:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    bits = code_lengths(trees, texts)
    best = bits.argmin(axis=1)
    weight = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000))
    share = 1 / weight.sum(axis=1)
    lettered = [_LETTER.search(t.decode()) is not None for t in texts]
    names = [trees.languages[b] if has else UNKNOWN for b, has in zip(best, lettered, strict=True)]
    return names, [float(s) if has else 0.0 for s, has in zip(share, lettered, strict=True)]


PREDICTED = T.StructType([T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False)])


def identify(docs: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1).

    Only the text goes in, whole. Null, empty and letterless texts are ``und`` with
    score 0, as is everything if nothing was learned; ties go to the first language by
    name; repeated rows get equal answers; columns of these names are replaced; an
    empty table stays empty. The trees are of bounded size: they come from a bounded
    sample.
    """

    def make() -> Callable[[list[bytes]], list[list]]:
        return lambda texts: list(predict(trees, texts))

    return with_columns(docs, text, PREDICTED, make)


def labelled_sample(
    docs: DataFrame,
    usable: Column,
    rows: int = ROWS_PER_LANGUAGE,
    longest: int = LONGEST,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> dict[str, list[bytes]]:
    """At most ``rows`` whole texts of each language, in the order of a hash of the key.

    The keys are chosen first, from the small columns; their bounded list then selects
    the texts. Texts over ``longest`` bytes are not learned from.
    """
    known = docs.select(key, lang).where(F.col(lang).isNotNull() & F.col(key).isNotNull() & usable)
    hashed = known.withColumn("__hash", F.xxhash64(key))
    # first in parts of a language, then of what is left of them, so that no language meets in one task
    for parts in ([lang, F.pmod("__hash", F.lit(64))], [lang]):
        place = F.row_number().over(Window.partitionBy(*parts).orderBy("__hash", key))
        hashed = hashed.withColumn("__n", place).where(F.col("__n") <= rows).drop("__n")
    chosen = hashed.select(key).collect()
    if not chosen:
        return {}
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    picked = spark.createDataFrame([(k,) for k in sorted({r[0] for r in chosen})], f"__key {kind}")
    read = docs.where(F.octet_length(text).between(1, longest) & F.col(lang).isNotNull())
    found = read.join(F.broadcast(picked), F.col(key) == F.col("__key")).select("__key", lang, text)
    samples: dict[str, list[bytes]] = {}
    for r in sorted(found.toArrow().to_pylist(), key=lambda r: (str(r["__key"]), r[lang], r[text])):
        samples.setdefault(r[lang], []).append(r[text].encode())
    return samples


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the key modulo 4 is 2. False without a key."""
    return F.coalesce(crc_mod(F.col(key), 4) == 2, F.lit(False))


def train(docs: DataFrame) -> Trees:
    return grow(labelled_sample(docs, crc_mod(F.col("doc_id"), 4) != 2))
