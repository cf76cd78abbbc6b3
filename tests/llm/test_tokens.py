"""Tokens against the tokenizer libraries, packing by round trip."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from odd_rows import nothing, odd  # noqa: F401

from ticketloom.llm import bpe, packing, queries
from ticketloom.llm.common import table

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tool():
    return bpe.Tokenizer(bpe.Vocabulary.read(PATH))


@pytest.fixture(scope="module")
def library():
    found = Library.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


def test_ids_and_texts_match_the_library(tool, library):
    draw = random.Random(1)
    pool = "abcdefghijklmnopqrstuvwxyz     'ABCÉéñçßŒ0123456789!?.,-_#$%\n\tĳǄΣσς😀👍́ ‍日本語"
    texts = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(draw.choice("aehrtinos") for _ in range(draw.randint(0, 60))) for _ in range(3000)]
    texts += ["", "x<|endoftext|>y <|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "a\x1cb\x85c　d", "ΑΣ İ", "ha" * 500]
    for text in texts:
        ids = tool.encode(text.encode())
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text
        assert bpe.written(tool.vocabulary.labels, ids) == library.decode(expected, skip_special_tokens=False)


def small(merges):
    """A vocabulary of the letters a to c with the merges of a list."""
    symbols = {(ord(c), end): 3 * end + i for end in (False, True) for i, c in enumerate("abc")}
    names = ["a", "b", "c", "a</w>", "b</w>", "c</w>"]
    made = []
    for left, right in merges:
        made.append((names.index(left), names.index(right), len(names)))
        names.append(left + right)
    return bpe.Vocabulary("small", tuple(names), symbols, tuple(made), {})


def brute(vocabulary, word):
    ids = [vocabulary.symbols[b, i == len(word) - 1] for i, b in enumerate(word)]
    while True:
        ranked = [(rank, i, m) for rank, (l, r, m) in enumerate(vocabulary.merges) for i in range(len(ids) - 1) if ids[i : i + 2] == [l, r]]
        if not ranked:
            return ids
        _, i, m = min(ranked)
        ids[i : i + 2] = [m]


@pytest.mark.parametrize("seed", range(40))
def test_automaton_of_random_merges_matches_merging(seed):
    draw = random.Random(seed)
    names, merges = ["a", "b", "c", "a</w>", "b</w>", "c</w>"], []
    for _ in range(14):
        left, right = draw.choice([n for n in names if "<" not in n]), draw.choice(names)
        if left + right not in names:
            merges.append((left, right))
            names.append(left + right)
    vocabulary = small(merges)
    automaton = bpe.TokenAutomaton(vocabulary)
    for _ in range(300):
        word = bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 12)))
        assert automaton.encode(word) == brute(vocabulary, word), (merges, word)


def test_query_matches_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf, "documents").collect()}
    for row in queries.op5(spark, sf).collect():
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_odd_rows(odd, nothing):
    coded = bpe.encode(odd, PATH)
    rows = bpe.decode(coded, PATH).toPandas()
    assert len(rows) == 11 and rows.tokens.notna().all()
    assert (rows[rows.text.fillna("").str.strip() == ""].decoded == "").all()
    assert bpe.encode(nothing, PATH).count() == 0


# --- packing --------------------------------------------------------------------------


def brute_best_fit(sizes, length):
    rows = []
    for place in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [r for r in rows if r[0] >= sizes[place]]
        if fits:
            row = min(fits, key=lambda r: r[0])
            row[0] -= sizes[place]
        else:
            rows.append([length - sizes[place]])
    return sorted(r[0] for r in rows)


@pytest.mark.parametrize("seed", range(30))
def test_packing_is_best_fit_decreasing(seed):
    draw = random.Random(seed)
    length = draw.choice([1, 7, 64, 100])
    sizes = [draw.randint(1, length) for _ in range(draw.randint(0, 80))]
    rows = packing.best_fit_decreasing(sizes, length)
    assert sorted(p for r in rows for p in r) == list(range(len(sizes)))
    assert sorted(length - sum(sizes[p] for p in r) for r in rows) == brute_best_fit(sizes, length)


def unpacked(rows, kind="<u2"):
    """The ids of each document from its packed pieces, and every repeat of it."""
    found = {}
    for row in rows:
        ids, places = np.frombuffer(row["ids"], kind), np.frombuffer(row["positions"], "<u2")
        bounds = row["cu_seqlens"]
        assert bounds[0] == 0 and bounds[-1] == row["n_tokens"] and len(bounds) == row["n_segments"] + 1
        for i, (doc, offset) in enumerate(zip(row["doc_ids"], row["doc_offsets"], strict=True)):
            part = ids[bounds[i] : bounds[i + 1]]
            assert places[bounds[i] : bounds[i + 1]].tolist() == list(range(len(part)))
            found.setdefault(doc, {}).setdefault(offset, []).append(part.tolist())
    return found


def test_packed_documents_come_back_whole(spark, odd, nothing):
    ranks = packing.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoder = packing.ranked_encoder(ranks, public_tokenizers.PATTERN)
    encode = encoder()
    for docs, held in ((table(spark, "/root/testdata/sf0.001", "documents"), 5000), (odd, 1 << 20)):
        found = unpacked(packing.pack(docs, encoder, len(ranks), length=256, held=held).collect())
        expected = {}
        for r in docs.select("doc_id", "text").collect():
            for offset, part in packing.pieces(encode((r["text"] or "").encode()), 256):
                expected.setdefault(r["doc_id"], {}).setdefault(offset, []).append(part.tolist())
        assert {d: {o: sorted(p) for o, p in x.items()} for d, x in found.items()} == {
            d: {o: sorted(p) for o, p in x.items()} for d, x in expected.items()
        }
    assert packing.pack(nothing, encoder, len(ranks)).count() == 0


def test_packing_query_fills_rows(spark):
    rows = queries.op7(spark, "/root/testdata/sf0.001").toPandas()
    assert rows.n_tokens.max() <= packing.LENGTH and rows.n_tokens.sum() / (len(rows) * packing.LENGTH) > 0.95


def test_caches_are_bounded_by_bytes():
    """Runs without white space are not kept; short ones only up to the limit."""
    tool = bpe.Tokenizer(bpe.Vocabulary.read(queries.vocabulary_path()), cached=1 << 16)
    draw = random.Random(8)
    for _ in range(20):
        tool.encode("".join(draw.choice("abcdefgh") for _ in range(20_000)).encode())
    tool.encode(" ".join("".join(draw.choice("abcdefgh") for _ in range(9)) for _ in range(5000)).encode())
    for cache in (tool.words, tool.chunks):
        for part in (cache.young, cache.old):
            assert sum(len(k) + len(v) + bpe.ENTRY for k, v in part.items()) <= 1 << 16
            assert all(len(k) <= bpe.CACHED_RUN for k in part)


def test_one_stage_codes_as_two(spark, odd):
    path = queries.vocabulary_path()
    both = bpe.encode_and_decode(odd, path).select("tokens", "decoded")
    assert both.exceptAll(bpe.decode(bpe.encode(odd, path), path).select("tokens", "decoded")).count() == 0
    assert both.count() == 11


def test_a_cache_holds_the_words_of_a_large_task():
    """A task that forgets words encodes them again and again, and its texts have tens of thousands of different ones."""
    cache = bpe.Cache(bpe.CACHED_BYTES)
    words = [b"word%06d" % i for i in range(90_000)]
    for word in words:
        cache.put(word, b"\0" * 8)
    assert all(cache.get(word) is not None for word in words)
