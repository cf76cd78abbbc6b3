"""BPE encoding and decoding with a tokenization automaton compiled from the merges."""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ticketloom.llm.common import with_columns

#: Fixed values of this kind of vocabulary: how texts are split, and the mark of a word's end.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"

#: Bytes that a generation of a task's cache holds, what an entry takes besides its key and value, and the
#: longest key that is kept. Only a cache: what is not in it is encoded anew.
CACHED_BYTES, ENTRY, CACHED_RUN = 16 << 20, 160, 256
#: Entries of the transition table that a task holds before it begins to fill it anew.
CACHED_ARCS = 125_000


def byte_signs() -> dict[int, str]:
    """The printable sign by which byte-level vocabularies write each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {b: chr(b) for b in printable}
    for i, b in enumerate(b for b in range(256) if b not in signs):
        signs[b] = chr(256 + i)
    return signs


@dataclass(frozen=True)
class Vocabulary:
    """What is sent to the tasks: a fixed file's symbols, merges and special strings."""

    name: str  # sha256 of the file
    labels: tuple[str, ...]  # of each id, in the signs of the file
    symbols: dict[tuple[int, bool], int]  # (byte, at the end of a word) -> id
    merges: tuple[tuple[int, int, int], ...]  # left, right, merged, by rank
    special: dict[str, int]

    @staticmethod
    def read(path: str) -> Vocabulary:
        with open(path, "rb") as file:
            raw = file.read()
        data = json.loads(raw)
        model = data["model"]
        ids = dict(model["vocab"])
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        ids.update(special)
        labels = [""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            labels[i] = token
        symbols = {
            (byte, end): ids[sign + END * end]
            for byte, sign in byte_signs().items()
            for end in (False, True)
            if sign + END * end in ids
        }
        merges = []
        for pair in model["merges"]:
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            merges.append((ids[left], ids[right], ids[left + right]))
        return Vocabulary(hashlib.sha256(raw).hexdigest(), tuple(labels), symbols, tuple(merges), special)


class TokenAutomaton:
    """The deterministic automaton that accepts exactly the tokenizations BPE makes.

    It begins as one state with a loop for every base symbol. A merge (a, b) -> ab is
    built in as a gadget: every arc ``a`` is led to a copy of its target that lacks
    the arc ``b``, and every state with an arc ``a`` gets an arc ``ab`` to where b led
    from there. So after n merges there is one state for each last token, and two
    tokens may follow each other only if no earlier merge would have joined parts of
    them.

    States share most arcs, and a table of all of them would hold |V| x |V| entries.
    So a gadget is recorded once, as the arc it takes away and the rank at which it
    does, and the copy a state was made from is recorded with the state (``origin``:
    state ``ab`` begins as state ``b`` stood at that rank). An arc's presence follows
    from these two tables, and is kept once worked out: ``arcs`` is the transition
    table, filled where texts lead.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.count = count = max([-1, *vocabulary.symbols.values(), *(m for _, _, m in vocabulary.merges)]) + 1
        self.never = len(vocabulary.merges)
        self.taken: dict[tuple[int, int], int] = {}  # (state, arc) -> rank at which the gadget removes the arc
        self.born = [-1] * count  # rank at which an arc and its state appear; -1: from the beginning
        self.origin = [-1] * count  # the state that a state was copied from: its token's right part
        self.stem = [-1] * count  # the arc that a new arc runs beside: its token's left part
        self.trie: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        self.arcs: dict[int, bool] = {}  # state * count + arc: whether it is there
        spelled: dict[int, tuple[int, ...]] = {}
        for (byte, end), i in vocabulary.symbols.items():
            spelled[i] = (byte + 256 * end,)
        for rank, (left, right, merged) in enumerate(vocabulary.merges):
            if merged in spelled:
                raise ValueError(f"token {merged} is made by two merges")
            # a merge whose parts can no longer meet makes no arc
            if left in spelled and right in spelled and self._present(left, right, rank):
                self._gadget(rank, left, right, merged)
                spelled[merged] = spelled[left] + spelled[right]
        for token, path in spelled.items():
            self._add_label(token, path)

    def _gadget(self, rank: int, left: int, right: int, merged: int) -> None:
        self.taken[left, right] = rank
        self.born[merged], self.origin[merged], self.stem[merged] = rank, right, left

    def _add_label(self, token: int, path: tuple[int, ...]) -> None:
        node = 0
        for symbol in path:
            following = self.trie[node].get(symbol)
            if following is None:
                following = self.trie[node][symbol] = len(self.trie)
                self.trie.append({})
                self.token_at.append(-1)
            node = following
        self.token_at[node] = token

    def has_arc(self, state: int, arc: int) -> bool:
        """Whether the finished automaton has the arc: the table, filled on demand."""
        known = self.arcs.get(state * self.count + arc)
        if known is None:
            if len(self.arcs) >= CACHED_ARCS:
                self.arcs.clear()
            known = self.arcs[state * self.count + arc] = self._present(state, arc, self.never)
        return known

    def _present(self, state: int, arc: int, rank: int) -> bool:
        """Whether the state had the arc just before the gadget of this rank."""
        while True:
            if self.taken.get((state, arc), self.never) < rank:
                return False
            made_state, made_arc = self.born[state], self.born[arc]
            if made_state < 0 and made_arc < 0:
                return True
            # the younger of the two was made last: go back to what it was made from
            if made_state > made_arc:
                rank, state = made_state, self.origin[state]  # a copy of how that state stood before
            else:
                rank, arc = made_arc + 1, self.stem[arc]  # beside an arc that the same gadget left in place

    def encode(self, word: bytes) -> list[int]:
        """The one path through the automaton whose labels spell the word.

        Long arcs are tried first. The automaton is deterministic and has one path for
        each string, so a place in the word that was reached once and led nowhere is
        never tried again: the search is linear in the places.
        """
        symbols = [*word[:-1], word[-1] + 256]
        size, state, at = len(symbols), -1, 0
        trie, token_at, arcs, count = self.trie, self.token_at, self.arcs, self.count
        path: list[int] = []
        seen = set()
        waiting: list[list[int]] = []  # of each place on the path, the labels not tried yet: end, token, ...
        while True:
            node, options = 0, []
            for j in range(at, size):
                node = trie[node].get(symbols[j])
                if node is None:
                    break
                token = token_at[node]
                if token >= 0:
                    options += (j + 1, token)
            while True:
                while options:
                    token, end = options.pop(), options.pop()
                    if end in seen:
                        continue
                    if state >= 0:
                        follows = arcs.get(state * count + token)
                        if not (self.has_arc(state, token) if follows is None else follows):
                            continue
                    break
                else:
                    if not waiting:
                        raise ValueError("a symbol of the word is not in the vocabulary")
                    options = waiting.pop()
                    path.pop()
                    state = path[-1] if path else -1
                    continue
                break
            path.append(token)
            if end == size:
                return path
            seen.add(end)
            waiting.append(options)
            state, at = token, end


class Cache:
    """Two generations of a dictionary, each of ``limit`` bytes: what was not asked for since the last change is forgotten."""

    def __init__(self, limit: int) -> None:
        self.limit, self.held, self.young, self.old = limit, 0, {}, {}

    def get(self, key: bytes) -> bytes | None:
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key: bytes, value: bytes) -> None:
        if len(key) > CACHED_RUN:
            return
        size = len(key) + len(value) + ENTRY
        if self.held + size > self.limit:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[key] = value
        self.held += size


class Tokenizer:
    """Texts to ids and back. Words and marks between white space are encoded once and kept."""

    def __init__(self, vocabulary: Vocabulary, cached: int = CACHED_BYTES) -> None:
        self.vocabulary = vocabulary
        self.automaton = TokenAutomaton(vocabulary)
        self.split = regex.compile(PATTERN)
        self.special = (
            regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")") if vocabulary.special else None
        )
        self.words = Cache(cached)
        self.chunks = Cache(cached)

    def _word(self, word: bytes) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            path = self.automaton.encode(word)
            ids = struct.pack(f"<{len(path)}I", *path)
            self.words.put(word, ids)
        return ids

    def _plain_text(self, text: str) -> bytes:
        if not text.isascii():
            # case is mapped sign by sign, so a final sigma has no form of its own
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return b"".join([self._word(word.encode()) for word in self.split.findall(text.lower())])

    def _chunk(self, chunk: bytes) -> bytes:
        """A run without white space, which may hold special strings."""
        coded = self.chunks.get(chunk)
        if coded is None:
            text, special = chunk.decode(), self.vocabulary.special
            if self.special is not None and self.special.search(text):
                parts = self.special.split(text)
                coded = b"".join([struct.pack("<I", special[p]) if p in special else self._plain_text(p) for p in parts])
            else:
                coded = self._plain_text(text)
            self.chunks.put(chunk, coded)
        return coded

    def encode(self, text: bytes) -> bytes:
        """The ids as little-endian unsigned 32-bit integers.

        No token reaches over white space, and ASCII white space neither composes with
        a neighbour nor changes its case, so what stands between is encoded on its own.
        """
        known, out = self.chunks.young, []
        for chunk in text.split():
            coded = known.get(chunk)
            if coded is None:
                coded = self._chunk(chunk)
                known = self.chunks.young
            out.append(coded)
        return b"".join(out)


def written(labels: tuple[str, ...], ids: bytes) -> str:
    """The text of a path through the automaton: the labels of its arcs with a blank between two.

    The vocabulary file names no decoder, and its library then writes labels so.
    """
    return " ".join([labels[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


TOKENS = T.StructType([T.StructField("tokens", T.BinaryType(), False)])


def encode(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with ``tokens``: the ids of the whole text as little-endian unsigned 32-bit integers.

    ``vocabulary`` is the path of a tokenizer file on the driver; it is of fixed size
    and goes to the tasks with the function. Null and blank texts have no ids, repeated
    rows equal ones, a column named ``tokens`` is replaced, an empty table stays empty.
    """
    known = Vocabulary.read(vocabulary)

    def make() -> Callable[[list[bytes]], list[list]]:
        # of this task only: a Python worker that idles after it holds no caches
        tool = Tokenizer(known)
        return lambda texts: [[tool.encode(t) for t in texts]]

    return with_columns(docs, text, TOKENS, make)


def decode(docs: DataFrame, vocabulary: str, tokens: str = "tokens") -> DataFrame:
    """``docs`` with ``decoded``: the text of the ids; null ids are none. A column of this name is replaced."""
    labels = Vocabulary.read(vocabulary).labels

    def make() -> Callable[[list[bytes]], list[list]]:
        return lambda ids: [[written(labels, i) for i in ids]]

    return with_columns(docs, tokens, T.StructType([T.StructField("decoded", T.StringType(), False)]), make)


CODED = T.StructType([*TOKENS.fields, T.StructField("decoded", T.StringType(), False)])


def encode_and_decode(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with ``tokens`` and ``decoded``, as ``encode`` and then ``decode`` make them, in one Python stage."""
    known = Vocabulary.read(vocabulary)

    def make() -> Callable[[list[bytes]], list[list]]:
        tool = Tokenizer(known)

        def code(texts: list[bytes]) -> list[list]:
            ids = [tool.encode(t) for t in texts]
            return [ids, [written(known.labels, i) for i in ids]]

        return code

    return with_columns(docs, text, CODED, make, frugal=True)
