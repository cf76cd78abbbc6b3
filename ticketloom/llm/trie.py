"""Prefix trie of conversations: double arrays per prefix shard, shared upper nodes merged globally."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.common import n_words
from ticketloom.llm.components import Stash

#: Conversations of a family share the first turns of its first; so many may be shared at most.
FAMILY, HEADS = 20, 3
#: Turns of a shard, on average; a prefix with more turns below it, of several sequences, is shared by shards.
SHARD, HEAVY = 1 << 16, 1 << 12
#: Numbers of conversations whose ids are written together, and neighbouring turns placed together.
ID_RUN, TURN_RUN = 4096, 4096
#: Free places that are tried at a time for a node's children.
TRIED = 2048

NOTHING = hashlib.sha256(b"").hexdigest()


# --- the double array ------------------------------------------------------------------------------


@dataclass
class DoubleArray:
    """A trie in two arrays: the child of state s by turn t is base[s] + t if check of that place is s."""

    base: np.ndarray
    check: np.ndarray  # -1: free; the root, state 0, is its own parent

    def step(self, states: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """The children of states; -1 where there is none."""
        place = self.base[states] + turns
        inside = (place > 0) & (place < len(self.check))
        at = np.where(inside, place, 0)
        return np.where(inside & (self.check[at] == states), at, -1)


class _Builder:
    def __init__(self, room: int) -> None:
        self.base = np.zeros(room, np.int64)
        self.check = np.full(room, -1, np.int64)
        self.check[0] = 0
        self.low = 1  # below it no place is free

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            room = max(size, len(self.check) * 3 // 2)
            self.base = np.concatenate([self.base, np.zeros(room - len(self.base), np.int64)])
            self.check = np.concatenate([self.check, np.full(room - len(self.check), -1, np.int64)])

    def _free(self, start: int, count: int) -> np.ndarray:
        """The first free places from ``start`` on, ``count`` or those in the next stretch."""
        stop = min(len(self.check), start + 4 * count)
        return np.flatnonzero(self.check[start:stop] < 0)[:count] + start

    def single(self, parents: np.ndarray, turns: np.ndarray) -> np.ndarray:
        """One child for each parent, in the lowest free places."""
        self._grow(self.low + len(parents))
        free = np.flatnonzero(self.check[self.low :] < 0) + self.low
        if len(free) < len(parents):
            old = len(self.check)
            self._grow(old + len(parents) - len(free))
            free = np.concatenate([free, np.arange(old, len(self.check))])
        places = free[: len(parents)]
        self.base[parents] = places - turns
        self.check[places] = parents
        if len(places):
            self.low = int(places[-1]) + 1
        return places

    def several(self, parent: int, turns: np.ndarray) -> np.ndarray:
        """All children of one parent: the first base at which every child finds its place free."""
        offsets = turns - turns[0]
        at = self.low
        while True:
            if at >= len(self.check):
                self._grow(at + int(offsets[-1]) + 1)
            free = self._free(at, TRIED)
            self._grow((int(free[-1]) if len(free) else at) + int(offsets[-1]) + 1)
            fits = (self.check[free[:, None] + offsets[None, :64]] < 0).all(axis=1) if len(free) else np.zeros(0, bool)
            for first in free[fits].tolist():
                places = first + offsets
                if (self.check[places] < 0).all():
                    self.base[parent] = first - turns[0]
                    self.check[places] = parent
                    return places
            at = int(free[-1]) + 1 if len(free) == TRIED else min(len(self.check), at + 4 * TRIED)


def build(sequences: list[np.ndarray]) -> DoubleArray:
    """The trie of sequences of small numbers, made level by level."""
    builder = _Builder(max(16, 2 * sum(len(s) for s in sequences)))
    lengths = np.array([len(s) for s in sequences], np.int64)
    flat = np.concatenate(sequences) if len(sequences) else np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
    state = np.zeros(len(sequences), np.int64)
    alive = np.flatnonzero(lengths > 0)
    depth = 0
    while len(alive):
        turns = flat[starts[alive] + depth]
        order = np.lexsort((turns, state[alive]))
        parents, turns_ = state[alive][order], turns[order]
        new = np.concatenate([[True], (parents[1:] != parents[:-1]) | (turns_[1:] != turns_[:-1])])
        child = np.cumsum(new) - 1
        own, step = parents[new], turns_[new]
        cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        sizes = np.diff(np.concatenate([cuts, [len(own)]]))
        places = np.empty(len(own), np.int64)
        for group in np.flatnonzero(sizes > 1)[np.argsort(-sizes[sizes > 1], kind="stable")].tolist():
            a, b = cuts[group], cuts[group] + sizes[group]
            places[a:b] = builder.several(int(own[a]), step[a:b])
        alone = cuts[sizes == 1]
        places[alone] = builder.single(own[alone], step[alone])
        state[alive[order]] = places[child]
        depth += 1
        alive = alive[lengths[alive] > depth]
    return DoubleArray(builder.base, builder.check)


# --- one shard -------------------------------------------------------------------------------------

NODE = (
    "upper boolean, p1 long, p2 long, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)


def _shard_nodes(rows: pa.Table, root: int) -> pa.Table:
    """The nodes of one shard's sequences; what an upper node has in this shard only is added up later."""
    column = {n: rows[n].to_numpy() for n in ("rep", "pos", "f1", "f2", "p1", "p2", "words", "n", "len")}
    first = np.flatnonzero(column["pos"] == 0)
    ends = np.array(rows["ends"].take(pa.array(first)).to_pylist(), dtype=object)
    lengths, reps, counts = column["len"][first], column["rep"][first], column["n"][first]
    heavy = rows["heavy_min"]
    is_heavy = heavy.is_valid().to_numpy(zero_copy_only=False)
    heavy_min = heavy.fill_null(0).to_numpy()
    # dense ids of turns, numbered as they come, so that a node's children lie near each other
    pairs = np.stack([column["f1"], column["f2"]], axis=1)
    _, seen, inverse = np.unique(pairs, axis=0, return_index=True, return_inverse=True)
    dense = np.empty(len(seen), np.int64)
    dense[np.argsort(seen, kind="stable")] = np.arange(len(seen))
    turns = dense[inverse.ravel()]
    array = build([turns[a : a + size] for a, size in zip(first.tolist(), lengths.tolist(), strict=True)])

    room = len(array.check)
    n_convs, least = np.zeros(room, np.int64), np.full(room, np.iinfo(np.int64).max)
    words, depths, row = np.zeros(room, np.int64), np.full(room, -1, np.int64), np.full(room, -1, np.int64)
    upper, owner, last = np.zeros(room, bool), np.zeros(room, bool), np.full(room, -1, np.int64)
    n_convs[0], least[0], depths[0], upper[0] = counts.sum(), root, 0, True
    state, alive, levels = np.zeros(len(first), np.int64), np.arange(len(first)), [np.zeros(1, np.int64)]
    depth = 0
    while len(alive):
        at = first[alive] + depth
        state[alive] = here = array.step(state[alive], turns[at])
        np.add.at(n_convs, here, counts[alive])
        np.minimum.at(least, here, np.where(is_heavy[at], heavy_min[at], reps[alive]))
        words[here], row[here], upper[here] = column["words"][at], at, is_heavy[at]
        # of all sequences below an upper node, in whatever shard, one has the node's least conversation
        owner[here[is_heavy[at] & (heavy_min[at] == reps[alive])]] = True
        depth += 1
        levels.append(np.unique(here))
        depths[levels[-1]] = depth
        done = lengths[alive] == depth
        last[here[done]] = alive[done]
        alive = alive[~done]

    parent = array.check
    n_children, n_leaves = np.zeros(room, np.int64), np.zeros(room, np.int64)
    saved = np.where(upper, n_convs - owner, n_convs - 1) * words
    for states in reversed(levels[1:]):
        n_leaves[states[~upper[states] & (n_children[states] == 0)]] = 1
        np.add.at(n_children, parent[states], np.where(upper[states], owner[states], True).astype(np.int64))
        np.add.at(n_leaves, parent[states], n_leaves[states])
        np.add.at(saved, parent[states], saved[states])

    states = np.concatenate(levels)
    at = np.maximum(row[states], 0)
    deep = depths[states] > 0
    finals = last[states]
    told = [ends[f] if f >= 0 else None for f in finals.tolist()]
    return pa.table(
        {
            "upper": upper[states],
            "p1": np.where(deep, column["p1"][at], 0),
            "p2": np.where(deep, column["p2"][at], 0),
            "depth": depths[states],
            "conv_id": least[states],
            "parent_conv_id": pa.array(least[parent[states]], mask=~deep),
            "n_convs": n_convs[states],
            "n_children": n_children[states],
            "n_leaves": n_leaves[states],
            "saved_tokens": saved[states],
            "ends_sha256": pa.array(told, pa.string()),
        }
    )


def _nodes(batches: Iterator[pa.RecordBatch], root: int) -> Iterator[pa.RecordBatch]:
    """Rows in the order of shard, rep and pos -> NODE."""
    held: list[pa.RecordBatch] = []
    place: int | None = None
    for batch in batches:
        shard = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if start == end:
                continue
            if shard[start] != place:
                if held:
                    yield from _shard_nodes(pa.Table.from_batches(held), root).to_batches(max_chunksize=10_000)
                held, place = [], shard[start]
            held.append(batch.slice(start, end - start))
    if held:
        yield from _shard_nodes(pa.Table.from_batches(held), root).to_batches(max_chunksize=10_000)


# --- sequences -------------------------------------------------------------------------------------


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, f1, f2, words): the turns in order, each with two 64-bit hashes of role and text.

    Turns are placed within runs of neighbouring turn numbers, and a run begins where the counts
    of the runs before it end, so a conversation of any length need not meet in one task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        # turns of one number: by role, then by the beginning of the text, then by its hash
        F.left(text, F.lit(32)).alias("begins"),
        F.xxhash64(F.lit(1), role, text).alias("f1"),
        F.xxhash64(F.lit(2), role, text).alias("f2"),
        n_words(text).alias("words"),
    )
    rows = rows.withColumn("run", F.floor(F.col("turn") / F.lit(TURN_RUN)))
    before = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("run")).rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("conv_id", "run").agg(F.count(F.lit(1)).alias("__n"))
    runs = runs.select("conv_id", "run", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("before"))
    later = runs.where("before > 0").select(F.col("conv_id").alias("__c"), F.col("run").alias("__r"), "before")
    order = Window.partitionBy("conv_id", "run").orderBy(F.asc_nulls_first("turn"), "role", "begins", "f1", "f2")
    placed = rows.withColumn("pos", F.row_number().over(order) - 1)
    placed = placed.join(later, (F.col("conv_id") == F.col("__c")) & F.col("run").eqNullSafe(F.col("__r")), "left")
    pos = (F.col("pos") + F.coalesce("before", F.lit(0))).cast("long")
    return placed.select("conv_id", pos.alias("pos"), "f1", "f2", "words")


def shared_heads(conv_id: Column, heads: int = HEADS) -> Column:
    """How many first turns a conversation takes from the first of its family."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(heads + 1)).cast("long")


def rebuilt(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """``turns`` (see ``numbered``) with the first turns of each conversation from the first of its family.

    A conversation c takes the first ``shared_heads`` turns of c - c % ``family`` (all if it has
    fewer, none if it is absent), and then its own turns after as many. One row with pos -1
    per conversation stands for its root, so that one without turns is not lost.
    """
    base = F.col("conv_id") - F.col("conv_id") % F.lit(family)
    convs = turns.select("conv_id").distinct().select("conv_id", base.alias("base"), shared_heads(F.col("conv_id"), heads).alias("h"))
    given = turns.where((base == F.col("conv_id")) & (F.col("pos") < heads))
    taken = given.withColumnRenamed("conv_id", "base").join(convs, "base").where(F.col("pos") < F.col("h"))
    bases = given.groupBy("conv_id").agg(F.count(F.lit(1)).alias("has")).withColumnRenamed("conv_id", "base")
    h = shared_heads(F.col("conv_id"), heads)
    own = turns.where(F.col("pos") >= h).withColumn("base", base).join(bases, "base", "left")
    moved = F.col("pos") - h + F.least(h, F.coalesce("has", F.lit(0)))
    names = ("conv_id", "pos", "f1", "f2", "words")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", F.lit(-1).cast("long"), zero, zero, zero).toDF(*names)
    return taken.select(*names).unionByName(own.withColumn("pos", moved).select(*names)).unionByName(roots)


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (p1, p2, len, run, ids, n, least) in that order -> one per sequence, with the digest of its ids."""
    place: tuple | None = None
    digest, total, least = hashlib.sha256(), 0, 0
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    names = ("p1", "p2", "len", "rep", "n", "ends")

    for batch in batches:
        done = []
        for p1, p2, size, _, ids, n, low in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if (p1, p2, size) != place:
                if place is not None:
                    done.append((*place, least, total, digest.hexdigest()))
                place, digest, total, least = (p1, p2, size), hashlib.sha256(ids.encode()), n, low
            else:
                digest.update(b"," + ids.encode())
                total += n
        if done:
            values = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(values, kinds, strict=True)], names=names)
    if place is not None:
        values = (*place, least, total, digest.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)


def sequences(turns: DataFrame) -> DataFrame:
    """(p1, p2, len, rep, n, ends): each distinct sequence once.

    ``rep`` is its least conversation, ``n`` their number, ``ends`` the digest of their ids, ascending and
    joined by commas. Ids are written in runs of at most ID_RUN first, so a task holds one
    run, however often a sequence occurs.
    """
    turned = F.col("pos") >= 0
    hashed = [
        F.bit_xor(F.when(turned, F.xxhash64(F.lit(3 + i), "pos", "f1", "f2")).otherwise(F.lit(0))).alias(f"p{i}") for i in (1, 2)
    ]
    whole = turns.groupBy("conv_id").agg(*hashed, F.count_if(turned).alias("len"))
    run = F.floor(F.col("conv_id") / F.lit(ID_RUN)).alias("run")
    written = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    runs = whole.groupBy("p1", "p2", "len", run).agg(
        written.alias("ids"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")
    )
    ordered = runs.repartition("p1", "p2", "len").sortWithinPartitions("p1", "p2", "len", "run")
    return ordered.mapInArrow(_ended, "p1 long, p2 long, len long, rep long, n long, ends string")


def prefix_trie(turns: DataFrame, shard: int = SHARD, heavy: int = HEAVY) -> DataFrame:
    """One row per node of the trie of all conversations (``turns`` as of ``rebuilt``).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    1. Equal conversations are one sequence with a count. A prefix is known by two 64-bit
       numbers that combine the hashes of its places and turns.
    2. A prefix is an upper node if several sequences with more than ``heavy`` turns in all
       lie below it; the root always is. Sequences are dealt by their first prefix that
       is not, so all that lies below such a prefix is in one shard of ``shard`` turns on average.
    3. A shard packs its sequences into a double array over dense turn ids and walks it for
       the nodes. Nodes below the upper ones are complete there.
    4. What a shard knows of an upper node adds up: members, leaves, and saved tokens as
       tokens of all members less those of each node once, which for an upper node the shard with
       its least conversation subtracts. One aggregate merges them.
    """
    spark = turns.sparkSession
    stash = Stash(spark)
    turns = stash.put(turns, "turns")
    classes = stash.put(sequences(turns), "sequences")
    root = classes.agg(F.min("rep").alias("least")).first()["least"]
    whole = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    names = ("conv_id", "depth", "parent_conv_id", *whole)
    if root is None:
        return spark.createDataFrame([], NODE).select(*names, "ends_sha256")
    mine = turns.where("pos >= 0").join(classes.select(F.col("rep").alias("conv_id"), "len", "n", "ends"), "conv_id")
    so_far = Window.partitionBy("conv_id").orderBy("pos")
    prefix = [F.bit_xor(F.xxhash64(F.lit(3 + i), "pos", "f1", "f2")).over(so_far).alias(f"p{i}") for i in (1, 2)]
    paths = mine.select(F.col("conv_id").alias("rep"), "pos", "f1", "f2", "words", "n", "len", "ends", *prefix)
    paths = stash.put(paths, "paths")
    below = paths.groupBy("pos", "p1", "p2").agg(
        F.count(F.lit(1)).alias("k"), F.sum(F.col("len") - F.col("pos")).alias("t"), F.min("rep").alias("heavy_min")
    )
    uppers = stash.put(below.where((F.col("k") > 1) & (F.col("t") > heavy)).select("pos", "p1", "p2", "heavy_min"), "uppers")
    marked = paths.join(uppers, ["pos", "p1", "p2"], "left")
    # upper nodes are the first ones of a path, so their number is the place of the first that is not
    cut = marked.groupBy("rep").agg(F.count("heavy_min").alias("cut"))
    cuts = marked.join(cut, "rep").where(F.col("pos") == F.least(F.col("cut"), F.col("len") - 1))
    shards = max(1, -(-paths.count() // shard))
    dealt = cuts.select("rep", F.pmod(F.xxhash64("p1", "p2"), F.lit(shards)).cast("int").alias("shard"))
    placed = marked.join(dealt, "rep").select(
        "shard", "rep", "pos", "f1", "f2", "p1", "p2", "words", "n", "len", "ends", "heavy_min"
    )
    together = placed.repartition("shard").sortWithinPartitions("shard", "rep", "pos")
    nodes = stash.put(together.mapInArrow(lambda batches: _nodes(batches, root), NODE), "nodes")

    none = classes.where("len = 0").select(
        F.lit(True).alias("upper"),
        "p1",
        "p2",
        F.lit(0).cast("long").alias("depth"),
        F.col("rep").alias("conv_id"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        *[F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")],
        F.col("ends").alias("ends_sha256"),
    )
    merged = nodes.where("upper").unionByName(none).groupBy("depth", "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"),
        F.min("parent_conv_id").alias("parent_conv_id"),
        *[F.sum(c).alias(c) for c in whole],
        F.max("ends_sha256").alias("ends_sha256"),
    )
    # a root without turns below it is itself a leaf
    leaves = F.when((F.col("depth") == 0) & (F.col("n_children") == 0), F.lit(1).cast("long")).otherwise(F.col("n_leaves"))
    ends = F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")
    return (
        merged.withColumn("n_leaves", leaves)
        .select(*names, ends)
        .unionByName(nodes.where(~F.col("upper")).select(*names, ends))
    )


def conversation_trie(conversations: DataFrame, shard: int = SHARD, heavy: int = HEAVY) -> DataFrame:
    """The prefix trie of rebuilt conversations (conv_id, turn, role, text); see ``rebuilt`` and ``prefix_trie``.

    Turns are taken in order of ``turn``, null first; turns of one number in the order of
    role, the first 32 characters of the text and its hash, so repeated rows stay, one after the
    other. Null role or text is empty. Rows without a conversation take no part. An empty table has
    no nodes; other columns are not read.
    """
    turns = Stash(conversations.sparkSession).put(numbered(conversations), "numbered")
    return prefix_trie(rebuilt(turns), shard, heavy)
