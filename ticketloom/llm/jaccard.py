"""N-gram Jaccard join: groups of similar sets, a matrix of the groups' tokens that bounds sets against groups, and opened groups."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.common import FEW_ROWS, releasing, small_batches, splitmix, texts_of
from ticketloom.llm.components import Stash, connected_components

#: Words of a shingle, and the least similarity in hundredths.
WORDS, ALIKE = 4, 85
#: Sum of set sizes that a group is meant to have at most; more sets are partitioned into several groups.
BLOCK = 1 << 20
#: A token is common that at least one text of so many has (and COMMON_LEAST texts at all). That bounds
#: their number whatever the number of texts: a text has S tokens on average, so at most S * COMMON are common.
COMMON, COMMON_LEAST = 2000, 16
#: Tokens that a task holds before it counts them.
COUNTED = 1 << 22
#: Of so many parts one more is signed than the least, so that alike sets share that many signatures more.
SIGNED_MORE = 32
#: Times that groups larger than a block are signed anew, with parts dealt otherwise.
SIGNED_ANEW = 3
#: Rows of at most four numbers that may be broadcast (32 MB); more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000

_PART = np.uint64(0xD6E8FEB86659FD93)
_SLICE = np.uint64(0xA0761D6478BD642F)
_SKETCH = np.uint64(0x9FB21C651E98DF25)


def _salt(*numbers: int) -> np.uint64:
    """One number from several."""
    out = np.zeros(1, np.uint64)
    for n in numbers:
        out = splitmix(out ^ np.uint64(n))
    return out[0]


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """Distinct shingles of the text as 64-bit hashes in order; of fewer words, the whole sequence as one."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    size = min(words, len(parts))
    out = np.full(len(parts) - size + 1, size, np.uint64)
    for i in range(size):
        out = splitmix(out ^ hashed[i : len(parts) - size + 1 + i])
    return np.unique(out)


def set_key(tokens: np.ndarray) -> int:
    """One signed 64-bit number for a whole set."""
    total = np.add.reduce(splitmix(tokens)) ^ np.uint64(len(tokens))
    return int(splitmix(np.array([total], np.uint64)).view(np.int64)[0])


def sketch(tokens: np.ndarray) -> int:
    """The least token in an order by hashes: the more alike two sets are, the likelier they have the same."""
    return int(splitmix(tokens ^ _SKETCH).min().view(np.int64))


@lru_cache(maxsize=None)
def most_apart(size: int, alike: int = ALIKE) -> int:
    """How many tokens a set of this size and any set alike enough may not share, at most."""
    most = 0
    for other in range(-(-size * alike // 100), size * 100 // alike + 1):
        both = size + other
        shared = -(-alike * both // (100 + alike))
        most = max(most, both - 2 * shared)
    return most


@lru_cache(maxsize=None)
def bands(alike: int = ALIKE, top: int = 1 << 40) -> tuple[tuple[int, int], ...]:
    """(least size, number of parts) of each band of set sizes; smaller sets are alike only if equal."""
    least = next(n for n in range(1, 1000) if most_apart(n, alike) > 0)
    step, found = max(1.6, 100 / alike + 0.1), []
    while least < top:
        following = max(least + 2, int(np.ceil(least * step)))
        apart = (following - 1) * 2 * (100 - alike) // (100 + alike) * 100 // alike + 2
        if following < 4096:
            apart = max(most_apart(n, alike) for n in range(least, following))
        # a quarter more than may differ, so that even the largest sets have enough filled parts
        found.append((least, (apart + 1) * 5 // 4 + 1))
        least = following
    return tuple(found)


def _emit(
    tokens: np.ndarray, common: np.ndarray, parts: int, apart: int, more: int, salt: np.uint64, depth: int, out: list[np.ndarray]
) -> int:
    """Signatures of the parts of a set, enough of them that an alike set must share one; how many it shares at least.

    Tokens fall into parts by a hash. Two alike sets differ in ``apart`` parts at most,
    so of any ``apart`` + 1 parts of a set one is equal in an alike set. Those are taken
    that have a token which is not common, in the order of the parts: a part of common
    tokens alone says little, since a passage that many texts share makes such parts.

    ``more`` parts are taken besides, if there are as many. The n-th equal one of these parts has at most
    ``apart`` unequal ones before it in either set, so both sets take the first ``more`` + 1 equal ones.

    If a set has too few of them, all its filled parts are signed; and if even these are
    too few, the equal parts may all be empty, so the set is also cut anew for every
    empty part. An alike set that has enough finds its equal part among all of these; one
    that has too few does the same and shares a filled part or an empty one.
    """
    part = ((splitmix(tokens ^ salt) >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    filled, starts = np.unique(part[order], return_index=True)
    sums = np.add.reduceat(splitmix(tokens[order] + salt), starts)
    signs = splitmix(sums + filled.astype(np.uint64) * _PART + salt)
    telling = np.logical_or.reduceat(~common[order], starts)
    spare = int(np.count_nonzero(telling)) - apart
    if spare > 0:
        out.append(signs[telling][: apart + 1 + more])
        return min(spare, more + 1)
    out.append(signs)
    if len(filled) > apart:
        return 1
    for empty in sorted(set(range(parts)) - set(filled.tolist())):
        inner = _salt(int(salt), empty)
        if depth:
            _emit(tokens, common, parts, apart, 0, inner, depth - 1, out)
        else:
            out.append(np.array([inner], np.uint64))
    return 1


_NONE = np.empty(0, np.uint64)


def signatures(tokens: np.ndarray, alike: int = ALIKE, common: np.ndarray = _NONE, turn: int = 0) -> np.ndarray:
    """All signatures of a set: for its own band of sizes, and for the next if alike sets may lie there.

    ``common`` are the common tokens, in order; whichever they are, and in whatever turn, alike
    sets share a signature. Tokens fall into other parts in every turn.
    """
    return signatures_and_needs(tokens, alike, common, turn)[0]


def signatures_and_needs(
    tokens: np.ndarray, alike: int = ALIKE, common: np.ndarray = _NONE, turn: int = 0
) -> tuple[np.ndarray, list[int]]:
    """The signatures of a set, and how many of one band an alike set that is signed for the band shares at least.

    The last bit of a signature is that of its band's number, by which the two bands of a set, and their needs, differ.
    """
    size = len(tokens)
    apart = most_apart(size, alike)
    needs = [1, 1]
    if not apart:
        return np.empty(0, np.int64), needs
    known = bands(alike)
    if len(common):
        widespread = common[np.minimum(np.searchsorted(common, tokens), len(common) - 1)] == tokens
    else:
        widespread = np.zeros(size, bool)
    own = max(i for i, (least, _) in enumerate(known) if least <= size)
    out: list[np.ndarray] = []
    for band in (own, own + 1):
        least, parts = known[band]
        if band == own or size * 100 // alike >= least:
            made: list[np.ndarray] = []
            salt = _salt(band, turn) if turn else _salt(band)
            needs[band % 2] = _emit(tokens, widespread, parts, apart, parts // SIGNED_MORE, salt, 3, made)
            out.append(_marked(np.concatenate(made), np.uint64(band % 2)))
    return np.unique(np.concatenate(out)).view(np.int64), needs


def _marked(signs: np.ndarray, bit: np.ndarray | np.uint64) -> np.ndarray:
    """Signatures with another last bit."""
    return signs & ~np.uint64(1) | bit


def _counted(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> (token, n): in how many of some thousand different texts a token is, if in several."""
    held: list[np.ndarray] = []
    met: set[int] = set()
    total = 0

    def count() -> pa.RecordBatch:
        tokens, n = np.unique(np.concatenate(held), return_counts=True) if held else (_NONE, np.empty(0, np.int64))
        several = n >= max(2, len(held) // (2 * COMMON))
        return pa.RecordBatch.from_arrays(
            [pa.array(tokens[several].view(np.int64)), pa.array(n[several].astype(np.int64))], names=["token", "n"]
        )

    for batch in batches:
        for text in texts_of(batch, batch.schema.names[1]):
            key = xxhash.xxh3_64_intdigest(text)
            if key not in met:
                met.add(key)
                held.append(shingle_set(text, words))
                total += len(held[-1])
            if total >= COUNTED:
                yield count()
                held, total = [], 0
                met.clear()
    yield count()


def common_tokens(rows: DataFrame, words: int) -> np.ndarray:
    """The tokens that many of all texts share, in order: a bounded number (see COMMON).

    They only steer which signatures are taken; results are the same whichever they are,
    so a token that is missed because it is spread thinly costs time and loses nothing.
    """
    least = max(COMMON_LEAST, rows.count() // COMMON)
    counts = rows.mapInArrow(releasing(partial(_counted, words=words)), "token long, n long")
    found = counts.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("token")
    with small_batches(rows.sparkSession, FEW_ROWS):
        found = found.toArrow()
    return np.sort(found.column("token").to_numpy().astype(np.int64).view(np.uint64))


def _sized(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> (doc_id, n_shingles, key, sketch)."""
    for batch in batches:
        sizes, keys, sketches = [], [], []
        for text in texts_of(batch, batch.schema.names[1]):
            tokens = shingle_set(text, words)
            sizes.append(len(tokens))
            keys.append(set_key(tokens) if len(tokens) else None)
            sketches.append(sketch(tokens) if len(tokens) else None)
        made = [pa.array(v, pa.int64()) for v in (sizes, keys, sketches)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["doc_id", "n_shingles", "key", "sketch"])


_SIGNED = "key long, signs array<long>, needs array<long>"


def _signed_rows(made: list[tuple[int, np.ndarray, list[int]]]) -> pa.RecordBatch:
    columns = zip(*made, strict=True) if made else [()] * 3
    kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array(list(v), k) for v, k in zip(columns, kinds, strict=True)], names=["key", "signs", "needs"]
    )


def _signed(batches: Iterator[pa.RecordBatch], words: int, alike: int, common: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> (key, signs, needs): a row for each set that a task meets in a row with a doc_id."""
    met: set[int] = set()
    for batch in batches:
        made = []
        for known, text in zip(batch.column(0).is_valid().to_pylist(), texts_of(batch, batch.schema.names[1]), strict=True):
            tokens = shingle_set(text, words) if known else _NONE
            key = set_key(tokens) if len(tokens) else None
            if key is not None and key not in met:
                met.add(key)
                made.append((key, *signatures_and_needs(tokens, alike, common)))
        yield _signed_rows(made)


def _signed_anew(
    batches: Iterator[pa.RecordBatch], words: int, alike: int, common: np.ndarray, turn: int
) -> Iterator[pa.RecordBatch]:
    """(root, key, text) -> (key, signs, needs): the signatures of another turn, each told apart by the group."""
    for batch in batches:
        made = []
        texts = texts_of(batch, batch.schema.names[2])
        for root, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
            tokens = shingle_set(text, words)
            if len(tokens) and set_key(tokens) == key:
                signs, needs = signatures_and_needs(tokens, alike, common, turn)
                signs = signs.view(np.uint64)
                signs = _marked(splitmix(signs ^ _salt(root & (1 << 64) - 1)), signs & np.uint64(1))
                made.append((key, signs.view(np.int64), needs))
        yield _signed_rows(made)


def _refined(
    chosen: DataFrame, rows: DataFrame, words: int, alike: int, common: np.ndarray, stash: Stash
) -> DataFrame:
    """``chosen`` (root, key, sketch, id, n) with groups of more than a block taken apart where that loses no link.

    Signatures also join sets that only share a passage, and such joins chain up. Alike sets share
    a signature in every turn, others seldom in several, so members of a large group are
    signed anew: what shares a signature within the group stays together, and who
    shares none is alike to nobody.
    """
    for turn in range(1, SIGNED_ANEW + 1):
        weights = chosen.groupBy("root").agg(F.sum("n").alias("weight"))
        large = stash.put(weights.where(F.col("weight") > BLOCK).select("root"), "large")
        if large.isEmpty():
            break
        members = chosen.join(large, "root", "left_semi")
        picked = members.select("id", "root", "key")
        picked = F.broadcast(picked) if picked.count() <= BROADCAST_ROWS else picked
        fetched = rows.join(picked, rows["doc_id"] == picked["id"]).select("root", "key", "text")
        signing = partial(_signed_anew, words=words, alike=alike, common=common, turn=turn)
        groups = _rooted(fetched.mapInArrow(releasing(signing), _SIGNED), stash)
        apart = members.drop("root").join(groups, F.col("key") == F.col("node")).select("root", "key", "sketch", "id", "n")
        chosen = stash.put(chosen.join(large, "root", "left_anti").unionByName(apart), "chosen")
    return chosen


_PLACED = "root long, grp long, alone boolean, key long"


def _tokens(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(..., key, text) -> (..., key, tokens) of rows whose text has that key."""
    for batch in batches:
        *names, key_name, text_name = batch.schema.names
        kept, sets = [], []
        for i, (key, text) in enumerate(zip(batch.column(key_name).to_pylist(), texts_of(batch, text_name), strict=True)):
            tokens = shingle_set(text, words)
            if len(tokens) and set_key(tokens) == key:
                kept.append(i)
                sets.append(tokens.view(np.int64))
        left = batch.take(pa.array(kept, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*left.columns[:-1], pa.array(sets, pa.list_(pa.int64()))], names=[*names, key_name, "tokens"]
        )


def spanning_links(keys: list[int], sets: list[np.ndarray], alike: int = ALIKE) -> list[tuple[int, int]]:
    """Links between some sets, enough of them that what all links connect is connected.

    One scan over all tokens compares a set with every other. The set that shares most
    of its tokens goes first; sets that have come into its component need no scan of
    their own, since those outside compare themselves with them.
    """
    if len(keys) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.add.reduceat((counts > 1)[inverse].astype(np.int64), starts)
    order = np.argsort(-shared / sizes, kind="stable")
    label = np.arange(len(keys))
    hub, links = order[0], []
    mark = np.zeros(len(counts), bool)
    for at in order.tolist():
        if at != hub and label[at] == label[hub]:
            continue
        # no set can be alike that shares too few tokens with all the others together
        if 100 * shared[at] < alike * sizes[at]:
            continue
        mine = inverse[starts[at] : starts[at] + sizes[at]]
        mark[mine] = True
        common = np.add.reduceat(mark[inverse].astype(np.int64), starts)
        mark[mine] = False
        near = (100 * common >= alike * (sizes + sizes[at] - common)) & (label != label[at])
        for other in np.flatnonzero(near).tolist():
            if label[other] != label[at]:
                links.append((keys[at], keys[other]))
                label[label == label[other]] = label[at]
        if (label == label[hub]).all():
            break
    return links


_FOUND = "a long, b long, root long, grp long"
_SHARED = "key long, other long, shared long, hub_shared long"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray]]:
    """The rows of batches whose last column is ``tokens``: the other values, and the tokens as an array."""
    for batch in batches:
        others = [c.to_pylist() for c in batch.columns[:-1]]
        offsets, flat = batch.columns[-1].offsets.to_numpy(), batch.columns[-1].values.to_numpy(zero_copy_only=False)
        for i, row in enumerate(zip(*others, strict=True)):
            yield list(row), flat[offsets[i] : offsets[i + 1]].copy()


def _opened(batches: Iterator[pa.RecordBatch], alike: int) -> Iterator[pa.RecordBatch]:
    """Rows (root, grp, alone, key, tokens) in the order of root and group -> links, and the groups' hubs.

    A group is opened whole: its links are rows (a, b). One that is not alone in its
    root and has links adds the set that most of them start from, its hub: (key, null, root, grp).
    """
    held: dict[int, np.ndarray] = {}
    place = None

    def close() -> pa.RecordBatch:
        keys = sorted(held)
        links = spanning_links(keys, [held[k] for k in keys], alike)
        rows = [(a, b, None, None) for a, b in links]
        if place and not place[2] and links:
            rows.append((Counter(a for a, _ in links).most_common(1)[0][0], None, *place[:2]))
        columns = zip(*rows, strict=True) if rows else [()] * 4
        made = [pa.array(list(v), pa.int64()) for v in columns]
        return pa.RecordBatch.from_arrays(made, names=["a", "b", "root", "grp"])

    for (root, grp, alone, key), tokens in _sets(batches):
        if (root, grp, alone) != place:
            yield close()
            held, place = {}, (root, grp, alone)
        held[key] = tokens
    yield close()


def _sliced(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(root, grp, blocks, hub, key, text) -> (root, slice, grp, hub, key, tokens): a set's tokens dealt into ``blocks`` slices by their hash."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.int64()))
    for (root, grp, blocks, hub, key), tokens in _sets(_tokens(batches, words)):
        at = (splitmix(tokens.view(np.uint64) ^ _SLICE) >> np.uint64(32)) % np.uint64(blocks)
        order = np.argsort(at, kind="stable")
        filled, starts = np.unique(at[order], return_index=True)
        parts = np.split(tokens[order], starts[1:])
        n = len(filled)
        columns = ([root] * n, filled.astype(np.int64), [grp] * n, [hub] * n, [key] * n, parts)
        made = [pa.array(v, k) for v, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(made, names=["root", "slice", "grp", "hub", "key", "tokens"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (root, slice, grp, hub, key, tokens) in the order of root and slice -> (key, other, shared, hub_shared).

    The rows of a slice are some rows of the matrix, for all sets and groups of the root: how many of a
    set's tokens there are in the union of another group, and in its hub. Sums over the slices are exact.
    """
    held: list[tuple[int, bool, int, np.ndarray]] = []
    place = None

    def close() -> Iterator[pa.RecordBatch]:
        if len({grp for grp, *_ in held}) < 2:
            return
        _, inverse = np.unique(np.concatenate([tokens for *_, tokens in held]), return_inverse=True)
        owner = np.repeat(np.arange(len(held)), [len(tokens) for *_, tokens in held])
        names, column = np.unique([grp for grp, *_ in held], return_inverse=True)
        keys, hubs = np.array([key for *_, key, _ in held]), np.array([hub for _, hub, *_ in held])
        # tokens of one group only are in no other's union
        first = np.zeros(inverse.max() + 1, np.int64)
        first[inverse] = column[owner]
        several = np.zeros(len(first), bool)
        several[inverse[first[inverse] != column[owner]]] = True
        inverse, owner = inverse[several[inverse]], owner[several[inverse]]
        for at, name in enumerate(names.tolist()):
            member = column[owner] == at
            counts = []
            for inside in (member, member & hubs[owner]):
                met = np.zeros(len(first), bool)
                met[inverse[inside]] = True
                counts.append(np.bincount(owner[met[inverse] & ~member], minlength=len(held)))
            some = np.flatnonzero(counts[0])
            made = (keys[some], np.full(len(some), name), *(n[some] for n in counts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v.astype(np.int64)) for v in made], names=["key", "other", "shared", "hub_shared"]
            )

    for (root, part, grp, hub, key), tokens in _sets(batches):
        if (root, part) != place:
            yield from close()
            held, place = [], (root, part)
        held.append((grp, hub, key, tokens))
    yield from close()


def _grouped(chosen: DataFrame, stash: Stash) -> DataFrame:
    """(id, root, grp, alone, key, n, blocks): the groups that the sets of a root are partitioned into, each of about a block.

    Sets with the same sketch, which similar sets tend to have, stay in one group; only
    where they alone are more than half a block are they dealt out by their keys.
    """
    weights = chosen.groupBy("root").agg(F.ceil(F.sum("n") / F.lit(BLOCK)).alias("blocks"))
    large = stash.put(weights.where("blocks > 1"), "large")
    whole = chosen.join(large, "root", "left_anti").select(
        "id", "root", F.lit(0).cast("long").alias("grp"), F.lit(True).alias("alone"), "key", "n", F.lit(1).cast("long").alias("blocks")
    )
    several = chosen.join(large, "root")
    heavy = several.groupBy("root", "sketch").agg(F.sum("n").alias("heavy"))
    parts = F.ceil(F.col("heavy") / F.lit(BLOCK))
    own = F.xxhash64("sketch", F.pmod(F.xxhash64("key"), parts))
    grp = F.when(2 * F.col("heavy") > BLOCK, own).otherwise(F.pmod(F.xxhash64("sketch"), F.col("blocks")))
    dealt = several.join(heavy, ["root", "sketch"])
    dealt = dealt.select("id", "root", grp.alias("grp"), F.lit(False).alias("alone"), "key", "n", "blocks")
    return stash.put(whole.unionByName(dealt), "groups")


def _together(rows: DataFrame, alike: int) -> DataFrame:
    ordered = rows.repartition("root", "grp").sortWithinPartitions("root", "grp")
    return ordered.mapInArrow(releasing(partial(_opened, alike=alike)), _FOUND)


def _with_texts(rows: DataFrame, picked: DataFrame) -> DataFrame:
    """The texts of ``picked`` (id and other columns), from which token sets are made anew; nothing but ``picked`` is kept."""
    near = F.broadcast(picked) if picked.count() <= BROADCAST_ROWS else picked
    names = [c for c in picked.columns if c != "id"]
    return rows.join(near, rows["doc_id"] == near["id"]).select(*names, "text")


def _with_tokens(rows: DataFrame, picked: DataFrame, words: int, schema: str) -> DataFrame:
    """The token sets of ``picked`` (id, the columns of ``schema``)."""
    return _with_texts(rows, picked).mapInArrow(releasing(partial(_tokens, words=words)), f"{schema}, tokens array<long>")


def _links(rows: DataFrame, groups: DataFrame, words: int, alike: int, stash: Stash) -> tuple[DataFrame, DataFrame]:
    """(a, b) links that connect what all links of the groups' sets do, and the sets (id, key, pairs) sent a second time.

    1. Every group's sets come together once; links inside it are found, and the set most of them start from, its hub.
    2. The sets of a root of several groups are sent once more, cut into slices by the hash of their tokens.
       A slice of the matrix counts what a set shares with the unions and with the hubs of the other groups. Summed,
       the counts bound sets against groups and link them with hubs, which joins most of a family that fills many groups.
    3. Two groups are opened for each other only for sets that qualify on both sides and that
       links found so far leave in different components.
    """
    placed = groups.select("id", "root", "grp", "alone", "key")
    found = stash.put(_together(_with_tokens(rows, placed, words, _PLACED), alike), "opened")
    links = found.where("b is not null").select("a", "b")
    several = groups.where("not alone")
    if several.isEmpty():
        return links, groups.limit(0).select("id", "key", F.array().cast("array<long>").alias("pairs"))
    sized = several.select("key", "root", "grp", "n")
    hubs = found.where("b is null").select(F.col("a").alias("key")).withColumn("hub", F.lit(True))
    own = several.join(hubs, "key", "left").select("id", "root", "grp", "blocks", F.coalesce("hub", F.lit(False)).alias("hub"), "key")
    slices = _with_texts(rows, stash.put(own, "own")).mapInArrow(
        releasing(partial(_sliced, words=words)), "root long, slice long, grp long, hub boolean, key long, tokens array<long>"
    )
    slices = slices.repartition("root", "slice").sortWithinPartitions("root", "slice")
    shared = slices.mapInArrow(releasing(_shared), _SHARED).groupBy("key", "other")
    shared = shared.agg(F.sum("shared").alias("shared"), F.sum("hub_shared").alias("hub_shared"))
    best = hubs.drop("hub").join(sized, "key").select(
        F.col("root").alias("of"), F.col("grp").alias("at"), F.col("key").alias("hub"), F.col("n").alias("hub_n")
    )
    able = shared.join(sized, "key").where(100 * F.col("shared") >= alike * F.col("n"))
    able = able.join(best, (F.col("root") == F.col("of")) & (F.col("other") == F.col("at")), "left")
    near = 100 * F.col("hub_shared") >= alike * (F.col("n") + F.col("hub_n") - F.col("hub_shared"))
    bounded = stash.put(
        able.select(
            "key",
            "root",
            "grp",
            F.least("grp", "other").alias("lo"),
            F.greatest("grp", "other").alias("hi"),
            F.when(near, F.col("hub")).alias("b"),
        ),
        "bounded",
    )
    links = links.unionByName(bounded.where("b is not null").select(F.col("key").alias("a"), "b"))

    linked = connected_components(links, stash).select("node", F.col("root").alias("least"))
    able = bounded.select("root", "lo", "hi", "grp", "key")
    able = able.join(linked, able["key"] == linked["node"], "left").withColumn("least", F.coalesce("least", "key"))
    low, pair = F.col("grp") == F.col("lo"), ["root", "lo", "hi"]
    sides = able.groupBy(*pair).agg(
        *[f(F.when(side, F.col("least"))).alias(n) for side, f, n in ((low, F.min, "a0"), (low, F.max, "a1"), (~low, F.min, "b0"), (~low, F.max, "b1"))]
    )
    other = F.when(low, F.struct(F.col("b0").alias("x"), F.col("b1").alias("y"))).otherwise(F.struct(F.col("a0").alias("x"), F.col("a1").alias("y")))
    left = able.join(sides, pair).where((other["x"] != F.col("least")) | (other["y"] != F.col("least")))
    sent = left.groupBy("key").agg(F.collect_set(F.xxhash64("lo", "hi")).alias("pairs"))
    sent = stash.put(sent.join(groups.select("id", "root", "key"), "key").select("id", "root", "pairs", "key"), "sent")
    if not sent.isEmpty():
        again = _with_tokens(rows, sent, words, "root long, pairs array<long>, key long")
        again = again.select("root", F.explode("pairs").alias("grp"), F.lit(True).alias("alone"), "key", "tokens")
        links = links.unionByName(_together(again, alike).select("a", "b"))
    return links, sent


def _meetings(signs: DataFrame) -> DataFrame:
    """(sign, key, need) rows of signs that several sets have, with the least of their keys."""
    same = Window.partitionBy("sign")
    rows = signs.select("sign", "key", "need", F.min("key").over(same).alias("lo"), F.max("key").over(same).alias("hi"))
    return rows.where("lo <> hi").drop("hi").distinct()


def _rooted(signed: DataFrame, stash: Stash) -> DataFrame:
    """(key, signs, needs) -> (node, root): what shared signatures connect.

    A set that shares fewer signatures of a band with all other sets together than it shares with
    an alike one at least has none alike there, and its signatures of that band connect nothing.
    Signatures are most of what the join moves, so they are sent as they are made and not kept.
    """
    band = F.col("sign").bitwiseAND(F.lit(1)).cast("int")
    signs = signed.select(F.explode("signs").alias("sign"), "key", "needs")
    signs = signs.select("sign", "key", F.element_at("needs", band + 1).cast("int").alias("need"))
    meetings = stash.put(_meetings(signs), "meetings")
    banded = meetings.select("sign", "key", "need", band.alias("band"))
    able = banded.groupBy("key", "band").agg(F.count("*").alias("shared"), F.max("need").alias("least"))
    able = able.where("shared >= least").select("key", "band")
    left = _meetings(banded.join(able, ["key", "band"], "left_semi"))
    groups = connected_components(left.where("key <> lo").select(F.col("key").alias("a"), F.col("lo").alias("b")), stash)
    stash.drop(meetings)
    return groups


def jaccard_components(
    docs: DataFrame, words: int = WORDS, alike: int = ALIKE, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id): what links of similar shingle sets connect.

    Sets of shingles of ``words`` words link when 100 * shared >= ``alike`` * united.

    1. Equal sets are one class, whatever the number of copies; a class has a 64-bit key.
    2. Sets that may be alike share signatures (see ``_emit``): no pair is lost, and
       passages that many texts share make none. A set that shares fewer than alike sets must
       is left out (see ``_rooted``). What the other shared signatures connect is a
       root of similar sets, so a set has partners in its own root only. Roots larger than
       a block are signed anew, which takes them apart where only passages held them
       together (see ``_refined``).
    3. A root's sets are partitioned into groups of similar sets (see ``_grouped``), and the unions
       of the groups' tokens are the matrix of tokens and groups.
    4. A set's overlap with the union of another group of its root bounds its similarity with every set
       there, and only groups that may hold a match are opened for it (see ``_links``). The matrix is cut by
       tokens, so a set is sent once for all groups and no union is sent at all.

    Null and empty texts have 0 shingles and are their own component; a row without a
    key links with nothing and its component is null; repeated rows are copies; an empty
    table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    # a row holds a text and its set of tokens, so batches of the usual number of rows are large on both sides
    stash = Stash(spark, FEW_ROWS)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sized = partial(_sized, words=words)
    slim = stash.put(rows.mapInArrow(releasing(sized), "doc_id long, n_shingles long, key long, sketch long"), "rows")
    common = common_tokens(rows, words)
    signed = partial(_signed, words=words, alike=alike, common=common)
    groups = _rooted(rows.mapInArrow(releasing(signed), _SIGNED), stash)

    # one document of each class that met another class: its tokens are made anew from its text
    members = slim.where(F.col("doc_id").isNotNull() & F.col("key").isNotNull())
    chosen = members.join(groups, members["key"] == groups["node"]).groupBy("root", "key")
    chosen = stash.put(chosen.agg(F.min("sketch").alias("sketch"), F.min("doc_id").alias("id"), F.max("n_shingles").alias("n")), "chosen")
    chosen = _refined(chosen, rows, words, alike, common, stash)
    found, _ = _links(rows, _grouped(chosen, stash), words, alike, stash)
    links = stash.put(found, "links")
    linked = connected_components(links, stash)
    stash.drop(links)

    rooted = slim.join(linked, slim["key"] == linked["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "key").alias("root")
    )
    # a table of its own, so that the join below is dealt anew and a group of many copies can be split
    least = rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    least = stash.put(least, "least")
    return rooted.join(least, "root", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, words: int, alike: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the least key.

    Rows without a key stay, as do texts without shingles. Of repeated rows one stays.
    Only keys are shuffled: those that go are taken out by a join that is a broadcast
    if they are few and a shuffle otherwise.
    """
    spark = docs.sparkSession
    found = Stash(spark).put(jaccard_components(docs, words, alike, key, text), "components")
    per = found.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    per = per.agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count("*").alias("n"))

    def without(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
        return rows.join(ids, rows[key].cast("long") == ids["__id"], how)

    gone = per.where(~F.col("stays")).select(F.col("doc_id").alias("__id"))
    twice = per.where("stays and n > 1").select(F.col("doc_id").alias("__id"))
    left = without(docs, gone, "left_anti")
    return without(left, twice, "left_anti").unionByName(without(left, twice, "left_semi").dropDuplicates([key, text]))
