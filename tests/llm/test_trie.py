"""The conversation trie against sets of prefixes, and its double array by itself."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ticketloom.llm import queries, trie
from ticketloom.llm.common import table

COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]
SCHEMA = "conv_id long, turn long, role string, text string, words string, n string, pos string, depth string"


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(t)] for c, t in turns.items()}
    built = {}
    for conv in sorted(own):
        heads = zlib.crc32(str(conv).encode()) % 4
        built[conv] = own.get(conv - conv % 20, [])[:heads] + own[conv][heads:]
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for conv, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(str(conv))
    for prefix in members:
        if prefix:
            children[prefix[:-1]].add(prefix)
    leaves, saved = defaultdict(int), defaultdict(int)
    for prefix, convs in members.items():
        tokens = len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        for d in range(len(prefix) + 1):
            saved[prefix[:d]] += (len(convs) - 1) * tokens
            leaves[prefix[:d]] += not children[prefix]
    return sorted(
        (
            convs[0],
            len(prefix),
            members[prefix[:-1]][0] if prefix else -1,
            len(convs),
            len(children[prefix]),
            leaves[prefix],
            saved[prefix],
            hashlib.sha256(",".join(ends[prefix]).encode()).hexdigest(),
        )
        for prefix, convs in members.items()
    )


def told(nodes):
    assert nodes.columns == COLUMNS
    return sorted(tuple(-1 if v is None else v for v in r) for r in nodes.collect())


def planted(seed):
    """Conversations that share beginnings of every length, whole copies, one long one, odd rows."""
    draw = random.Random(seed)
    openings = [[("user", f"hello {i}"), ("assistant", f"how can i help {i}")] for i in range(4)]
    rows = []
    for conv in range(0, 400):
        if conv % 37 == 5:
            continue  # some conversations, and some firsts of families, are absent
        turns = list(draw.choice(openings)[: draw.randint(0, 2)])
        turns += [(draw.choice(["user", None]), draw.choice(["a b", "c", "", None, "d\te f"])) for _ in range(draw.randint(0, 4))]
        if conv % 3 == 0:
            turns = [("user", "one and the same"), ("assistant", "yes"), ("user", "thanks a lot")]
        rows += [(conv, t, role, text) for t, (role, text) in enumerate(turns)]
    rows += [(500, 100 * t, "user", f"turn {t % 7}") for t in range(150)]
    rows += [(501, None, "user", "no number"), (501, None, "a", "no number"), (501, 3, "user", "x"), (501, 3, "user", "x")]
    rows += [(None, 1, "user", "nobody"), (-41, 0, "user", "hello 1"), (-40, 0, "user", "hello 1")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("shard", "heavy"), [(trie.SHARD, trie.HEAVY), (300, 40), (60, 0)])
def test_trie_of_planted_conversations(spark, shard, heavy):
    rows = planted(shard)
    frame = spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA)
    assert told(trie.conversation_trie(frame, shard, heavy)) == brute(rows)


def test_empty_and_turnless(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert trie.conversation_trie(frame).columns == COLUMNS
    assert trie.conversation_trie(frame).count() == 0
    # conversations 1 and 3 have fewer turns than they would share, and the first of their family is absent
    rows = [(1, 0, "user", "x"), (3, 0, "user", "x")]
    alone = spark.createDataFrame([(*r, "", "", "", "") for r in rows], SCHEMA)
    assert told(trie.conversation_trie(alone)) == brute(rows)


def test_trie_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert told(queries.QUERIES["op12_conversation_trie"](spark, sf)) == brute(rows)


@pytest.mark.parametrize("seed", range(4))
def test_double_array_holds_its_sequences(seed):
    draw = random.Random(seed)
    wide = draw.choice([3, 50, 4000])
    made = {tuple(draw.randrange(wide) for _ in range(draw.randint(1, 6))) for _ in range(3000)}
    sequences = [np.array(s, np.int64) for s in sorted(made)]
    array = trie.build(sequences)
    prefixes = {s[:d] for s in made for d in range(len(s) + 1)}
    places = {}
    for prefix in sorted(prefixes, key=len):
        state = 0 if not prefix else places[prefix[:-1]]
        if prefix:
            state = int(array.step(np.array([state]), np.array([prefix[-1]]))[0])
            assert state > 0
        places[prefix] = state
    assert len(set(places.values())) == len(prefixes) == (array.check >= 0).sum()
    for prefix in list(prefixes)[:300]:
        for turn in range(min(wide, 20)):
            found = int(array.step(np.array([places[prefix]]), np.array([turn]))[0])
            assert (found >= 0) == ((*prefix, turn) in prefixes)
