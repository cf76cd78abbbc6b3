"""Joins of near copies against all pairs, on planted rows and on whole small tables."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from odd_rows import nothing, odd  # noqa: F401

from ticketloom.llm import jaccard, polytope, queries
from ticketloom.llm.common import FEW_ROWS, table
from ticketloom.llm.components import Stash, connected_components


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_and_stars(spark):
    draw = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)]
    links += [(draw.randint(200, 400), draw.randint(200, 400)) for _ in range(120)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"), Stash(spark))
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r["node"]: r["root"] for r in found.collect()} == components(nodes, [x for x in links if x[0] != x[1]])
    assert connected_components(spark.createDataFrame([], "a long, b long"), Stash(spark)).count() == 0


def brute_jaccard(texts, words, alike):
    sets = {}
    for i, text in texts.items():
        parts = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets[i] = frozenset(tuple(parts[k : k + words]) for k in range(max(1, len(parts) - words + 1))) if parts else frozenset()
    links = [
        (a, b)
        for a, b in itertools.combinations(sorted(sets), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= alike * len(sets[a] | sets[b])
    ]
    return {i: len(s) for i, s in sets.items()}, components(sets, links)


def planted(seed, families=12, members=14):
    """Families of texts with a word here and there changed, added or left out, and one shared passage."""
    draw = random.Random(seed)

    def words(n):
        return ["".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(n)]

    passage, texts = words(55), {}
    for _ in range(families):
        base = words(draw.choice([3, 5, 9, 10, 12, 15, 18, 24, 40, 120, 400]))
        for _ in range(members):
            text = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 40))):
                at = draw.randrange(len(text) + 1)
                text[at : at + draw.randint(0, 1)] = words(draw.randint(0, 1))
            if draw.random() < 0.2:
                text = [*passage, *text]
            joined = " ".join(text)
            texts[len(texts)] = joined.upper() if draw.random() < 0.2 else joined
    return texts


def test_the_join_gives_python_few_rows_at_a_time(spark, monkeypatch):
    """Token sets are wide rows: a batch of the usual 10,000 of them is large in the JVM and in Python."""
    name, met = "spark.sql.execution.arrow.maxRecordsPerBatch", []

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    before = spark.conf.get(name)
    counted = spark.range(0, 2000, 1, 1).mapInArrow(sizes, "n long")
    assert max(r["n"] for r in Stash(spark, 100).put(counted, "sizes").collect()) == 100
    assert spark.conf.get(name) == before

    class Seen(Stash):
        def __init__(self, spark, batch_rows=None):
            met.append(batch_rows)
            super().__init__(spark, batch_rows)

    monkeypatch.setattr(jaccard, "Stash", Seen)
    made = jaccard.jaccard_components(spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e")], "doc_id long, text string"))
    assert [r["component_id"] for r in made.collect()] == [1, 1]
    assert met == [FEW_ROWS] and spark.conf.get(name) == before


@pytest.mark.parametrize(("words", "alike", "least"), [(4, 85, 16), (5, 80, 2)])
def test_planted_families_match_all_pairs(spark, monkeypatch, words, alike, least):
    monkeypatch.setattr(jaccard, "COMMON_LEAST", least)
    texts = planted(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    found = jaccard.jaccard_components(docs, words, alike).collect()
    sizes, roots = brute_jaccard(texts, words, alike)
    assert {r["doc_id"]: r["n_shingles"] for r in found} == sizes
    assert {r["doc_id"]: r["component_id"] for r in found} == roots
    assert len(set(roots.values())) < len(roots)


def test_blocks_give_the_same_links(spark, monkeypatch):
    texts = planted(9, families=3, members=40)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    # most groups are larger than a block: they are signed anew, and what is left is partitioned into groups
    monkeypatch.setattr(jaccard, "BLOCK", 300)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    found = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs).collect()}
    assert found == brute_jaccard(texts, 4, 85)[1]


def test_a_family_of_many_groups_is_sent_once(spark, monkeypatch):
    """Near copies that fill ten groups: links with the groups' best linked sets join them, so none is sent again."""
    draw = random.Random(4)
    base = [f"w{draw.randrange(10**6)}" for _ in range(300)]
    texts = {}
    for i in range(120):
        text = list(base)
        text[draw.randrange(300)] = f"x{i}"
        texts[i] = " ".join(text)
    # sets that share a good part of the family's tokens and link with nobody
    for i in range(120, 140):
        texts[i] = " ".join([*base[: 150 + i], *[f"y{i}z{k}" for k in range(60)]])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(jaccard, "BLOCK", 3000)
    stash = Stash(spark)
    rows = []
    for i, text in texts.items():
        tokens = jaccard.shingle_set(text.encode())
        rows.append((1, jaccard.set_key(tokens), jaccard.sketch(tokens), i, len(tokens)))
    chosen = spark.createDataFrame(rows, "root long, key long, sketch long, id long, n long")
    groups = jaccard._grouped(chosen, stash)
    assert groups.where("not alone").select("grp").distinct().count() >= 10
    links, sent = jaccard._links(docs, groups, 4, 85, stash)
    assert sent.count() < 20
    of = {r["key"]: r["id"] for r in groups.collect()}
    joined = components(texts, [(of[r["a"]], of[r["b"]]) for r in links.collect()])
    assert joined == brute_jaccard(texts, 4, 85)[1]
    assert len(set(joined.values())) > 10


def test_groups_that_qualify_are_opened_for_each_other(spark, monkeypatch):
    """Chains of sets, dealt at random into small groups: every link across groups is found."""
    draw = random.Random(8)
    texts = {}
    for chain in range(4):
        words = [f"c{chain}w{k}" for k in range(60)]
        for i in range(30):
            words = words[2:] + [f"c{chain}w{60 + 2 * i + k}" for k in range(2)]
            texts[len(texts)] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(jaccard, "BLOCK", 200)
    rows = []
    for i, text in texts.items():
        tokens = jaccard.shingle_set(text.encode())
        rows.append((1, jaccard.set_key(tokens), draw.randrange(10**9), i, len(tokens)))
    chosen = spark.createDataFrame(rows, "root long, key long, sketch long, id long, n long")
    stash = Stash(spark)
    groups = jaccard._grouped(chosen, stash)
    links, sent = jaccard._links(docs, groups, 4, 85, stash)
    assert sent.count()
    of = {r["key"]: r["id"] for r in groups.collect()}
    joined = components(texts, [(of[r["a"]], of[r["b"]]) for r in links.collect()])
    assert joined == brute_jaccard(texts, 4, 85)[1]
    assert len(set(joined.values())) == 4


def test_the_matrix_is_sent_in_slices_and_once(spark):
    """However many groups a root has, a set's tokens go out once, dealt into slices; their counts add up to the overlaps."""
    draw = random.Random(6)
    rows = []
    for i in range(60):
        text = " ".join(f"w{draw.randrange(90)}" for _ in range(draw.choice([5, 80, 200])))
        key = jaccard.set_key(jaccard.shingle_set(text.encode(), 2))
        rows.append((7, i % 9, 9, i in (4, 8), key, text))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string())
    columns = [pa.array(list(v), k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    batch = pa.RecordBatch.from_arrays(columns, names=["root", "grp", "blocks", "hub", "key", "text"])
    slices = pa.Table.from_batches(list(jaccard._sliced(iter([batch]), 2)))
    sets = {key: set(jaccard.shingle_set(text.encode(), 2).view(np.int64).tolist()) for *_, key, text in rows}
    met = {key: [] for key in sets}
    for key, tokens in zip(slices["key"].to_pylist(), slices["tokens"].to_pylist(), strict=True):
        met[key] += tokens
    assert all(sorted(met[key]) == sorted(sets[key]) for key in sets)
    assert max(map(len, slices["tokens"].to_pylist())) < max(map(len, sets.values())) / 3

    ordered = slices.sort_by([("root", "ascending"), ("slice", "ascending")]).to_batches(max_chunksize=16)
    found: dict[tuple[int, int], list[int]] = {}
    for part in jaccard._shared(iter(ordered)):
        for r in part.to_pylist():
            told = found.setdefault((r["key"], r["other"]), [0, 0])
            told[0] += r["shared"]
            told[1] += r["hub_shared"]
    expected = {}
    for _, grp, _, _, key, _ in rows:
        for other in set(range(9)) - {grp}:
            union = set().union(*[sets[k] for _, g, _, _, k, _ in rows if g == other])
            hub = set().union(*[sets[k] for _, g, _, is_hub, k, _ in rows if g == other and is_hub])
            if sets[key] & union:
                expected[key, other] = [len(sets[key] & union), len(sets[key] & hub)]
    assert found == expected


@pytest.mark.parametrize("alike", [80, 85])
def test_alike_sets_share_a_signature(alike):
    draw = np.random.default_rng(alike)
    pairs = 0
    for _ in range(3000):
        size = int(draw.choice([*range(4, 40), 60, 100, 300]))
        numbers = draw.integers(0, 2**63, size * 2).astype(np.uint64)
        cut, more = (int(draw.integers(0, size // 5 + 2)) for _ in range(2))
        a, b = np.unique(numbers[:size]), np.unique(np.concatenate([numbers[cut:size], numbers[size : size + more]]))
        shared = len(np.intersect1d(a, b))
        if shared < size and len(b) and 100 * shared >= alike * (len(a) + len(b) - shared):
            pairs += 1
            assert len(np.intersect1d(jaccard.signatures(a, alike), jaccard.signatures(b, alike)))
            # whichever tokens count as common
            common = np.sort(draw.choice(numbers, int(draw.integers(1, len(numbers) + 1)), replace=False))
            assert len(np.intersect1d(jaccard.signatures(a, alike, common), jaccard.signatures(b, alike, common)))
            # and in every turn, which are independent of each other
            again = jaccard.signatures(a, alike, common, 2)
            assert len(np.intersect1d(again, jaccard.signatures(b, alike, common, 2)))
            assert not len(np.intersect1d(again, jaccard.signatures(a, alike, common)))
    assert pairs > 300


@pytest.mark.parametrize("alike", [80, 85])
def test_alike_sets_share_as_many_signatures_as_they_need(alike):
    draw = np.random.default_rng(alike + 1)
    pairs = most = 0
    for _ in range(2000):
        size = int(draw.choice([*range(4, 40), 60, 100, 300, 1500]))
        numbers = draw.integers(0, 2**63, size * 2).astype(np.uint64)
        cut, more = (int(draw.integers(0, size // 5 + 2)) for _ in range(2))
        a, b = np.unique(numbers[:size]), np.unique(np.concatenate([numbers[cut:size], numbers[size : size + more]]))
        shared = len(np.intersect1d(a, b))
        if shared < size and len(b) and 100 * shared >= alike * (len(a) + len(b) - shared):
            pairs += 1
            common = np.sort(draw.choice(numbers, int(draw.integers(0, len(numbers) + 1)), replace=False))
            for turn in (0, 2):
                (x, needs), (y, others) = (jaccard.signatures_and_needs(s, alike, common, turn) for s in (a, b))
                both = np.intersect1d(x, y)
                assert any((both & 1 == bit).sum() >= max(needs[bit], others[bit]) for bit in (0, 1))
                most = max(most, *needs)
    assert pairs > 200 and most > 5


def test_texts_that_only_share_passages_are_not_sent(spark, monkeypatch):
    """Long texts, each with a passage of the one before: one root by shared signatures, but alike to nobody."""
    draw, asked = random.Random(11), []

    def words(n):
        return [f"w{draw.randrange(10**9)}" for _ in range(n)]

    passages = [words(1500) for _ in range(25)]
    texts = [[*passages[i], *words(3000), *passages[i + 1]] for i in range(24)]
    for i in (5, 17):  # near copies, of which links must be found
        texts.append([*texts[i][:2000], *words(100), *texts[i][2100:]])
    texts = {i: " ".join(text) for i, text in enumerate(texts)}
    signs = [set(jaccard.signatures(jaccard.shingle_set(text.encode())).tolist()) for text in texts.values()]
    assert sum(bool(signs[i] & signs[i + 1]) for i in range(23)) > 15

    def grouped(chosen, stash, f=jaccard._grouped):
        asked.extend(r["id"] for r in chosen.select("id").collect())
        return f(chosen, stash)

    monkeypatch.setattr(jaccard, "_grouped", grouped)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs).collect()}
    assert found == {i: {24: 5, 25: 17}.get(i, i) for i in texts} == brute_jaccard(texts, 4, 85)[1]
    assert sorted(asked) == [5, 17, 24, 25]


def test_join_query_matches_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").select("doc_id", "text").collect()}
    found = queries.op8(spark, sf).collect()
    sizes, roots = brute_jaccard(texts, 4, 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == {i: (sizes[i], roots[i]) for i in texts}


def test_join_odd_rows(odd, nothing):
    rows = jaccard.jaccard_components(odd).toPandas()
    assert len(rows) == 11
    assert rows[rows.doc_id.isna()].component_id.isna().all()
    named = rows[rows.doc_id.notna()]
    assert (named.component_id == named.doc_id).all()
    assert jaccard.jaccard_components(nothing).count() == 0
    one = jaccard.one_of_each(odd, 5, 80)
    assert one.columns == odd.columns and one.count() == 10 and one.where("doc_id = 4").count() == 1
    assert jaccard.one_of_each(nothing, 5, 80).count() == 0


# --- vectors --------------------------------------------------------------------------


def brute_vectors(rows, alike=0.9):
    usable = {}
    for key, vector in rows:
        if vector and all(x is not None and np.isfinite(x) for x in vector) and any(vector):
            usable[key] = polytope.unit(np.array([vector], float))[0]
    links = [
        (a, b)
        for a, b in itertools.combinations(sorted(usable), 2)
        if len(usable[a]) == len(usable[b]) and float(usable[a] @ usable[b]) >= alike
    ]
    counts = {key: 0 for key, _ in rows}
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    return counts, components(counts, links)


def test_hadamard_matches_its_matrix():
    h = np.array([[1.0]])
    for _ in range(4):
        h = np.block([[h, h], [h, -h]])
    x = np.random.default_rng(0).standard_normal((5, 16))
    assert np.allclose(polytope.hadamard(x), x @ h / 4)


def test_near_vectors_match_all_pairs(spark, monkeypatch):
    draw = np.random.default_rng(2)
    rows = []
    for _ in range(30):
        base = draw.standard_normal(24)
        for noise in (0, 0, 0.05, 0.1, 0.3, 1.0):
            rows.append((len(rows), (base + noise * draw.standard_normal(24)).tolist()))
    hot = draw.standard_normal(24)
    rows += [(len(rows) + i, (hot + 0.05 * draw.standard_normal(24)).tolist()) for i in range(80)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 24, [None] * 24, [nan, *[1.0] * 23], [inf, *[1.0] * 23], [1.0, 2.0], [2.0, 4.0], [1e300, 2e300], [0.0, -0.0, 1e-300]]
    rows += [(len(rows) + i, v) for i, v in enumerate(odd)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    counts, roots = brute_vectors(rows)
    for block in (2048, 30):
        monkeypatch.setattr(polytope, "BLOCK", block)
        found = {r["vec_id"]: r for r in polytope.near_duplicates(frame.repartition(5)).collect()}
        assert set(found) == set(counts)
        assert all(found[k]["n_links"] <= counts[k] for k in counts)
        assert sum(r["n_links"] for r in found.values()) >= 0.97 * sum(counts.values())
        assert sum(found[k]["component_id"] == roots[k] for k in roots) >= 0.97 * len(roots)
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())


@pytest.mark.parametrize("other", [32, 63])
def test_vectors_of_close_lengths_never_meet(spark, other):
    draw = np.random.default_rng(6)
    rows = [(i, draw.standard_normal(64 if i % 2 else other)) for i in range(3000)]
    rows += [(3000 + i, rows[i][1] * 2 + 0.01 * draw.standard_normal(len(rows[i][1]))) for i in range(40)]
    few, many = ([v for _, v in rows if len(v) == size] for size in (other, 64))
    own = [polytope.buckets(polytope.unit(np.stack(v)), 2, seed=len(v[0])) for v in (few, many)]
    assert not len(np.intersect1d(*own))
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in rows], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r for r in polytope.near_duplicates(frame).collect()}
    assert len(found) == 3040 and sum(r["n_links"] for r in found.values()) == 80
    assert all(found[3000 + i]["component_id"] == i for i in range(40))


def test_equal_bucket_numbers_of_other_lengths():
    one, two = (np.eye(1, n).astype("<f8").tobytes() for n in (3, 4))
    rows = [(5, 0, 0, key, 1, vector, [5]) for key, vector in enumerate((one, two, one, two))]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
    columns = [pa.array(list(v), k) for v, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    made = next(polytope._linked(iter([pa.RecordBatch.from_arrays(columns, names=list("abcdefg"))]), 0.9)).to_pylist()
    assert [(r["key"], r["other"]) for r in made if r["other"] is not None] == [(0, 2), (1, 3)]
    assert {r["key"]: r["links"] for r in made if r["other"] is None} == {k: 1 for k in range(4)}


def pairs_at(alike, count, dimensions, seed):
    draw = np.random.default_rng(seed)
    a, b = draw.standard_normal((2, count, dimensions))
    a = polytope.unit(a)
    b = polytope.unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    return a, alike * a + np.sqrt(1 - alike**2) * b


@pytest.mark.parametrize("dimensions", [2, 3, 24, 64])
@pytest.mark.parametrize("count", [2_000, 1_000_000, 60_000_000])
def test_recall_does_not_fall_with_the_count(count, dimensions):
    length, tables = polytope.layout(count, dimensions)
    if dimensions == 64:  # 2, 3 and 4 rotations
        assert length == {2_000: 2, 1_000_000: 3, 60_000_000: 4}[count]
    a, b = (polytope.buckets(x, length, tables, seed=dimensions) for x in pairs_at(0.9, 1500, dimensions, 7))
    met = np.array([len(np.intersect1d(x, y)) > 0 for x, y in zip(a, b, strict=True)])
    assert met.mean() >= polytope.RECALL


def test_pairs_far_apart_are_still_found():
    length, tables = polytope.layout(2_000, 64, alike=0.1)
    a, b = (polytope.buckets(x, length, tables, seed=64) for x in pairs_at(0.1, 300, 64, 8))
    assert np.mean([len(np.intersect1d(x, y)) > 0 for x, y in zip(a, b, strict=True)]) >= polytope.RECALL


@pytest.mark.parametrize("rotations", [3, 4])
def test_near_vectors_with_more_rotations(spark, monkeypatch, rotations):
    monkeypatch.setattr(polytope, "rotations_for", lambda *_: rotations)
    a, b = pairs_at(0.901, 400, 64, 9)
    rows = [(2 * i + j, v.tolist()) for i, pair in enumerate(zip(a, b, strict=True)) for j, v in enumerate(pair)]
    found = polytope.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    counts, _ = brute_vectors(rows)
    assert sum(r["n_links"] for r in found) >= polytope.RECALL * sum(counts.values())
    assert all(r["n_links"] <= counts[r["vec_id"]] for r in found)


def test_vectors_without_keys_and_without_rows(spark):
    rows = [(None, [1.0, 2.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0]), (4, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("key", F.lit("clash"))
    found = sorted(polytope.near_duplicates(frame).collect(), key=lambda r: (r["vec_id"] is None, r["vec_id"]))
    assert [(r["vec_id"], r["n_links"], r["component_id"]) for r in found] == [(3, 2, 3), (3, 2, 3), (4, 2, 3), (None, 0, None)]
    assert polytope.near_duplicates(frame.where("false")).count() == 0


def test_vector_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, sf, "embeddings").collect()]
    counts, _ = brute_vectors(rows)
    found = {r["vec_id"]: r["n_links"] for r in queries.op9(spark, sf).collect()}
    assert set(found) == set(counts) and sum(found.values()) >= 0.9 * sum(counts.values())
    assert all(found[k] <= counts[k] for k in counts)
