"""Near duplicates and containment search against brute force."""

import random

import numpy as np
import pytest

import llm_cases as cases
from closingbell.llm import bktree, components, containment
from test_repeats import collected


def test_forest_finds_all_within_radius():
    rng = np.random.default_rng(1)
    near = np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 12, 300).astype(np.uint64))
    value = np.unique(np.concatenate([rng.integers(0, 2**63, 200).astype(np.uint64), near ^ (np.uint64(1) << rng.integers(0, 12, 300).astype(np.uint64))]))
    rng.shuffle(value)
    tree = np.unique(np.sort(rng.integers(0, 3, len(value))), return_inverse=True)[1]
    query, node = bktree.Forest(tree, value).search(tree, value, 4)
    wanted = {(i, j) for i in range(len(value)) for j in range(len(value)) if tree[i] == tree[j] and int(value[i] ^ value[j]).bit_count() <= 4}
    assert set(zip(query.tolist(), node.tolist())) == wanted


@pytest.mark.parametrize("count", [0, 1000, 10**6, 10**9, 10**13])
def test_some_mask_agrees(count):
    rng = random.Random(count)
    masks = bktree.block_choices(count, 4)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        assert any(a & m == b & m for m in masks)


@pytest.mark.parametrize("shard_size", [4, bktree.SHARD_SIZE])
def test_near_duplicates(awkward, small, shard_size):
    for docs in (awkward, small):
        found = bktree.near_duplicates(docs, shard_size=shard_size).collect()
        assert cases.ordered(found) == cases.ordered(cases.near_groups(collected(docs)))


def test_keep_one(awkward):
    rows = collected(awkward)
    groups = cases.near_groups(rows)
    kept = bktree.keep_one(awkward)
    assert kept.columns == awkward.columns
    found = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert found == sorted({g[2] for g in groups if g[2] is not None})
    # components of null ids alone keep one row as well
    alone = {g[1] for g in groups if g[2] is None}
    assert sum(r["doc_id"] is None for r in kept.collect()) == len(alone)


def test_components_of_a_path_and_a_star(session):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 50)]
    links = session.createDataFrame(path + star + [(7, 7), (1, 0)], "a long, b long")
    found = {tuple(r) for r in components.components(links, "test-links").collect()}
    assert found == {(i, 0) for i in range(1, 41)} | {(100 + i, 100) for i in range(1, 50)}


def items_of(session, rows):
    return session.createDataFrame(rows, "item_id long, text string, doc_id int")


def test_containment_awkward(session, awkward):
    rows = cases.awkward_rows()
    words = rows[9][1].split()
    items = [(0, " ".join(words[5000:5030])), (1, " ".join(words[100:104])), (2, None), (3, ""), (4, "one"),
             (5, " ".join(words[200:230] + ["new"] * 3)), (6, " ".join(words[200:215] + ["x", "y", "z"] * 5)),
             (7, rows[0][1]), (7, rows[0][1]), (None, " ".join(words[-20:])), (8, " ".join(words[1000:1400])),
             (9, " ".join(w.upper() + "," for w in words[7000:7012]))]
    found = containment.contained_items(awkward, items_of(session, [(*i, 1) for i in items])).collect()
    assert cases.ordered(found) == cases.ordered(cases.contained(collected(awkward), items))
    assert {r["item_id"] for r in found} >= {0, 5, 8, 9}


def test_containment_in_blocks_of_items(session, small):
    benchmark = session.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    wanted = cases.ordered(cases.contained(collected(small), items))
    for settings in ({}, {"item_block": 7}):
        assert cases.ordered(containment.contained_items(small, benchmark, **settings).collect()) == wanted
    kept = containment.decontaminate(small, benchmark)
    assert kept.columns == small.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in small.collect()} - {r[0] for r in wanted}


def test_windows_of_one_size_share_minima():
    """Recall of the candidates alone, over items hidden in long random texts."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [rng.choices(vocabulary, k=4000) for _ in range(60)]
    items = [(i, " ".join(t[a : a + rng.randint(8, 70)])) for i, t in enumerate(texts) for a in [rng.randint(0, 3900)]]
    index = containment.Index(items, 5, 0.8, containment.RECALL)
    data, offsets = containment.common.text_bytes(containment.pa.array([" ".join(t) for t in texts]))
    pairs = {tuple(p) for p in index.candidates(containment.Shingles(data, offsets, 5)).tolist()}
    assert len({(i, i) for i in range(60)} & pairs) >= 59


def test_empty_tables(session, nothing, small):
    assert bktree.near_duplicates(nothing).collect() == []
    assert bktree.keep_one(nothing).collect() == []
    assert containment.contained_items(nothing, items_of(session, [(1, "a b c d e f", 1)])).collect() == []
    assert containment.contained_items(small, items_of(session, [])).collect() == []
    assert containment.decontaminate(small, items_of(session, [])).count() == small.count()


def test_equal_items_are_folded_before_they_are_cut(session, small):
    text = "one text of several words that a document holds as a whole here"
    items = items_of(session, [(1, text, 0)] * 50 + [(2, text, 0), (1, "another", 0), (None, None, 0), (None, None, 0)])
    blocks = list(containment._blocks(items.select("item_id", "text"), 7, 1 << 20))
    assert sorted((r["item_id"] or 0, r["copies"]) for b in blocks for r in b) == [(0, 2), (1, 1), (1, 50), (2, 1)]
    docs = session.createDataFrame([(5, f"Before it. {text}, and after it.")], "doc_id long, text string")
    for settings in ({}, {"item_block": 2}):
        found = containment.contained_items(docs, items, **settings).collect()
        assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(5, 1)] * 50 + [(5, 2)]


def test_short_items_are_found_inside_documents(session):
    docs = [(1, "before it alpha beta gamma delta epsilon and after"), (2, "alpha beta"), (3, "Alpha; beta gamma-DELTA!"), (4, "one")]
    items = [(10, "alpha beta gamma delta"), (11, "alpha beta gamma delta epsilon"), (12, "gamma"), (13, "beta alpha"), (14, "one"), (15, " ")]
    found = containment.contained_items(session.createDataFrame(docs, "doc_id long, text string"), items_of(session, [(*i, 1) for i in items])).collect()
    assert cases.ordered(found) == cases.ordered(cases.contained(docs, items))
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 10), (3, 10), (1, 11), (1, 12), (3, 12), (4, 14)}
