"""The trie of conversations against a plain recursion over prefixes."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import llm_cases as cases
from closingbell.llm import prefix_tour as tour

SCHEMA = "conv_id long, turn long, role string, text string, depth int, part string, said int, n long"


def said(role, text):
    role, text = role or "", text or ""
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def shared_of(c):
    return zlib.crc32(str(c).encode()) % 6


def truncated(c, n):
    return c - int(np.fmod(c, n))


def brute(rows, rebuilt=True):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, said(role, text), (role or "", text or "")))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = shared_of(c) if rebuilt else 0
        whole[c] = tuple(own.get(truncated(c, 100), [])[:h] + turns[h:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children, out = {}, []
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)

    def sums(key):
        below = [sums(k) for k in children.get(key, [])]
        saved = (len(members[key]) - 1) * len(key[-1][1]) if key else 0
        leaves = sum(x[0] for x in below) if below else 1
        saved += sum(x[1] for x in below)
        ends = ",".join(str(c) for c in sorted(members[key]) if whole[c] == key)
        out.append((
            min(members[key]), len(key), min(members[key[:-1]]) if key else None, len(members[key]), len(below),
            leaves, saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
        return leaves, saved

    if members:
        sums(())
    return out


def frame(session, rows):
    return session.createDataFrame([(*r, 1, "p", 2, 3) for r in rows], SCHEMA).repartition(3)


def family(df):
    return df, F.crc32(F.col("conv_id").cast("string")) % 6, F.col("conv_id") - F.col("conv_id") % 100


def some_rows():
    rng = random.Random(5)
    rows = []
    for c in [*rng.sample(range(-150, 500), 120), 0, 100, 200]:
        for t in range(rng.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, t, rng.choice(["user", "bot"]), rng.choice(["", "a", "bb", "ccc"])))
    rows += [(7, None, "user", "first"), (7, 0, None, None), (7, 0, None, None), (7, 0, "", ""), (None, 0, "user", "x")]
    rows += [(41, t, "user", "same") for t in range(60)] + [(42, t, "user", "same") for t in range(60)]
    rows += [(55, 3, "user", "again")] * 40 + [(2**63 - 1, 0, "user", "a"), (-(2**63), 0, "user", "a")]
    return list(dict.fromkeys(rows[:-42])) + rows[-42:]


@pytest.mark.parametrize("block_arcs, chunk", [(tour.BLOCK_ARCS, tour.CHUNK), (64, 50)])
def test_tree_against_brute_force(session, block_arcs, chunk):
    rows = some_rows()
    found = tour.prefix_tree(*family(frame(session, rows)), block_arcs=block_arcs, chunk=chunk).collect()
    assert cases.ordered(found) == cases.ordered(brute(rows))


def test_tree_as_it_is(session):
    rows = some_rows()
    found = tour.prefix_tree(frame(session, rows)).collect()
    assert cases.ordered(found) == cases.ordered(brute(rows, rebuilt=False))


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(3, None, None, None)]])
def test_tree_of_little(session, rows):
    found = tour.prefix_tree(*family(frame(session, rows))).collect()
    assert cases.ordered(found) == cases.ordered(brute(rows))


def test_list_rank_of_a_shuffled_list(session):
    rng = random.Random(2)
    names = [(rng.randrange(10**9), rng.randrange(100)) for _ in range(3000)]
    names = list(dict.fromkeys(names))
    rows = [(*x, *y) for x, y in zip(names, names[1:])] + [(*names[-1], None, None)]
    rng.shuffle(rows)
    links = session.createDataFrame(rows, "a long, b long, c long, d long").repartition(5)
    found = {(r["a"], r["b"]): r["pos"] for r in tour.list_rank(links, len(rows), block_arcs=300).collect()}
    assert found == {x: i for i, x in enumerate(names)}


def test_contract_gives_heads_and_ends():
    rows = {"a": [1, 2, 3, 9], "b": [0, 0, 0, 0], "c": [2, 3, 50, None], "d": [0, 0, 1, None], "steps": [1, 4, 2, 1]}
    out = tour.contract(pa.table({k: pa.array(v, pa.int64()) for k, v in rows.items()})).to_pylist()
    assert [(r["head_a"], r["off"]) for r in out] == [(1, 0), (1, 1), (1, 5), (9, 0)]
    assert (out[0]["c"], out[0]["d"], out[0]["steps"]) == (50, 1, 7)
    assert (out[3]["c"], out[3]["steps"], out[1]["steps"]) == (None, 1, None)


def test_digest_pieces_carry_over_batches():
    node = lambda n: pa.array(n, pa.int64())
    rows = [(1, 0, 3), (1, 0, 40), (1, 0, 41), (1, 2, 5), (6, 0, 6)]
    batch = pa.record_batch([node(x) for x in zip(*rows)], ["conv_id", "depth", "member"])
    for size in (1, 2, 5):
        cut = [batch.slice(i, size) for i in range(0, 5, size)]
        found = [r for b in tour._digests(tour._pieces(iter(cut))) for r in b.to_pylist()]
        wanted = [(1, 0, "3,40,41"), (1, 2, "5"), (6, 0, "6")]
        assert [tuple(r.values()) for r in found] == [(c, d, hashlib.sha256(t.encode()).hexdigest()) for c, d, t in wanted]
