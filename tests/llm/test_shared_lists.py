"""Hard negatives against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import llm_cases as cases
from closingbell.llm import shared_lists

SCHEMA = "vec_id long, embedding array<double>, label int, place int, block string, shard int, id string, comps int"


def brute(rows, every=100, k=5):
    live = []
    for i, (d, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if d is not None and d % 7 == 0 else label
        live.append((i, d, [max(-(2**22), min(2**22, math.floor(256 * x) if abs(x) < 1e12 else int(math.copysign(2**30, x)))) for x in vector], label))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for i, d, a, label in live:
        if d is None or d % every:
            continue
        scores = [(sum(x * y for x, y in zip(a, b)), e, m == label) for j, e, b, m in live if j != i]
        for p, positive, _ in sorted((s for s in scores if s[2]), key=order)[:k]:
            found = sorted((s for s in scores if not s[2] and 80 * p <= 100 * s[0] <= 100 * p), key=order)[:k]
            out += [(d, positive, rank, n, p, s) for rank, (s, n, _) in enumerate(found, 1)]
    return out


def frame(session, rows):
    return session.createDataFrame([(*r, 1, "b", 2, "i", 3) for r in rows], SCHEMA).repartition(3)


def query(df, **settings):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return shared_lists.hard_negatives(df, F.col("id") % 100 == 0, label, **settings).collect()


def some_rows(n=700, seed=4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = []
    for i in range(n):
        vector = [x + rng.gauss(0, 0.4) for x in rng.choice(centres)]
        rows.append((i, vector, rng.randrange(4)))
    same = rows[0][1]
    rows += [(n + i, same, i % 3) for i in range(40)]  # many equal scores
    rows += [(100, same, 1)] * 3 + [(200, same, 1), (200, rows[5][1], 1)]  # repeated ids and rows
    rows += [(None, same, 0), (None, same, 2), (None, rows[3][1], 1)]
    rows += [(900, None, 1), (901, [1.0, None], 1), (902, [math.nan] * 8, 1), (903, [math.inf] * 8, 1), (904, same, None)]
    rows += [(1000, [], 1), (1100, [0.0] * 8, 2), (1200, same[:3], 2), (1300, [1e300, -1e300] + [0.0] * 6, 0), (-100, same, 3)]
    return rows


@pytest.mark.parametrize("settings", [{}, {"block_anchors": 5, "shard_rows": 60}])
def test_against_brute_force(session, settings):
    rows = some_rows()
    found = query(frame(session, rows), **settings)
    assert len(found) > 50
    assert cases.ordered(found) == cases.ordered(brute(rows))


def test_few_rows_and_none(session):
    assert query(frame(session, [])) == []
    rows = [(100, [1.0, 2.0], 1)]
    assert query(frame(session, rows)) == []
    rows += [(1, [1.0, 2.0], 1), (2, [1.0, 1.9], 2)]
    assert cases.ordered(query(frame(session, rows))) == cases.ordered(brute(rows)) != []


def test_walks_end_early_and_hold_the_best():
    """On clustered vectors a list is left before its end, and nothing behind was better."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    rows = np.floor(256 * (np.repeat(centres, 200, axis=0) + 0.05 * rng.normal(size=(8000, 16))))
    anchors = rows[::160].copy()
    own = np.arange(len(anchors))
    wide = np.full(len(anchors), -(2**62)), np.full(len(anchors), 2**62)
    everything = lambda s, c: np.ones((len(s), len(c)), bool)
    (search, score, row), scored = shared_lists.walk(anchors, own, shared_lists.Lists(rows, anchors), wide, 5, everything)
    products = (anchors @ rows.T).astype(np.int64)
    for s in own:
        best = sorted(range(len(rows)), key=lambda r: (-products[s, r], r))[:5]
        assert sorted(row[search == s]) == sorted(best)
    assert scored.mean() < 0.5 * len(rows)
