"""Hard negatives from candidate lists that the anchors of a cluster share.

Anchors are dealt to blocks of bounded size and clustered by angle inside each block. Candidates are
dealt to shards of bounded size, whatever their labels. In the task of a block and a shard every cluster
sorts the shard's candidates once by an upper bound that holds for all its members: a member
lies within the cluster's angle of the centroid, so its score for a candidate is at most
``|member| |candidate| cos(max(0, angle(candidate, centroid) - cluster angle))``. All members walk
that one list; a member leaves when the bound of the rest certifies that nothing behind can
change what it holds, and the walk ends with its last member. The lists of a block's shards are
merged after that.

The walk runs twice: for the positives (rows of the anchor's label), then for the negatives, whose range
of scores is set by each positive's. The anchors are a stated query set that meets all rows in
blocks; a block's anchors go to every shard, a shard's rows to every block.

Defined results: rows with a null label, a null vector or a null or non-finite component take no
part; a shorter vector counts as zero in the components it lacks (an empty one scores zero);
components are floor(scale * x), held within +-2^22; rows with a null id are candidates that come
after all ids among equal scores; repeated rows are rows of their own, and an anchor leaves out one
row equal to itself; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from closingbell.llm.common import stored

#: Anchors in a block and candidates in a shard, in expectation.
BLOCK_ANCHORS, SHARD_ROWS = 4096, 8192
#: Anchors in a cluster (on average), rounds of clustering, candidates that a step of a walk scores.
CLUSTER_ANCHORS, ROUNDS, STEP = 16, 4, 256
LIMIT = 1 << 22
TASKS = 20_000
#: Angles are known to about 1e-8; the bound is raised by more.
SLACK = 1e-6

_FOUND = [("anchor", pa.int64()), ("id", pa.int64()), ("no_id", pa.bool_()), ("score", pa.int64())]
_POSITIVES = pa.schema([*_FOUND, ("same", pa.bool_())])
_NEGATIVES = pa.schema([*_FOUND, ("band", pa.int64())])
POSITIVES = "anchor long, id long, no_id boolean, score long, same boolean"
NEGATIVES = "anchor long, id long, no_id boolean, score long, band long"


def prepared(vectors: DataFrame, label: Column | None = None, scale: int = 256) -> DataFrame:
    """id, label and whole-number components of the rows that take part."""
    value = lambda x: x.cast("double")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(value(x)) == float("inf")))
    whole = lambda x: F.floor(F.least(F.greatest(value(x) * scale, F.lit(-LIMIT)), F.lit(LIMIT))).cast("int")
    taken = vectors.select(
        F.col("vec_id").cast("long").alias("id"),
        (F.col("label") if label is None else label).cast("long").alias("label"),
        "embedding",
    ).filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    return taken.select("id", "label", F.transform("embedding", whole).alias("comps"))


# -- inside a task -----------------------------------------------------------------------


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """One row of components per vector, zeros behind the end of shorter ones."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), np.float64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact whole-number inner products of all rows of ``a`` with all of ``b``."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _angles(units: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centre, -1, 1))


def _units(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norms = np.sqrt((rows * rows).sum(axis=1))
    return rows / np.where(norms > 0, norms, 1)[:, None], norms


def clusters_of(anchors: np.ndarray, size: int = CLUSTER_ANCHORS) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Members, centroid and largest angle to it, of each cluster of a block's anchors."""
    units, _ = _units(anchors)
    count = max(1, len(units) // size)
    centres = units[np.linspace(0, len(units) - 1, count).astype(np.int64)]
    for _ in range(ROUNDS):
        mine = np.argmax(units @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, mine, units)
        fresh, norms = _units(sums)
        centres = np.where(norms[:, None] > 0, fresh, centres)
    mine = np.argmax(units @ centres.T, axis=1)
    out = []
    for cluster in np.unique(mine):
        members = np.flatnonzero(mine == cluster)
        angle = float(_angles(units[members], centres[cluster]).max())
        # an anchor of zeros has no angle: its scores are all zero, within any bound of its norm
        out.append((members, centres[cluster], angle))
    return out


def shared_list(units: np.ndarray, norms: np.ndarray, centre: np.ndarray, angle: float) -> tuple[np.ndarray, np.ndarray]:
    """Candidates by falling bound, and the bound of each for a member of norm one."""
    bound = norms * (np.cos(np.maximum(0, _angles(units, centre) - angle)) + SLACK)
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


class _Best:
    """The best ``k`` rows shown so far to each of several searches; lower rows first among equals."""

    def __init__(self, searches: int, k: int):
        self.k = k
        self.search, self.score, self.row = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(searches, np.iinfo(np.int64).min)

    def add(self, search: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        if not len(search):
            return
        search, score, row = (np.concatenate(x) for x in ((self.search, search), (self.score, score), (self.row, row)))
        order = np.lexsort((row, -score, search))
        search = search[order]
        new = np.ones(len(search), bool)
        new[1:] = search[1:] != search[:-1]
        first = np.flatnonzero(new)
        place = np.arange(len(search)) - np.repeat(first, np.diff(np.append(first, len(search))))
        held = place < self.k
        self.search, self.score, self.row = search[held], score[order][held], row[order][held]
        full = place[held] == self.k - 1
        self.floor[self.search[full]] = self.score[full]


def walk(anchors, own, lists, score_range, k, wanted):
    """(search, score, row) of the best ``k`` candidates of every search, and how many were scored for it.

    ``anchors`` are vectors, ``own[s]`` is the anchor of search s; ``lists`` has the candidates and, for
    each cluster, its members, order and bounds. A search takes scores within ``score_range[s]``;
    ``wanted(searches, candidates)`` says which pairs count at all.
    """
    scored, found = np.zeros(len(own), np.int64), []
    by_anchor = np.argsort(own, kind="stable")
    starts = np.searchsorted(own[by_anchor], np.arange(len(anchors) + 1))
    norms = np.sqrt((anchors * anchors).sum(axis=1))
    for members, order, bound in lists.clusters:
        searches = np.concatenate([by_anchor[starts[m] : starts[m + 1]] for m in members])
        best, live = _Best(len(searches), k), np.arange(len(searches))
        for at in range(0, len(order), STEP):
            # what stands from here on scores at most this much: enough for the range, and for the
            # last one held, or as much with a lower row?
            mine = searches[live]
            low, high = score_range[0][mine], score_range[1][mine]
            going = (norms[own[mine]] * bound[at] >= np.maximum(low, best.floor[live])) & (low <= high)
            live, mine, low, high = live[going], mine[going], low[going], high[going]
            if not len(live):
                break
            some = order[at : at + STEP]
            there, which = np.unique(own[mine], return_inverse=True)
            scores = _products(anchors[there], lists.vectors[some])[which]
            scored[mine] += len(some)
            good = (scores >= np.maximum(low, best.floor[live])[:, None]) & (scores <= high[:, None])
            good &= wanted(mine, some)
            search, candidate = np.nonzero(good)
            best.add(live[search], scores[search, candidate], some[candidate])
        found.append((searches[best.search], best.score, best.row))
    return [np.concatenate(x) for x in zip(*found)], scored


class Lists:
    """A shard's candidates, and each cluster's list over them."""

    def __init__(self, vectors: np.ndarray, anchors: np.ndarray):
        self.vectors = vectors
        units, norms = _units(vectors)
        self.clusters = []
        for members, centre, angle in clusters_of(anchors):
            order, bound = shared_list(units, norms, centre, angle)
            self.clusters.append((members, order, bound))


def _table(columns: dict, schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(columns[name], kind) for name, kind in zip(schema.names, schema.types)], schema=schema)


def _ordered(rows: pa.Table) -> pa.Table:
    """As equal scores are ordered: by id, rows without an id last."""
    return rows.sort_by([("no_id", "ascending"), ("id", "ascending")])


def _search(rows: pa.Table, anchors: pa.Table, own, score_range, k, other: bool, schema: pa.Schema, more) -> pa.Table:
    """One block over one shard; ``other``: candidates of other labels instead of the same."""
    if not rows.num_rows or not anchors.num_rows or not len(own):
        return schema.empty_table()
    widths = [side["comps"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max() for side in (rows, anchors)]
    vectors, queries = (_matrix(side["comps"], max(1, *widths)) for side in (rows, anchors))
    label, mine = rows["label"].to_numpy(), anchors["label"].to_numpy()
    wanted = lambda s, c: (mine[own[s]][:, None] != label[c]) == other
    (search, score, row), _ = walk(queries, own, Lists(vectors, queries), score_range, k, wanted)
    at = own[search]
    found = {
        "anchor": anchors["place"].to_numpy()[at],
        "id": rows["id"].take(row),
        "no_id": rows["no_id"].take(row),
        "score": score,
    }
    return _table(found | more(search, at, row, vectors, queries), schema)


def _positives(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        rows = _ordered(rows)
        n = anchors.num_rows
        limits = np.iinfo(np.int64)

        def same(search, at, row, vectors, queries):
            ids = pc.equal(rows["id"].take(row), anchors["id"].take(at))
            equal = (queries[at] == vectors[row]).all(axis=1)
            return {"same": pc.fill_null(ids, False).to_numpy() & equal}

        # one more than wanted, since the anchor itself may be among them
        return _search(rows, anchors, np.arange(n), (np.full(n, limits.min), np.full(n, limits.max)), k + 1, False, _POSITIVES, same)

    return run


def _negatives(k: int, share: tuple[int, int]):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        rows = _ordered(rows)
        bands = anchors["bands"].combine_chunks()
        own = np.repeat(np.arange(anchors.num_rows), bands.value_lengths().to_numpy(zero_copy_only=False))
        high = bands.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        low = -((-share[0] * high) // share[1])
        return _search(rows, anchors, own, (low, high), k, True, _NEGATIVES, lambda search, *_: {"band": high[search]})

    return run


# -- the jobs ----------------------------------------------------------------------------


def _searched(candidates: DataFrame, anchors: DataFrame, blocks: int, shards: int, run, schema: str) -> DataFrame:
    """``run`` over every shard and block of anchors."""
    every = lambda name, n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    rows = candidates.select("*", every("block", blocks))
    asked = anchors.select("*", every("shard", shards)).toDF(*anchors.columns, "shard")  # columns of its own
    # a task for each pair, up to a number that a scheduler likes
    tasks = min(blocks * shards, TASKS)
    asked, rows = (side.repartition(tasks, "block", "shard") for side in (asked, rows))
    pairs = asked.groupBy("block", "shard").cogroup(rows.groupBy("block", "shard"))
    return pairs.applyInArrow(lambda a, b: run(b, a), schema)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 5,
    share: tuple[int, int] = (80, 100),
    block_anchors: int = BLOCK_ANCHORS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on ``id``, ``label`` replaces the column of that name. Scores are whole
    numbers; higher ones come first, ties by smaller id. An anchor's positives are its first other rows
    of the same label; the negatives of a positive are the first rows of other labels whose score
    lies between ``share`` of the positive's and the positive's own.
    """
    rows = stored(prepared(vectors, label).withColumn("place", F.monotonically_increasing_id()), "vectors")
    counts = rows.agg(F.count("*").alias("n"), F.count_if(anchors).alias("a")).first()
    blocks, shards = max(1, -(-counts["a"] // block_anchors)), max(1, -(-counts["n"] // shard_rows))
    dealt = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "place"), F.lit(n)).cast("int")
    candidates = rows.select(
        dealt(shards, 1).alias("shard"), "id", F.col("id").isNull().alias("no_id"), "label", "comps"
    )
    asked = rows.filter(anchors).select(dealt(blocks, 2).alias("block"), "place", "id", "label", "comps")

    near = _searched(candidates, asked, blocks, shards, _positives(positives), POSITIVES)
    order = [F.desc("score"), "no_id", "id"]
    ranked = _ranked(near, ["anchor"], positives + 1, [*order, "same"])
    # of the rows equal to the anchor one is the anchor itself: the last of them goes, for they tie
    itself = ranked.filter("same").groupBy("anchor").agg(F.max("rank").alias("itself"))
    others = ranked.join(itself, "anchor", "left").filter("itself IS NULL OR rank <> itself")
    others = others.withColumn("rank", F.col("rank") - F.when(F.col("rank") > F.col("itself"), 1).otherwise(0))
    others = stored(others.filter(F.col("rank") <= positives).select("anchor", "rank", "id", "no_id", "score"), "positives")

    bands = others.groupBy("anchor").agg(F.collect_set("score").alias("bands"))
    ranging = asked.join(bands, F.col("place") == F.col("anchor")).drop("anchor")
    far = _searched(candidates, ranging, blocks, shards, _negatives(negatives, share), NEGATIVES)
    worst = _ranked(far, ["anchor", "band"], negatives, order)

    known = lambda of: F.when(~F.col(f"{of}.no_id"), F.col(f"{of}.id"))
    found = others.alias("p").join(
        worst.alias("n"), (F.col("p.anchor") == F.col("n.anchor")) & (F.col("p.score") == F.col("n.band"))
    )
    named = found.join(asked.select(F.col("place"), F.col("id").alias("anchor_id")), F.col("p.anchor") == F.col("place"))
    return named.select(
        "anchor_id",
        known("p").alias("positive_id"),
        F.col("n.rank").cast("int").alias("rank"),
        known("n").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("n.score").alias("negative_score"),
    )


def _ranked(found: DataFrame, keys: list[str], k: int, order: list) -> DataFrame:
    """The first ``k`` of each key, numbered; a key has at most a few rows from each shard."""
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)
