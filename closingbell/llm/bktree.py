"""SimHash near-duplicates by BK-trees over shards of fingerprints.

Fingerprints are folded to the distinct ones first, so copies cost nothing further. Two that
differ in at most ``radius`` bits agree on some ``k - radius`` of k blocks of their bits, so a
fingerprint belongs to one shard for each such choice of blocks, and every link lies within a
shard. k follows from the number of distinct fingerprints, so shards stay small at any size.

A shard's fingerprints form a BK-tree (children keyed by their distance to the parent); its
members search the tree and follow only edges within ``radius`` of their own distance. Broadcasting
all trees would not be bounded, so a tree is sent with the shuffle to the tasks that search it. A
shard with more than ``shard_size`` members (many near copies) is cut into parts, and each pair of
parts is a block of its own: the tree of one, searched by the other. Trees of many blocks are built
and searched together, level by level, on arrays.

A block hands on each component of its links as a star, not its pairs; the stars are joined to
components on the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from closingbell.llm import common
from closingbell.llm.components import components

SHINGLE = 4
RADIUS = 4
SHARD_SIZE = 4096
USUAL_SHARD = 64
BLOCK_ROWS = 1 << 16
FRONTIER = 1 << 21


# -- fingerprints --------------------------------------------------------------------


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """Bits set in over half the hashes of the text's word shingles; 0 without words."""
    words = text.lower().split()  # bytes: only A-Z are lowered, only ASCII space splits
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = (ends - size)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :].tolist())], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK_ROWS):
        bits = np.unpackbits(hashes[at : at + BLOCK_ROWS].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _prints(batch: pa.RecordBatch, shingle: int) -> np.ndarray:
    data, offsets = common.text_bytes(batch["text"])
    raw, at = memoryview(data), offsets.tolist()
    return np.array([simhash(bytes(raw[a:b]), shingle) for a, b in zip(at, at[1:])], np.uint64).view(np.int64)


def _fingerprints(shingle: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "print": _prints(batch, shingle)})

    return found


def _printed_rows(shingle: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {"doc_id": batch["doc_id"], "print": _prints(batch, shingle), "row": batch["row"]}
            yield pa.RecordBatch.from_pydict(columns)

    return found


# -- BK-trees ------------------------------------------------------------------------


class Forest:
    """BK-trees over the distinct values of each tree, built level by level."""

    def __init__(self, tree: np.ndarray, value: np.ndarray):
        """``tree`` is sorted and numbers the trees from 0 on; ``value`` is uint64."""
        self.value = value
        new = np.ones(len(tree), bool)
        new[1:] = tree[1:] != tree[:-1]
        self.roots = np.flatnonzero(new)
        active = np.flatnonzero(~new)
        above = self.roots[tree[active]]
        edges, children = [], []
        while len(active):
            edge = above * 65 + np.bitwise_count(value[active] ^ value[above])
            order = np.argsort(edge, kind="stable")
            active, edge = active[order], edge[order]
            first = np.ones(len(edge), bool)
            first[1:] = edge[1:] != edge[:-1]
            edges.append(edge[first])
            children.append(active[first])
            above = active[first][np.cumsum(first) - 1][~first]  # the rest goes down to the new child
            active = active[~first]
        self.edge = np.concatenate([np.zeros(0, np.int64), *edges])
        self.child = np.concatenate([np.zeros(0, np.int64), *children])
        order = np.argsort(self.edge)
        self.edge, self.child = self.edge[order], self.child[order]

    def search(self, tree: np.ndarray, value: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) at a distance of at most ``radius``."""
        query, node = np.arange(len(tree)), self.roots[tree]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        while len(query):
            far = np.bitwise_count(value[query] ^ self.value[node]).astype(np.int64)
            near = far <= radius
            found.append((query[near], node[near]))
            low = np.searchsorted(self.edge, node * 65 + np.maximum(far - radius, 0))
            high = np.searchsorted(self.edge, node * 65 + np.minimum(far + radius, 64), side="right")
            at, owner = common.ranges(low, high - 1)
            query, node = query[owner], self.child[at]
        return tuple(np.concatenate(x) for x in zip(*found))


def _linked(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of the links a-b as stars around their smallest value."""
    values, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(values))
    while True:
        least = np.minimum(label[x], label[y])
        np.minimum.at(label, label[x], least)
        np.minimum.at(label, label[y], least)
        label = label[label]
        if (label[x] == label[y]).all():
            break
    while (label != label[label]).any():
        label = label[label]
    rest = np.flatnonzero(label != np.arange(len(values)))
    return values[rest], values[label[rest]]


def _block_links(rows: dict[str, np.ndarray], radius: int) -> pa.RecordBatch | None:
    """Links within some whole blocks, whose rows are sorted by block and role."""
    new = np.zeros(len(rows["print"]), bool)
    new[0] = True
    for name in ("combo", "shard", "one", "other"):
        new[1:] |= rows[name][1:] != rows[name][:-1]
    block = np.cumsum(new) - 1
    value = rows["print"].view(np.uint64)
    in_tree = rows["part"] == rows["one"]
    asks = rows["part"] == rows["other"]
    has_tree = np.bincount(block[in_tree], minlength=block[-1] + 1) > 0
    number = np.cumsum(has_tree) - 1
    forest = Forest(number[block[in_tree]], value[in_tree])
    asking = np.flatnonzero(asks & has_tree[block])
    sizes = np.bincount(number[block[in_tree]])
    todo = np.cumsum(sizes[number[block[asking]]]) // FRONTIER
    cuts = np.flatnonzero(np.diff(todo)) + 1
    a, b = [], []
    for part in np.split(asking, cuts):
        query, node = forest.search(number[block[part]], value[part], radius)
        x, y = value[part][query], forest.value[node]
        a.append(x[x != y])
        b.append(y[x != y])
    a, b = np.concatenate(a), np.concatenate(b)
    if not len(a):
        return None
    node, root = _linked(a, b)
    return pa.RecordBatch.from_pydict({"a": node.view(np.int64), "b": root.view(np.int64)})


def _links(radius: int):
    names = ("combo", "shard", "one", "other", "part", "print")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            rows = {name: batch[name].to_numpy() for name in names}
            if held is not None:
                rows = {name: np.concatenate([held[name], rows[name]]) for name in names}
            n = len(rows["print"])
            if n < BLOCK_ROWS:
                held = rows if n else None
                continue
            same = np.ones(n, bool)
            for name in names[:4]:
                same &= rows[name] == rows[name][-1]
            cut = n - int(np.argmin(same[::-1])) if not same.all() else 0  # the last block may go on
            if cut:
                if (out := _block_links({name: x[:cut] for name, x in rows.items()}, radius)) is not None:
                    yield out
            held = {name: x[cut:] for name, x in rows.items()}
        if held is not None and len(held["print"]):
            if (out := _block_links(held, radius)) is not None:
                yield out

    return found


# -- shards --------------------------------------------------------------------------


def block_choices(count: int, radius: int, usual: int = USUAL_SHARD) -> list[int]:
    """Masks, one of which two fingerprints within ``radius`` agree on; the more fingerprints, the
    more blocks and the more bits in a mask."""
    blocks = radius + 1
    while blocks < 2 * radius + 2:
        kept = 64 * (blocks - radius) // blocks
        if count <= usual << kept:
            break
        blocks += 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    bits = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(bits, blocks - radius)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def near_links(prints: DataFrame, radius: int, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Links (a, b) that join all distinct ``print`` values within ``radius``, as stars per block."""
    masks = block_choices(prints.count(), radius)
    choices = F.array(
        *(F.struct(F.lit(i).alias("combo"), F.col("print").bitwiseAND(F.lit(_signed(m))).alias("shard"))
          for i, m in enumerate(masks))
    )
    members = prints.select("print", F.explode(choices).alias("c")).select("print", "c.combo", "c.shard")
    sizes = members.groupBy("combo", "shard").agg(F.count("*").alias("n"))
    large = sizes.filter(F.col("n") > shard_size).withColumn("parts", F.ceil(F.col("n") / shard_size).cast("int"))
    members = members.join(large.drop("n"), ["combo", "shard"], "left")
    parts = F.coalesce("parts", F.lit(1))
    members = members.withColumn("part", F.pmod(F.xxhash64("print"), parts).cast("int")).withColumn(
        "with", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    block = members.select(
        "combo", "shard", F.least("part", "with").alias("one"), F.greatest("part", "with").alias("other"), "part", "print"
    )
    keys = ["combo", "shard", "one", "other"]
    return block.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_links(radius), "a long, b long")


def _grouped(docs: DataFrame, shingle: int, radius: int, shard_size: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, print) of every row, and the distinct prints with first (doc_id) and root."""
    printed = common.texts(docs).mapInArrow(_fingerprints(shingle), "doc_id long, print long")
    printed = common.stored(printed, "simhash-prints")
    prints = printed.groupBy("print").agg(F.min("doc_id").alias("first"))
    linked = components(near_links(prints.select("print"), radius, shard_size), "simhash-links")
    rooted = prints.join(linked, prints["print"] == linked["node"], "left")
    return printed, rooted.select("print", "first", F.coalesce("root", "print").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """SimHash and near-duplicate component of every document.

    Returns doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id that links of
    at most ``radius`` differing bits reach; a row for each row of ``docs``, repeated rows included.
    Texts are taken whole, A-Z in lower case; a text shorter than a shingle is one shingle, a null
    or empty one has fingerprint zero and is linked like any other. A null doc_id stays null and
    counts for a component only if it has no other. Columns other than doc_id and text are ignored.
    """
    printed, rooted = _grouped(docs, shingle, radius, shard_size)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("print", "component_id")
    return printed.join(named, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """One row of each near-duplicate component, with all columns of ``docs``.

    The row with the smallest doc_id stays; of rows that share it the one with the smallest
    fingerprint, and of equal ones the one that is least by digests of its text and of all its
    columns. Null ids stand behind all others.
    """
    printed, rooted = _grouped(docs, shingle, radius, shard_size)
    own = F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id")
    counted = printed.groupBy(*own, "print").agg(F.count("*").alias("n"))
    best = counted.join(rooted, "print").groupBy("root").agg(F.min(F.struct("no_id", "id", "print", "n")).alias("best"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        common.whole_rows(docs),
    )
    schema = StructType([*StructType.fromDDL("doc_id long, print long").fields, rows.schema["row"]])
    rows = rows.mapInArrow(_printed_rows(shingle), schema).select(*own, "print", "row")
    kept = rows.join(best.select("best.*"), ["no_id", "id", "print"])
    lone = kept.filter("n = 1").select("row")
    # rows that share id and fingerprint: one by its whole content, wherever it is read
    content = F.struct(F.sha2("text", 256), F.xxhash64("row"))
    repeated = kept.filter("n > 1").withColumn("text", common.column("text", "row").cast("string"))
    repeated = repeated.groupBy("no_id", "id", "print").agg(F.min_by("row", content).alias("row")).select("row")
    return lone.union(repeated).select(*(common.column(c, "row").alias(c) for c in docs.columns))
