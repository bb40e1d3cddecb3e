"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are partitioned by their number of distinct five-word shingles into classes that double in
size. For the class up to u shingles a document is cut into windows of 2u shingles, u apart, so an
item that stands in a document lies within one window of comparable size, however long the document
is. That gives each class a least Jaccard similarity, and from it the number of MinHash permutations
with which a contained item shares a minimum with its window in ``recall`` of the cases or more. A
window and an item that share a minimum are a candidate; candidates are verified by the exact
containment of the item's shingles in the whole document, compared as words. Items of fewer than five
words have one shingle, of all their words, and an index of that length of their own.

Documents are read once and never shuffled. The items are the query set: equal rows are folded with
their count, then read in blocks of about ``item_block`` rows and ``item_bytes`` bytes, and only one
block is held by a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from closingbell.llm import common

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.9999
ITEM_BLOCK = 20_000
ITEM_BYTES = 64 << 20

#: Letters, digits and all non-ASCII bytes make words; everything else parts them.
_PARTS = np.ones(256, bool)
_PARTS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_BLANKED = np.where(_PARTS, 0x20, common.LOWER).astype(np.uint8)


def _words(text: bytes) -> list[bytes]:
    return text.translate(_BLANKED.tobytes()).split()


def _shingled(words: list[bytes], n: int) -> set[bytes]:
    """Distinct shingles; fewer words than n are one shingle, no words none."""
    if not words:
        return set()
    return {b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


class Shingles:
    """Shingle hashes of all rows of a slice, in order, with their rows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, n: int):
        starts, ends, row = common.word_spans(_BLANKED[data], offsets)
        words = common.RangeHash(common.word_hashes(_BLANKED[data], starts, ends))
        count = np.bincount(row, minlength=len(offsets) - 1)
        begin = np.cumsum(count) - count
        at = np.arange(len(row))
        left = (begin + count)[row] - at
        whole = (left >= n) | (at == begin[row])  # a short text is one shingle
        at, row = at[whole], row[whole]
        self.hashes = words(at, at + np.minimum(n, left[whole]))
        self.row = row
        self.bounds = np.searchsorted(row, np.arange(len(offsets)))


def _permuted(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k-th permutation's 32-bit values."""
    odd = (k * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64 | 1
    return (((hashes ^ (hashes >> np.uint64(29))) * np.uint64(odd)) >> np.uint64(32)).astype(np.uint32)


@dataclass
class _Class:
    """Items of one size: for each permutation the sorted minima and whose they are."""

    width: int
    minima: list[tuple[np.ndarray, np.ndarray]]


def permutations(threshold: float, recall: float) -> int:
    """Enough that an item of a class shares a minimum with its window with probability recall.

    An item of q > u/2 shingles with threshold * q of them in a window of at most 2u has a Jaccard
    similarity of at least threshold * q / (2u + (1 - threshold) q), least at q = u/2.
    """
    least = threshold / (4 + 1 - threshold)
    return math.ceil(math.log(1 - recall) / math.log(1 - least))


class Index:
    """A block of items, ready to be searched for in documents."""

    def __init__(self, items: list[tuple[int | None, str | None]], n: int, threshold: float, recall: float):
        self.n, self.threshold, self.perms = n, threshold, permutations(threshold, recall)
        kept = [(i, _shingled(_words((text or "").encode()), n)) for i, text in items]
        self.items = [(i, shingles) for i, shingles in kept if shingles]
        texts = pa.array([text for (_, text), (_, s) in zip(items, kept) if s], pa.string())
        data, offsets = common.text_bytes(texts)
        found = Shingles(data, offsets, n)
        parts = [np.unique(found.hashes[a:b]) for a, b in zip(found.bounds, found.bounds[1:])]
        self.hashes = parts
        self.classes: list[_Class] = []
        sizes = np.array([max(0, (len(p) - 1)).bit_length() for p in parts], np.int64)
        for c in np.unique(sizes).tolist():
            members = np.flatnonzero(sizes == c)
            minima = []
            for k in range(self.perms):
                least = np.array([_permuted(parts[i], k).min() for i in members], np.uint32)
                order = np.argsort(least)
                minima.append((least[order], members[order]))
            self.classes.append(_Class(1 << c, minima))

    def candidates(self, found: Shingles) -> np.ndarray:
        """Pairs (row, item), without repeats, of windows and items that share a minimum."""
        if not len(found.hashes) or not self.items:
            return np.zeros((0, 2), np.int64)
        count = np.diff(found.bounds)
        windows = []
        for cls in self.classes:
            blocks = -(-count // cls.width)
            rows = np.repeat(np.arange(len(count)), blocks)
            within = np.arange(len(rows)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            starts = found.bounds[rows] + within * cls.width
            windows.append((starts, rows, np.flatnonzero(rows[1:] == rows[:-1])))
        pairs = []
        for k in range(self.perms):
            values = _permuted(found.hashes, k)
            for cls, (starts, rows, followed) in zip(self.classes, windows):
                least = np.minimum.reduceat(values, starts)
                joined = least.copy()
                joined[followed] = np.minimum(least[followed], least[followed + 1])
                known, members = cls.minima[k]
                low, high = np.searchsorted(known, joined), np.searchsorted(known, joined, side="right")
                hit = np.flatnonzero(high > low)
                if len(hit):
                    at, owner = common.ranges(low[hit], high[hit] - 1)
                    pairs.append(np.stack([rows[hit][owner], members[at]], axis=1))
        return np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)

    def contained(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(row, item, shared shingles) of the items that the rows contain."""
        found = Shingles(data, offsets, self.n)
        at_row, words = -1, set()
        for row, item in self.candidates(found).tolist():
            mine = found.hashes[found.bounds[row] : found.bounds[row + 1]]
            least = self.threshold * len(self.items[item][1])
            if np.isin(self.hashes[item], mine).sum() < least:
                continue
            if row != at_row:
                at_row = row
                words = _shingled(_words(data[offsets[row] : offsets[row + 1]].tobytes()), self.n)
            shared = len(self.items[item][1] & words)
            if shared >= least:
                yield row, item, shared


def _indexes(items: list, n: int, threshold: float, recall: float) -> list[Index]:
    """One index for each shingle length: ``n`` words, or all words of an item that has fewer."""
    by_length: dict[int, list] = {}
    for item in items:
        by_length.setdefault(min(n, len(_words((item[1] or "").encode()))), []).append(item)
    return [Index(some, length, threshold, recall) for length, some in sorted(by_length.items()) if length]


def _search(items: list[tuple[int | None, str | None, int]], n: int, threshold: float, recall: float):
    """``items``: (item_id, text, copies)."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexes = _indexes([((i, copies), text) for i, text, copies in items], n, threshold, recall)
        for batch in batches:
            data, offsets = common.text_bytes(batch["text"])
            ids = batch["doc_id"].to_pylist()
            rows = []
            for lo, hi in common.slices(offsets):
                part = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                for index in indexes:
                    for row, item, shared in index.contained(*part):
                        (item_id, copies), shingles = index.items[item]
                        rows.append((ids[lo + row], item_id, shared, len(shingles), copies))
            if rows:
                names = ("doc_id", "item_id", "shared", "shingles", "copies")
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names)

    return found


def _blocks(items: DataFrame, rows: int, size: int) -> Iterator[list[Row]]:
    """The distinct rows of the query set, with their ``copies``, in blocks of about ``rows`` rows and
    ``size`` bytes."""
    items = items.groupBy("item_id", "text").agg(F.count("*").alias("copies"))
    total = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-total[0] // rows), -(-total[1] // size))
    for i in range(blocks):
        part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i
        yield items.filter(part).collect()


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    item_block: int = ITEM_BLOCK,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """Items of which a document contains at least ``threshold`` of the distinct word shingles.

    ``items`` has item_id and text. Returns doc_id, item_id, shared and shingles (distinct ones of
    the item), a row for each row of ``docs`` and row of ``items`` that match; repeated rows match
    each on their own. Words are runs of letters, digits and non-ASCII characters, A-Z in lower
    case. An item of fewer words than a shingle is searched for by shingles of its own length, so it
    is found wherever its words stand side by side; one without words (null, empty) has none and
    matches nothing. Null ids stay null. Other columns are ignored.
    """
    docs = common.texts(docs)
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    result = None
    for block in _blocks(items, item_block, item_bytes):
        search = _search([tuple(row) for row in block], shingle, threshold, recall)
        found = docs.mapInArrow(search, "doc_id long, item_id long, shared long, shingles long, copies long")
        found = found.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")
        result = found if result is None else result.union(found)
    return result


def decontaminate(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, with all their columns, that contain no item.

    A document is told by its doc_id; rows that share one go together. A null doc_id is compared as
    a value of its own.
    """
    bad = contained_items(docs, items, **settings).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_bad"]), "left_anti")
