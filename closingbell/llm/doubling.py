"""Substring dedup by level-wise doubling.

Windows of a short length are judged first: those that stand in one document alone are out. Where two
that follow each other are left, they make a window of twice the length, which is judged in turn, and
so on up to ``window`` words (4, 8, 13). At the last length each window learns the first document
that holds it, and its words are removed in all later ones. A longer window can repeat only where
windows of this length do, and its words are covered by them, so no candidate is left behind it.

A level sends the hash of every distinct candidate of a group of documents, packed, to the slot of its
range (``keyed_slots``) and gets a bit back for each: whether it stands in another document, at the
last level in an earlier one than the first of this group. Texts are moved once, to a group by a
hash of doc_id and text, and that exchange is read again by each level. Inner levels compare 32 bits
within a slot, which can only let more candidates through; the last compares 96 there, and slots
are ranges of a 64-bit hash that grow in number with the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from closingbell.llm import common, keyed_slots

WINDOW, START = 13, 4
KEY_BYTES = 4

SENT = "chunk int, level int, slot int, keys binary, many binary, checks binary, docs binary, nulls binary"
ANSWER = "chunk int, level int, slot int, told binary"
_SENT = pa.schema([(x.split()[0], pa.int32() if x.split()[1] == "int" else pa.binary()) for x in SENT.split(", ")])
_ANSWER = pa.schema([(x.split()[0], pa.int32() if x.split()[1] == "int" else pa.binary()) for x in ANSWER.split(", ")])
REMOVED = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def levels(window: int, start: int = START) -> list[int]:
    """The lengths that are judged: from ``start``, doubled, up to the window."""
    found = [min(start, window)]
    while found[-1] < window:
        found.append(min(2 * found[-1], window))
    return found


class _Group:
    """The words of a group of documents, as one sequence; rows are followed by nothing of others."""

    def __init__(self, table: pa.Table, window: int):
        data, self.offsets = common.text_bytes(table["text"])
        self.data, hashes, rows, bounds = data, [], [], []
        for lo, hi in common.slices(self.offsets):
            part, at = data[self.offsets[lo] : self.offsets[hi]], self.offsets[lo : hi + 1] - self.offsets[lo]
            starts, ends, row = common.word_spans(part, at)
            hashes.append(common.word_hashes(part, starts, ends))
            rows.append(row + lo)
        self.row = np.concatenate([np.zeros(0, np.int64), *rows])
        self.bounds = np.searchsorted(self.row, np.arange(table.num_rows + 1))
        self.range_hash = common.RangeHash(np.concatenate([np.zeros(0, np.uint64), *hashes]))
        self.size = np.diff(self.bounds)
        # words from each one to its row's end, and whether the row has a window at all
        self.ahead = self.bounds[self.row + 1] - np.arange(len(self.row))
        self.long = self.size[self.row] >= window
        ids = table["doc_id"]
        self.null = pc.is_null(ids).to_numpy(zero_copy_only=False)
        self.doc = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.lexsort((self.doc, self.null))
        new = np.ones(len(order), bool)
        new[1:] = (self.doc[order][1:] != self.doc[order][:-1]) | (self.null[order][1:] != self.null[order][:-1])
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.cumsum(new) - 1

    def starts(self, length: int) -> np.ndarray:
        """Where windows of the length begin, in rows that are long enough at all."""
        return np.flatnonzero(self.long & (self.ahead >= length))

    def hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        return self.range_hash(at, at + length)


def _checks(group: _Group, at: np.ndarray, length: int) -> np.ndarray:
    """A second hash of each window, from those of its halves."""
    half = length // 2
    return common.mix(group.range_hash(at, at + half) * np.uint64(5) + group.range_hash(at + half, at + length))


def _candidates(group: _Group, lengths: list[int], answers: pa.Table, upto: int, bits: int) -> np.ndarray:
    """Starts of the windows to be judged at level ``upto``, from the answers to those before it."""
    at = group.starts(lengths[0])
    for level, length in enumerate(lengths[:upto]):
        keys, index = np.unique(group.hashes(at, length), return_inverse=True)
        mine = answers.filter(pc.equal(answers["level"], level))
        alive = np.zeros(len(group.row) + 1, bool)
        alive[at[keyed_slots.answered_flags(mine, "told", keys, bits)[index]]] = True
        # both halves (or two that overlap) were repeated
        shift = lengths[level + 1] - length
        at = np.flatnonzero(alive[:-shift] & alive[shift:])
        at = at[group.ahead[at] >= lengths[level + 1]]
    return at


def _sent_first(lengths: list[int], bits: int):
    send = _sent(lengths, 0, bits)

    def sent(table: pa.Table) -> pa.Table:
        return send(table, _ANSWER.empty_table())

    return sent


def _sent(lengths: list[int], level: int, bits: int):
    def sent(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _SENT.empty_table()
        group = _Group(table, lengths[-1])
        at = _candidates(group, lengths, answers, level, bits)
        if level < len(lengths) - 1:
            keys, rank = group.hashes(at, lengths[level]), group.rank[group.row[at]]
            order = np.argsort(keys, kind="stable")
            keys, rank = keys[order], rank[order]
            first = np.flatnonzero(_new(keys))
            least, most = (f.reduceat(rank, first) if len(first) else rank[:0] for f in (np.minimum, np.maximum))
            rows = keyed_slots.sent(keys[first], bits, KEY_BYTES, many=least != most)
        else:
            keys, checks, row, _ = _distinct(group, at, lengths[level])
            rows = keyed_slots.sent(keys, bits, KEY_BYTES, checks=checks, docs=group.doc[row], nulls=group.null[row])
        n = len(rows["slot"])
        rows |= {"chunk": [table["chunk"][0].as_py()] * n, "level": [level] * n}
        return pa.table([pa.array(rows.get(f.name, [None] * n), f.type) for f in _SENT], schema=_SENT)

    return sent


def _distinct(group: _Group, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The distinct windows by key and check, the row of the first document that has each, and which
    of them each start is."""
    keys, checks, row = group.hashes(at, length), _checks(group, at, length), group.row[at]
    order = np.lexsort((group.rank[row], checks, keys))
    new = _new(keys[order], checks[order])
    first = order[np.flatnonzero(new)]
    index = np.empty(len(at), np.int64)
    index[order] = np.cumsum(new) - 1
    return keys[first], checks[first], row[first], index


def _new(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def _judged(table: pa.Table) -> pa.Table:
    """Which keys of an inner level stand in two documents: in two groups, or in two of one group."""
    table = table.combine_chunks()
    keys, begin = keyed_slots.keys_of(table, KEY_BYTES)
    sizes = np.diff(begin).tolist()
    many = [keyed_slots.flagged(raw, n) for raw, n in zip(table["many"].to_pylist(), sizes)]
    _, index, count = np.unique(keys, return_inverse=True, return_counts=True)
    repeated = count > 1
    repeated[index[np.concatenate(many)]] = True
    return _answer(table, repeated[index], begin)


def _earlier(table: pa.Table) -> pa.Table:
    """For which windows of the last level an earlier document is known than the group's first."""
    table = table.combine_chunks()
    keys, begin = keyed_slots.keys_of(table, KEY_BYTES)
    checks = np.frombuffer(b"".join(table["checks"].to_pylist()), np.uint64)
    docs = keyed_slots.numbers_of(table, "docs")
    sizes = np.diff(begin).tolist()
    null = np.concatenate([keyed_slots.flagged(raw, n) for raw, n in zip(table["nulls"].to_pylist(), sizes)])
    order = np.lexsort((docs, null, checks, keys))
    new = _new(keys[order], checks[order])
    first = np.empty(len(order), np.int64)
    if len(order):
        first[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    told = (~null[first] & null) | (~null & ~null[first] & (docs[first] < docs))
    return _answer(table, told, begin)


def _answer(table: pa.Table, told: np.ndarray, begin: np.ndarray) -> pa.Table:
    packed = [keyed_slots.flags(told[a:b]) for a, b in zip(begin, begin[1:])]
    return pa.table([table["chunk"], table["level"], table["slot"], pa.array(packed, pa.binary())], schema=_ANSWER)


def _removed(lengths: list[int], bits: int):
    def removed(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            empty = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string()}
            return pa.table({name: pa.array([], kind) for name, kind in empty.items()})
        group, last, window = _Group(table, lengths[-1]), len(lengths) - 1, lengths[-1]
        at = _candidates(group, lengths, answers, last, bits)
        keys, _, first, index = _distinct(group, at, window)
        earlier = keyed_slots.answered_flags(answers.filter(pc.equal(answers["level"], last)), "told", keys, bits)
        # behind the group's first document of a window all others are later anyway
        later = earlier[index] | (group.rank[group.row[at]] > group.rank[first][index])
        gone = common.covered(len(group.row), at[later], window)
        raw, out = memoryview(group.data), {"n_removed": [], "kept_sha256": []}
        count = np.concatenate([[0], np.cumsum(gone)])[group.bounds]
        for i in range(table.num_rows):
            words: Iterator[bytes] = bytes(raw[group.offsets[i] : group.offsets[i + 1]]).split()
            if count[i + 1] > count[i]:
                words = compress(words, (~gone[group.bounds[i] : group.bounds[i + 1]]).tolist())
            out["kept_sha256"].append(hashlib.sha256(b" ".join(words)).hexdigest())
        out["n_removed"] = pa.array(np.diff(count), pa.int64())
        return pa.table({"doc_id": table["doc_id"], "n_words": pa.array(group.size, pa.int64()), **out})

    return removed


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, start: int = START, chunk_bytes: int = common.CHUNK_BYTES
) -> DataFrame:
    """Words covered by a window whose word sequence also starts in a document with a smaller id.

    Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space), a
    row for each row of ``docs``. A null or empty text has no words and keeps the hash of the
    empty string; a text shorter than the window loses nothing. Rows that share a doc_id are not
    smaller than each other, so they remove nothing from each other. A null doc_id comes after all
    ids and stays null in the result. Columns other than doc_id and text are ignored.
    """
    docs = common.texts(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, bits = max(1, -(-size // chunk_bytes)), keyed_slots.slot_bits(size, chunk_bytes)
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk")
    by_chunk = common.dealt(docs.select(chunk, "doc_id", "text"), chunks).groupBy("chunk")
    lengths = levels(window, start)
    answers = None
    for level in range(len(lengths)):
        if answers is None:
            rows = by_chunk.applyInArrow(_sent_first(lengths, bits), SENT)
        else:
            rows = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(_sent(lengths, level, bits), SENT)
        judge = _judged if level < len(lengths) - 1 else _earlier
        # a bit for each key: what is dealt again beside the next level's answers is small
        told = common.dealt(keyed_slots.by_slot(rows, judge, ANSWER, bits), chunks)
        answers = told if answers is None else common.dealt(answers.unionByName(told), chunks)
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(_removed(lengths, bits), REMOVED)
