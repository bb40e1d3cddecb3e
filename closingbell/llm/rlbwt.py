"""Exact removal of repeated byte strings with a run-length compressed suffix index.

1. Every window of ``window`` bytes is assigned to the 32-byte gram of least hash inside it; the
   windows of one gram occurrence stand next to each other, and the bytes they span are its
   *context*. Each window of the corpus lies in exactly one context, and equal windows lie in
   contexts of the same gram.
2. Grams that occur once are done. Equal contexts are folded to one with a count: all their
   windows are repeated. What is left are different contexts of one gram.
3. Those are dealt out by gram and indexed in shards of whole grams: suffix array, Burrows-Wheeler
   transform compressed to its runs, text positions sampled at both ends of each run. The length
   of the match with the next smaller and next larger suffix is computed at the samples only; in
   text order it falls by one per byte between them, so matching statistics are streamed from the
   samples. Windows whose match reaches ``window`` bytes are marked.
4. A gram with more than ``shard_contexts`` contexts (a passage that very many documents share,
   with other text around it) would not fit a shard; its windows are dealt out by their own hash
   instead and counted, which is exact as well and splits any gram.

Texts move once, to a chunk by a hash of doc_id and text; each step reads that exchange again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from closingbell.llm import common

WINDOW = 200
GRAM = 32
SHARD_CONTEXTS = 8192
SHARD_BYTES = 1 << 21
CERTIFIED, REQUEST, MARKED, REQUEST_HOT = 0, 1, 2, 3
ANSWER = "chunk int, key long, sub long, kind int, spans binary"


# -- the index -----------------------------------------------------------------------


class RunLengthIndex:
    """Suffix order of some byte strings, its BWT as runs, and samples at the ends of runs.

    Every string ends in a sentinel of its own, smaller than all bytes and ordered by position,
    so matches never run from one string into the next.
    """

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        """``data``: the strings one after the other; ``ends``: the end of each."""
        n = len(data)
        self.n, self.levels = n, []
        self.left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)  # bytes to the end
        longest = int(self.left.max(initial=0))
        # seven symbols of nine bits; 0 stands for the end
        one = data.astype(np.int64) + 1
        two = (one << 9) | self._ahead(one, 1)
        three = (two << 9) | self._ahead(one, 2)
        key = (two << 45) | (self._ahead(two, 2) << 27) | self._ahead(three, 4)
        self.data = data
        depth = 7
        order = np.argsort(key)
        new = self._changes(key[order])
        rank = np.empty(n, np.int32)
        first = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))
        rank[order] = first + 1
        self.levels.append((depth, rank))
        # only suffixes that share a rank are sorted on, in the places that they have together; a rank
        # is one more than the number of smaller suffixes, so those of the others stay as they are
        rest = self._not_alone(new)
        shared, group = order[rest], first[rest] + 1
        while depth < longest and len(shared):
            ahead = self._ahead(rank, depth)[shared]
            # members of a group stand side by side: its number orders as its rank does
            head = self._changes(group)
            order = self._ordered(np.cumsum(head) - 1, ahead, n + 1)
            shared, ahead, rank = shared[order], ahead[order], rank.copy()
            new = head | self._changes(ahead)
            at = np.arange(len(shared), dtype=np.int32)
            group = group + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(head, at, 0))
            rank[shared] = group
            rest = self._not_alone(new)
            shared, group = shared[rest], group[rest]
            depth *= 2
            self.levels.append((depth, rank))
        # equal suffixes of different strings: the sentinels decide, by position
        self.order = np.sort((rank.astype(np.int64) << 32) | np.arange(n)) & 0xFFFFFFFF
        before = np.where(np.concatenate([[True], self.left[:-1] == 1]), -1, np.roll(data, 1).astype(np.int32))
        bwt = before[self.order]
        head = np.ones(n, bool)
        head[1:] = (bwt[1:] != bwt[:-1]) | (bwt[1:] < 0)
        self.heads = np.flatnonzero(head)
        self.run_symbols = bwt[self.heads]
        self.run_lengths = np.diff(self.heads, append=n)
        tails = self.heads + self.run_lengths - 1
        self.sample_first, self.sample_last = self.order[self.heads], self.order[tails]

    def _ahead(self, values: np.ndarray, by: int) -> np.ndarray:
        """The value of a later position of the same string; 0 past its end."""
        later = np.zeros_like(values)
        later[: max(0, self.n - by)] = values[by:]
        later *= self.left > by
        return later

    @staticmethod
    def _changes(values: np.ndarray) -> np.ndarray:
        """Where a value differs from the one before it."""
        new = np.ones(len(values), bool)
        new[1:] = values[1:] != values[:-1]
        return new

    @staticmethod
    def _not_alone(new: np.ndarray) -> np.ndarray:
        """Members of groups of two and more; ``new`` tells where groups begin."""
        alone = new.copy()
        alone[:-1] &= new[1:]
        return ~alone

    @staticmethod
    def _ordered(number: np.ndarray, ahead: np.ndarray, most: int) -> np.ndarray:
        """The order by number and what is ahead; values sort faster than places where both fit."""
        bits = most.bit_length()
        key = (number << bits) | ahead
        places = len(key).bit_length()
        if int(number[-1]).bit_length() + bits + places > 63:
            return np.argsort(key)
        key <<= places
        key |= np.arange(len(key))
        key.sort()
        key &= (1 << places) - 1
        return key

    def common_prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at a and b."""
        most = np.minimum(self.left[a], self.left[b])
        length = np.zeros(len(a), np.int64)
        for depth, rank in reversed(self.levels):
            step = length + depth <= most
            at = np.flatnonzero(step)
            same = rank[a[at] + length[at]] == rank[b[at] + length[at]]
            length[at[same]] += depth
        for _ in range(7):
            at = np.flatnonzero(length < most)
            at = at[self.data[a[at] + length[at]] == self.data[b[at] + length[at]]]
            length[at] += 1
        return length

    def matching_statistics(self) -> np.ndarray:
        """For every position the longest match that also starts at another one, from the samples."""
        if not self.n:
            return np.zeros(0, np.int64)
        between = self.common_prefix(self.sample_first[1:], self.sample_last[:-1])
        lower = self._streamed(self.sample_first, np.concatenate([[0], between]))
        upper = self._streamed(self.sample_last, np.concatenate([between, [0]]))
        return np.maximum(lower, upper)

    def _streamed(self, samples: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Inside a run a match is that of the position before it, less one byte."""
        at = np.zeros(self.n, np.int64)
        at[samples] = samples
        at = np.maximum.accumulate(at)
        value = np.zeros(self.n, np.int64)
        value[samples] = lengths
        return value[at] - (np.arange(self.n) - at)


def long_matches(strings: list[bytes], window: int) -> list[np.ndarray]:
    """Starts of the windows in each string that also start elsewhere in the strings."""
    ends = np.cumsum([len(x) for x in strings])
    index = RunLengthIndex(np.frombuffer(b"".join(strings), np.uint8), ends)
    hit = np.flatnonzero(index.matching_statistics() >= window)
    begins = ends - [len(x) for x in strings]
    cut = np.searchsorted(hit, begins[1:])
    return [part - begin for part, begin in zip(np.split(hit, cut), begins)]


# -- contexts of a chunk -------------------------------------------------------------


class _Slice:
    def __init__(self, data: np.ndarray, offsets: np.ndarray, lo: int, hi: int, window: int, gram: int):
        self.data, self.offsets = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        self.lo, self.hi, self.window = lo, hi, window
        row = np.repeat(np.arange(hi - lo, dtype=np.int32), np.diff(self.offsets))
        self.range_hash = common.RangeHash(common.BYTE_VALUES[self.data])
        at = np.arange(max(0, len(self.data) - gram + 1))
        grams = self.range_hash(at, at + gram)
        self.first, self.last, anchor = common.anchored(grams, row, gram, window)
        self.key = grams[anchor].view(np.int64)
        self.ctx = self.range_hash(self.first, self.last + window).view(np.int64)


def _slices(table: pa.Table, window: int, gram: int) -> Iterator[_Slice]:
    data, offsets = common.text_bytes(table["text"])
    for lo, hi in common.slices(offsets):
        yield _Slice(data, offsets, lo, hi, window, gram)


def _counted(key: np.ndarray, ctx: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (key, ctx), sorted, and whether each occurs more than once."""
    order = np.lexsort((ctx, key))
    key, ctx = key[order], ctx[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1])
    at = np.flatnonzero(new)
    return key[at], ctx[at], (np.diff(at, append=len(key)) > 1).astype(np.int64)


def _ctx_rows(window: int, gram: int):
    def found(keys: tuple, table: pa.Table) -> pa.Table:
        pairs = [(s.key, s.ctx) for s in _slices(table, window, gram)]
        key, ctx, many = _counted(*common.merged(pairs)[:2])
        chunk = np.full(len(key), keys[0].as_py(), np.int64)
        return pa.table({"key": key, "ctx": ctx, "who": chunk * 2 + many})

    return found


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, ctx, who. Every row of a context with several rows is certified; the
    first row of each context of a key that has several is asked for its bytes. One row is kept
    between batches, however long a run is."""
    held = None  # first row of the last context; is it the only one of its key, of its context
    for key, ctx, who in common.sorted_runs(batches, ("key", "ctx", "who")):
        if held is not None:
            key, ctx, who = (np.concatenate([[h], x]) for h, x in zip(held[0], (key, ctx, who)))
        new_key, head = np.ones(len(key), bool), np.ones(len(key), bool)
        new_key[1:] = key[1:] != key[:-1]
        head[1:] = new_key[1:] | (ctx[1:] != ctx[:-1])
        heads = np.flatnonzero(head)
        alone = new_key[heads].copy()
        if held is not None:
            alone[0] = held[1]
        followed = np.zeros(len(heads), bool)
        followed[:-1] = ~new_key[heads[1:]]
        ask = heads[~alone | followed]
        several = np.diff(heads, append=len(key)) > 1
        certify = np.concatenate([np.flatnonzero(~head), heads[several]])
        if held is not None:
            if not held[1]:
                ask = ask[ask != 0]  # asked when it came
            if not held[2]:
                certify = certify[certify != 0]
        at = np.concatenate([certify, ask])
        if len(at):
            kind = np.repeat(np.array([CERTIFIED, REQUEST], np.int32), [len(certify), len(ask)])
            chunk = (who[at] >> 1).astype(np.int32)
            yield pa.RecordBatch.from_pydict({"chunk": chunk, "key": key[at], "sub": ctx[at], "kind": kind})
        last = heads[-1]
        single = not several[-1] and (held is None or last != 0 or held[2])
        held = (key[last], ctx[last], who[last]), bool(alone[-1]), single


def _of_kind(answers: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mine = answers["kind"].to_numpy() == kind
    key, sub = answers["key"].to_numpy()[mine], answers["sub"].to_numpy()[mine]
    return key, sub, np.arange(len(key))


def _context_rows(window: int, gram: int):
    """The bytes of each context that was asked for; of a hot key, each window's hash."""

    def found(keys: tuple, table: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, list] = {name: [] for name in ("hot", "key", "part", "ctx", "at", "text")}
        plain, hot = (common.Lookup(*_of_kind(asked, kind)) for kind in (REQUEST, REQUEST_HOT))
        seen: set[tuple[int, int]] = set()
        for s in _slices(table, window, gram) if table.num_rows else ():
            raw = s.data.tobytes()
            for lookup in (plain, hot):
                for i in np.flatnonzero(common.known(lookup, s.key, s.ctx)).tolist():
                    key, ctx = int(s.key[i]), int(s.ctx[i])
                    if (key, ctx) in seen:
                        continue
                    seen.add((key, ctx))
                    first, last = int(s.first[i]), int(s.last[i])
                    n = 1
                    if lookup is plain:
                        out["part"].append(0)
                        out["at"].append(0)
                        out["text"].append(raw[first : last + window])
                    else:
                        n = last - first + 1
                        start = np.arange(first, last + 1)
                        out["part"].extend(s.range_hash(start, start + window).view(np.int64).tolist())
                        out["at"].extend(range(n))
                        out["text"].extend([None] * n)
                    out["hot"].extend([lookup is hot] * n)
                    out["key"].extend([key] * n)
                    out["ctx"].extend([ctx] * n)
        out["chunk"] = [keys[0].as_py()] * len(out["key"])
        return pa.table(out, schema=_CONTEXT)

    return found


_CONTEXT = pa.schema(
    [("hot", pa.bool_()), ("key", pa.int64()), ("part", pa.int64()), ("ctx", pa.int64()), ("at", pa.int32()),
     ("text", pa.binary()), ("chunk", pa.int32())]
)
_CONTEXT_DDL = "hot boolean, key long, part long, ctx long, at int, text binary, chunk int"


def _answer(chunk, key, ctx, spans) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "chunk": pa.array(chunk, pa.int32()), "key": pa.array(key, pa.int64()), "sub": pa.array(ctx, pa.int64()),
            "kind": pa.array([MARKED] * len(chunk), pa.int32()), "spans": pa.array(spans, pa.binary()),
        }
    )


def _indexed(rows: list[tuple], window: int) -> pa.RecordBatch:
    """One shard: index its contexts and tell each its repeated windows."""
    marks = long_matches([row[2] for row in rows], window)
    told = [(row[3], row[0], row[1], m.astype(np.int32).tobytes()) for row, m in zip(rows, marks) if len(m)]
    return _answer(*(list(x) for x in zip(*told))) if told else _answer([], [], [], [])


def _mark(window: int):
    """Rows sorted by hot, key, part: shards of whole keys are indexed; equal windows of hot keys
    stand side by side."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, held = 0, None  # held: last hot row, and whether it was told
        for batch in batches:
            columns = [batch[name].to_pylist() for name in ("key", "ctx", "text", "chunk", "hot", "part", "at")]
            told: list[tuple] = []
            for key, ctx, text, chunk, hot, part, at in zip(*columns):
                if not hot:
                    if size >= SHARD_BYTES and rows[-1][0] != key:
                        yield _indexed(rows, window)
                        rows, size = [], 0
                    rows.append((key, ctx, text, chunk))
                    size += len(text)
                    continue
                row = (chunk, key, ctx, np.int32(at).tobytes())
                same = held is not None and held[0] == (key, part)
                if same:
                    if not held[2]:
                        told.append(held[1])
                    told.append(row)
                held = (key, part), row, same
            if told:
                yield _answer(*(list(x) for x in zip(*told)))
        if rows:
            yield _indexed(rows, window)

    return marked


def _removed(window: int, gram: int):
    def removed(keys: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[str, list] = {name: [] for name in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
        if not table.num_rows:
            return pa.table({"doc_id": [], **out}, schema=_REMOVED)
        pairs = [(s.key, s.ctx) for s in _slices(table, window, gram)]
        key, ctx, many = _counted(*common.merged(pairs)[:2])
        sure = _of_kind(answers, CERTIFIED)
        twice = many > 0
        certified = common.Lookup(*common.merged([(key[twice], ctx[twice], many[twice]), sure]))
        marks = answers.filter(pc.equal(answers["kind"], MARKED))
        spans: dict[tuple[int, int], list[np.ndarray]] = {}
        for k, c, span in zip(marks["key"].to_pylist(), marks["sub"].to_pylist(), marks["spans"].to_pylist()):
            spans.setdefault((k, c), []).append(np.frombuffer(span, np.int32))
        marked = common.Lookup(*_of_kind(answers, MARKED))
        for s in _slices(table, window, gram):
            sure = common.known(certified, s.key, s.ctx)
            hit = [common.ranges(s.first[sure], s.last[sure])[0]]
            for i in np.flatnonzero(~sure & common.known(marked, s.key, s.ctx)).tolist():
                hit.extend(s.first[i] + part for part in spans[int(s.key[i]), int(s.ctx[i])])
            gone = common.covered(len(s.data), np.concatenate(hit), window)
            start = gone.copy()
            start[1:] &= ~gone[:-1]
            edges = s.offsets[:-1][s.offsets[:-1] < len(gone)]
            start[edges] = gone[edges]
            n_gone, n_start = (np.concatenate([[0], np.cumsum(x)])[s.offsets] for x in (gone, start))
            raw, kept = s.data.tobytes(), ~gone
            for i in range(s.hi - s.lo):
                a, b = int(s.offsets[i]), int(s.offsets[i + 1])
                rest = raw[a:b] if n_gone[i + 1] == n_gone[i] else s.data[a:b][kept[a:b]].tobytes()
                out["kept_sha256"].append(hashlib.sha256(rest).hexdigest())
            out["n_bytes"].extend(np.diff(s.offsets).tolist())
            out["n_removed"].extend(np.diff(n_gone).tolist())
            out["n_spans"].extend(np.diff(n_start).tolist())
        return pa.table({"doc_id": common.as_array(table["doc_id"]), **out}, schema=_REMOVED)

    return removed


_REMOVED = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
     ("kept_sha256", pa.string())]
)


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    chunk_bytes: int = common.CHUNK_BYTES,
    shard_contexts: int = SHARD_CONTEXTS,
) -> DataFrame:
    """Bytes covered by a ``window``-byte string that also starts anywhere else in the texts.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256 (of the
    remaining bytes), a row for each row of ``docs``. Texts are UTF-8 bytes and whole; a null text
    is empty. Strings are judged on the input; matches never cross rows. Rows that share a doc_id
    are texts of their own, so equal ones remove each other. Null ids stay null. Other columns
    are ignored.
    """
    docs = common.texts(docs)
    chunks = common.chunk_count(docs, chunk_bytes)
    # by id and text, so that rows of one id, or without any, are dealt out as well
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk")
    by_chunk = common.dealt(docs.select(chunk, "doc_id", "text"), chunks).groupBy("chunk")
    found = by_chunk.applyInArrow(_ctx_rows(window, gram), "key long, ctx long, who long")
    judged = (
        found.repartition("key")
        .sortWithinPartitions("key", "ctx", "who")
        .mapInArrow(_judge, "chunk int, key long, sub long, kind int")
    )
    asked = judged.filter(F.col("kind") == REQUEST)
    # at most one key in shard_contexts of all contexts: small beside the rows it is joined to
    hot = asked.groupBy("key").count().filter(F.col("count") > shard_contexts).select("key", F.lit(True).alias("hot"))
    asked = asked.join(hot, "key", "left").select(
        "chunk", "key", "sub", F.when(F.col("hot"), F.lit(REQUEST_HOT)).otherwise(F.col("kind")).alias("kind")
    )
    contexts = by_chunk.cogroup(common.dealt(asked, chunks).groupBy("chunk")).applyInArrow(_context_rows(window, gram), _CONTEXT_DDL)
    marked = (
        contexts.repartition("key", "part")
        .sortWithinPartitions("hot", "key", "part")
        .mapInArrow(_mark(window), ANSWER)
    )
    answers = judged.withColumn("spans", F.lit(None).cast("binary")).unionByName(marked)
    return by_chunk.cogroup(common.dealt(answers, chunks).groupBy("chunk")).applyInArrow(
        _removed(window, gram), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
