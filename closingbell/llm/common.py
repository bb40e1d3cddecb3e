"""What several operators share: chunks of documents, texts as byte arrays, rolling hashes.

Texts reach Python as Arrow columns. They are handled as one byte array per slice of a few
megabytes, so that the work per byte is done by numpy and memory does not depend on how many
rows a batch has. A document longer than a slice is a slice of its own.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

import closingbell
from closingbell.session import work_folder

SLICE_BYTES = 1 << 21
CHUNK_BYTES = 8 << 20
#: A null doc_id sorts behind all others.
NO_ID = np.int64(2**63 - 1)

# The separators of words: space and the ASCII controls tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Stops that end a word, and the letters they end it behind.
STOPS, LETTERS = np.zeros(256, bool), np.zeros(256, bool)
STOPS[[ord(c) for c in ".,;:!?"]] = True
LETTERS[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the cluster's shared folder and read back: lineage ends here."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def column(name: str, of: str | None = None) -> Column:
    """A column of any name, also one with dots or backticks."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{of}.{quoted}" if of else quoted)


def whole_rows(docs: DataFrame) -> Column:
    """All columns of a row, as they are."""
    return F.struct(*(column(c).alias(c) for c in docs.columns)).alias("row")


def rows_without_text(docs: DataFrame) -> Column:
    """``whole_rows`` with a null for the text, which moves beside it."""
    plain = (F.lit(None).cast("string") if c == "text" else column(c) for c in docs.columns)
    return F.struct(*(value.alias(c) for value, c in zip(plain, docs.columns))).alias("row")


def beside_row(rows: DataFrame, more: str) -> StructType:
    """The schema of ``row`` (as in ``rows``) and more columns behind it."""
    return StructType([rows.schema["row"], *StructType.fromDDL(more).fields])


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and whole text of every row; a null text is empty, other columns are left out."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def chunk_count(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> int:
    """Chunks of about ``chunk_bytes`` of text each."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-size // chunk_bytes))


#: Most tasks of a stage over chunks.
MOST_TASKS = 20_000


def dealt(rows: DataFrame, chunks: int) -> DataFrame:
    """The rows by ``chunk``, in as many tasks as there are chunks: a task's share doesn't grow."""
    return rows.repartition(min(chunks, MOST_TASKS), "chunk")


# -- texts as bytes ------------------------------------------------------------------


def as_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no rows, or too long for 32-bit offsets
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n + 1 offsets of its rows."""
    column = pc.fill_null(as_array(column).cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one longer row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        to = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        to = min(max(to, row + 1), rows)
        yield row, to
        row = to


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the row it stands in."""
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    row = np.searchsorted(offsets, starts, side="right") - 1
    return starts, np.flatnonzero(last) + 1, row


# -- hashes --------------------------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random-looking value for each byte value.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse up to n, kept between calls up to a slice's size."""
    if len(_POWERS[0]) <= n:
        size = max(n, SLICE_BYTES) + 1
        grown = []
        for base in (_BASE, _INVERSE):
            powers = np.full(size, base)
            powers[0] = 1
            grown.append(np.multiply.accumulate(powers))
        if size > 4 * SLICE_BYTES:
            return grown[0], grown[1]
        _POWERS[:] = grown
    return _POWERS[0], _POWERS[1]


class RangeHash:
    """Hashes of any ranges of a sequence of 64-bit values, from one prefix sum."""

    def __init__(self, values: np.ndarray):
        self.up, self.down = _powers(len(values))
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return RangeHash(BYTE_VALUES[data])(starts, ends)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


#: Positions take 31 bits, as many as the longest string has bytes; the others order the hashes.
_AT_MASK = np.uint64((1 << 31) - 1)


def anchored(grams: np.ndarray, row: np.ndarray, gram: int, window: int):
    """Windows of ``window`` items grouped by the gram of least hash inside them.

    ``grams[i]`` hashes the ``gram`` items from i on, ``row[i]`` is the row of item i. Returns
    first and last window start of every group and the position of its anchor. Equal windows
    have equal anchors, and every window lies in one group.
    """
    items = len(row)
    if items < window:
        none = np.zeros(0, np.int64)
        return none, none, none
    at = np.arange(len(grams), dtype=np.uint64)
    least = sliding_min((grams & ~_AT_MASK) | at, window - gram + 1)[: items - window + 1]
    anchor = (least & _AT_MASK).astype(np.int64)
    whole = row[: len(anchor)] == row[window - 1 :]
    start = whole.copy()
    start[1:] &= (anchor[1:] != anchor[:-1]) | ~whole[:-1]
    end = whole.copy()
    end[:-1] &= (anchor[1:] != anchor[:-1]) | ~whole[1:]
    first = np.flatnonzero(start)
    return first, np.flatnonzero(end), anchor[first]


def ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges first..last, and the range each belongs to."""
    length = last - first + 1
    owner = np.repeat(np.arange(len(first)), length)
    return np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length) + first[owner], owner


def covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    """Which of n items a window of ``width`` items from one of ``starts`` covers."""
    opened = np.bincount(starts, minlength=n + 1)
    closed = np.bincount(np.minimum(starts + width, n), minlength=n + 1)
    return np.cumsum((opened - closed)[:-1]) > 0


# -- pairs of 64-bit values, such as a gram's hash and that of a context around it --------


def least(key: np.ndarray, sub: np.ndarray, doc: np.ndarray):
    """The distinct (key, sub), sorted, each with its smallest doc."""
    order = np.lexsort((doc, sub, key))
    key, sub, doc = key[order], sub[order], doc[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])
    return key[new], sub[new], doc[new]


def merged(parts: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    return [np.concatenate(column) for column in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 3


def sorted_runs(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]):
    for batch in batches:
        if batch.num_rows:
            yield [batch[name].to_numpy() for name in names]


def _pair(key: np.ndarray, sub: np.ndarray) -> np.ndarray:
    """One value for a pair, to look it up; the pair itself is compared afterwards."""
    return mix(key.view(np.uint64) * np.uint64(3) + sub.view(np.uint64))


class Lookup:
    """The smallest doc known for each (key, sub)."""

    def __init__(self, key: np.ndarray, sub: np.ndarray, doc: np.ndarray):
        key, sub, doc = least(key.astype(np.int64), sub.astype(np.int64), doc.astype(np.int64))
        pair = _pair(key, sub)
        order = np.argsort(pair)
        self.pair, self.key, self.sub, self.doc = pair[order], key[order], sub[order], doc[order]

    def __call__(self, key: np.ndarray, sub: np.ndarray) -> np.ndarray:
        if not len(self.pair):
            return np.full(len(key), NO_ID)
        pair = _pair(key, sub)
        at = np.minimum(np.searchsorted(self.pair, pair), len(self.pair) - 1)
        same = (self.key[at] == key) & (self.sub[at] == sub)
        return np.where(same, self.doc[at], NO_ID)



def known(lookup: Lookup, key: np.ndarray, sub: np.ndarray) -> np.ndarray:
    if not len(lookup.pair):
        return np.zeros(len(key), bool)
    pair = _pair(key, sub)
    at = np.minimum(np.searchsorted(lookup.pair, pair), len(lookup.pair) - 1)
    return (lookup.key[at] == key) & (lookup.sub[at] == sub)


# -- ids of words ----------------------------------------------------------------------


class WordIds:
    """Ids of the distinct words seen so far, as arrays: hashes, sorted, and where the ids stand.

    ``learn`` gives the ids of new words, one after the other, and the number of each word's. Past
    ``most`` words all are forgotten.
    """

    def __init__(self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = 2_000_000):
        self.learn, self.most = learn, most
        self._forget()

    def _forget(self) -> None:
        self.hashes, self.start = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def _add(self, hashes: np.ndarray, words: list[bytes]) -> None:
        ids, length = self.learn(words)
        start = np.cumsum(length) - length + len(self.ids)
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.start = np.insert(self.start, at, start)
        self.length = np.insert(self.length, at, length)
        self.ids = np.concatenate([self.ids, ids])

    def encode(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, end: int | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows' words, and the number of ids of each row.

        ``bounds``: words up to the end of each row. ``end``: an id to put behind each row.
        """
        distinct, first, inverse = np.unique(
            word_hashes(data, starts, ends), return_index=True, return_inverse=True
        )
        if len(self.hashes) > self.most:
            self._forget()
        at = np.searchsorted(self.hashes, distinct)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == distinct[known]
        new = np.flatnonzero(~known)
        raw = data.tobytes()
        spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
        self._add(distinct[new], [raw[a:b] for a, b in spans])
        word = np.searchsorted(self.hashes, distinct)[inverse]
        length, start = self.length[word], self.start[word]
        ids, last = self.ids, np.asarray(bounds)
        if end is not None:  # the end id stands behind all others
            length, start = np.insert(length, bounds, 1), np.insert(start, bounds, len(ids))
            ids = np.append(ids, np.uint16(end))
            last = last + np.arange(1, len(last) + 1)
        picked = np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        total = np.concatenate([[0], np.cumsum(length)])[last]
        return ids[picked], np.diff(total, prepend=0)


#: Text that a task passes to Python at a time.
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Give this package to the session's Python workers, once per application, and keep the Arrow
    batches small: both ends of the pipe hold some of them for every running task."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if getattr(context, "_closingbell_shipped", False):
        return
    package = Path(closingbell.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="closingbell-")) / "closingbell.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    context._closingbell_shipped = True
