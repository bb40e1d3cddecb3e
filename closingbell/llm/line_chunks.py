"""Line dedup by content-defined chunks.

A rolling hash over the hashes of two consecutive lines gives every pair of lines a number; the least
one among two neighbouring pairs marks a chunk, which is that pair of lines. So the same lines are
marked at the same places whatever stands around them, and each run of three lines holds a chunk.
A chunk that stands in the corpus more than once is kept where it comes first, by doc_id and
position, and removed elsewhere, after its bytes were compared with those of the first; the lines on
both sides go too, as far as they equal those around the first place. A block of three or more
lines that stands in an earlier document goes as a whole by that, wherever it is in either.

Only hashes of chunks are shuffled, folded per group of documents, then the bytes of each repeated
chunk and of the lines next to it, once per other group that holds it. Texts move once, to a group
by a hash of doc_id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from closingbell.llm import common

#: The rolling hash: x[i] * ROLL + x[i + 1] modulo 2**32, x being the first 32 bits of a line's MD5.
ROLL = 1_000_003
MODULO = 1 << 32
SIGNED = 1 << 63

PLACE = "no_id boolean, doc_id long, at int"
FOUND = f"hi long, lo long, {PLACE}, chunk int"
BYTES = "hi long, lo long, body binary, before binary, behind binary"


def chunk_starts(lines: list[bytes]) -> list[int]:
    """First lines of the chunks: of each two neighbouring pairs the one with the lesser rolling
    hash, of equal ones the first; pairs of blank lines never. Two lines are one pair."""
    x = [int.from_bytes(hashlib.md5(line).digest()[:4], "big") for line in lines]
    blank = [not line.strip() for line in lines]
    rolled = [
        MODULO if blank[i] and blank[i + 1] else (x[i] * ROLL + x[i + 1]) % MODULO for i in range(len(lines) - 1)
    ]
    marked = {i if rolled[i] <= rolled[i + 1] else i + 1 for i in range(len(rolled) - 1)}
    if len(rolled) == 1:
        marked = {0}
    return sorted(i for i in marked if rolled[i] < MODULO)


Place = tuple[bool, int, int]


class _Text:
    """The lines of one row and its chunks: first line, digest."""

    def __init__(self, doc: int | None, text: bytes):
        self.doc, self.text, self.lines = (doc is None, doc or 0), text, text.split(b"\n")
        self.chunks: list[tuple[int, tuple[int, int]]] = []
        for at in chunk_starts(self.lines):
            digest = xxhash.xxh3_128_intdigest(self.body(at))
            self.chunks.append((at, ((digest >> 64) - SIGNED, (digest & (2 * SIGNED - 1)) - SIGNED)))

    def body(self, at: int) -> bytes:
        return b"\n".join(self.lines[at : at + 2])

    def parts(self, n: int) -> tuple[bytes, bytes, bytes]:
        """Bytes of the n-th chunk, of the lines back to the start of the chunk before it and on to the
        end of the one behind it, or to the ends of the text; each such line ends with a line feed."""
        at = self.chunks[n][0]
        low = self.chunks[n - 1][0] if n else 0
        high = self.chunks[n + 1][0] + 2 if n + 1 < len(self.chunks) else len(self.lines)
        told = lambda lines: b"".join(line + b"\n" for line in lines)
        return self.body(at), told(self.lines[low:at]), told(self.lines[at + 2 : high])


def _read(table: pa.Table) -> list[_Text]:
    if not table.num_rows:
        return []
    data, offsets = common.text_bytes(table["text"])
    raw, at = memoryview(data), offsets.tolist()
    return [_Text(doc, bytes(raw[a:b])) for doc, a, b in zip(table["doc_id"].to_pylist(), at, at[1:])]


def _first_places(texts: list[_Text]) -> dict[tuple[int, int], Place]:
    first: dict[tuple[int, int], Place] = {}
    for text in texts:
        for at, digest in text.chunks:
            place = (*text.doc, at)
            if first.setdefault(digest, place) > place:
                first[digest] = place
    return first


def _columns(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})


def _chunk_rows(table: pa.Table) -> pa.Table:
    first = _first_places(_read(table))
    chunk = table["chunk"][0].as_py()
    rows = [(*digest, *place, chunk) for digest, place in first.items()]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int32()]
    return _columns(rows, ["hi", "lo", "no_id", "doc_id", "at", "chunk"], kinds)


def _first_bytes(table: pa.Table, asked: pa.Table) -> pa.Table:
    """Bytes of, and around, the repeated chunks whose first place is in this group of documents."""
    rows = zip(*(asked[c].to_pylist() for c in ("hi", "lo", "no_id", "doc_id", "at")))
    wanted = {(hi, lo): tuple(place) for hi, lo, *place in rows}
    told: dict[tuple[int, int], tuple[bytes, bytes, bytes]] = {}
    for text in _read(table) if wanted else ():
        for n, (at, digest) in enumerate(text.chunks):
            if wanted.get(digest) == (*text.doc, at):
                parts = text.parts(n)
                told[digest] = min(told.get(digest, parts), parts)  # rows can share the place
    kinds = [pa.int64()] * 2 + [pa.binary()] * 3
    return _columns([(*d, *p) for d, p in told.items()], ["hi", "lo", "body", "before", "behind"], kinds)


def _equal_lines(mine: Iterator[bytes], others: Iterator[bytes]) -> int:
    """How many lines are equal from the first on."""
    n = 0
    for a, b in zip(mine, others):
        if a != b:
            break
        n += 1
    return n


def _removed(table: pa.Table, answers: pa.Table) -> pa.Table:
    texts = _read(table)
    first = _first_places(texts)
    other: dict[tuple[int, int], tuple[bytes, bytes, bytes]] = {}
    names = ("hi", "lo", "no_id", "doc_id", "at", "body", "before", "behind")
    for hi, lo, no_id, doc, at, *parts in zip(*(answers[name].to_pylist() for name in names)):
        first[hi, lo] = (no_id, doc, at)
        other[hi, lo] = tuple(parts)
    known: dict[tuple[int, int], tuple[bytes, bytes, bytes]] = {}
    for text in texts:  # the first places that this group holds itself
        for n, (at, digest) in enumerate(text.chunks):
            if first[digest] == (*text.doc, at):
                parts = text.parts(n)
                known[digest] = min(known.get(digest, parts), parts)
    known |= other
    kept, n_lines, n_removed = [], [], []
    for text in texts:
        lines = text.lines
        gone = bytearray(len(lines))
        for at, digest in text.chunks:
            if first[digest] < (*text.doc, at) and known[digest][0] == text.body(at):
                _, before, behind = known[digest]
                low = at - _equal_lines(reversed(lines[:at]), reversed(before.split(b"\n")[:-1]))
                high = at + 2 + _equal_lines(iter(lines[at + 2 :]), iter(behind.split(b"\n")[:-1]))
                gone[low:high] = b"\1" * (high - low)
        n_lines.append(len(lines))
        n_removed.append(sum(gone))
        rest = b"\n".join(x for x, g in zip(lines, gone) if not g) if any(gone) else text.text
        kept.append(rest.decode())
    counts = {"n_lines": pa.array(n_lines, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
    return pa.table({"row": table["row"], "text": pa.array(kept, pa.string()), **counts})


def mark_lines(docs: DataFrame, chunk_bytes: int = common.CHUNK_BYTES) -> DataFrame:
    """Every row of ``docs`` without its repeated lines, and how many that took.

    Returns row (a struct of all columns of ``docs``, unchanged but for the text, which is null there),
    text (the remaining lines), n_lines and n_removed. Lines end at a line feed. A text of one line
    has no chunk and stays. Which place comes first is decided by doc_id, then by position; rows that
    share a doc_id count as one document there, so equal chunks at the same line stay in both, and
    of their bytes the least count. A null doc_id comes after all ids. A null or empty text is one
    empty line and comes back empty. A document that only repeats others comes back empty, it isn't
    dropped.

    Lines next to a removed chunk are removed as long as they equal those next to its first place,
    line by line, at most to the far end of the next chunk on each side of that place. Every removed
    line still stands at an earlier place.
    """
    parted = common.texts(docs).select("doc_id", "text")
    chunks = common.chunk_count(parted, chunk_bytes)
    every = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        common.rows_without_text(docs),
    ).select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk"), "*")
    by_chunk = common.dealt(every, chunks).groupBy("chunk")
    found = by_chunk.applyInArrow(_chunk_rows, FOUND)
    keys = ["hi", "lo"]
    place = F.struct("no_id", "doc_id", "at", "chunk")
    first = found.groupBy(*keys).agg(F.min(place).alias("first"), F.count("*").alias("n"))
    first = first.filter(F.col("n") > 1).select(*keys, "first.*")
    bodies = by_chunk.cogroup(common.dealt(first, chunks).groupBy("chunk")).applyInArrow(_first_bytes, BYTES)
    # the group of a first place has its bytes; the others that hold the chunk are told
    home = first.withColumnRenamed("chunk", "home")
    others = found.select("chunk", *keys).join(home, keys).filter(F.col("chunk") != F.col("home"))
    answers = others.join(bodies, keys).select("chunk", *keys, "no_id", "doc_id", "at", "body", "before", "behind")
    schema = common.beside_row(every, "text string, n_lines long, n_removed long")
    return by_chunk.cogroup(common.dealt(answers, chunks).groupBy("chunk")).applyInArrow(_removed, schema)


def dedup_lines(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` with repeated lines taken out of their texts, same columns.

    A column n_chars, if there is one, is the length of the new text.
    """
    marked = mark_lines(docs, **settings)
    new = {"text": F.col("text").alias("text"), "n_chars": F.length("text").cast("long").alias("n_chars")}
    return marked.select(*(new.get(c, common.column(c, "row").alias(c)) for c in docs.columns))
