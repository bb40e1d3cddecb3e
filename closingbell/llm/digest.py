"""Document fingerprints: improbable-feature digests.

Every window of 64 bytes has an entropy class. A class is the more improbable the fewer windows of
the corpus are in it; that order, counted over all texts, ranks the windows. Each run of 64 window
positions votes for its most improbable window (the leftmost of equals); windows with enough votes,
or the first few by votes in a short text, are its features. Features are hashed into chained Bloom filters of 2,048 bits, a
new one after 160 features. Two digests are compared filter by filter: for each filter of the
shorter chain the best overlap of bits in the other, as a share of what lies between the overlap of
unrelated filters and the largest possible, averaged.

Entropies are exact integers: the count of a byte among the 63 before it and behind it says how the
sum of c log2 c changes when a window moves by one byte, so all windows of a slice follow from
63 comparisons of the slice with itself.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from closingbell.llm import common

WINDOW = 64
CLASSES = 1000
VOTES = 16
#: So many windows of a text are features whatever their votes, if so many have any.
LEAST_FEATURES = 8
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
SLICE_BYTES = 1 << 18
BUCKET_BYTES = 16 << 20

#: How c log2 c grows with the c-th equal byte, in millionths.
_GROWTH = np.zeros(WINDOW + 1, np.int64)
_GROWTH[1:] = np.diff(np.round(1e6 * np.arange(WINDOW + 1) * np.log2(np.maximum(1, np.arange(WINDOW + 1)))).astype(np.int64))
_MOST = int(_GROWTH.sum())


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """Class (0 to CLASSES) of the window of 64 bytes from each position on."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    behind, ahead = np.ones(len(data), np.uint8), np.ones(len(data), np.uint8)
    for k in range(1, WINDOW):
        same = data[k:] == data[:-k]
        behind[k:] += same
        ahead[:-k] += same
    first = 0
    for count in np.bincount(data[:WINDOW]).tolist():
        first += int(_GROWTH[1 : count + 1].sum())
    change = _GROWTH[behind[WINDOW:]] - _GROWTH[ahead[: n - 1]]
    total = np.concatenate([[first], first + np.cumsum(change)])
    return (_MOST - total) * CLASSES // _MOST


def _valid(offsets: np.ndarray, n: int) -> np.ndarray:
    """Window positions that lie within one text."""
    ok = np.ones(n, bool)
    for edge in offsets[1:-1].tolist():
        ok[max(0, edge - WINDOW + 1) : edge] = False
    return ok


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count = np.zeros(CLASSES + 1, np.int64)
    for batch in batches:
        data, offsets = common.text_bytes(batch["text"])
        for lo, hi in common.slices(offsets, SLICE_BYTES):
            part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            classes = entropy_classes(part)
            count += np.bincount(classes[_valid(at, len(classes))], minlength=CLASSES + 1)
    seen = np.flatnonzero(count)
    yield pa.RecordBatch.from_pydict({"entropy": seen, "windows": count[seen]})


def class_ranks(texts: DataFrame) -> np.ndarray:
    """Rank of each entropy class by its number of windows in the corpus, the fewest first.

    Classes without windows are the most improbable; entropy zero is never a feature and comes
    last. At most CLASSES + 1 rows come to the driver.
    """
    counted = texts.select("text").mapInArrow(_histogram, "entropy long, windows long")
    rows = counted.groupBy("entropy").agg(F.sum("windows").alias("windows")).collect()
    windows = np.zeros(CLASSES + 1, np.int64)
    for entropy, n in rows:
        windows[entropy] = n
    order = np.lexsort((-np.arange(CLASSES + 1), windows))
    rank = np.empty(CLASSES + 1, np.int64)
    rank[order] = np.arange(CLASSES + 1)
    rank[0] = CLASSES + 1
    return rank


# -- digests -------------------------------------------------------------------------

_AT_BITS = 40
_VOID = np.int64(2**62)


def feature_hashes(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the features of all texts, in order, and the text of each.

    A text of fewer than 127 bytes has one run of positions; one of fewer than 64 bytes is a single
    feature, padded with zeros.
    """
    rows = len(offsets) - 1
    size = np.diff(offsets)
    padded = np.zeros(len(data) + 2 * WINDOW, np.uint8)
    padded[: len(data)] = data
    classes = entropy_classes(padded)[: len(data)]
    rank = ranks[classes]
    at = np.arange(len(data), dtype=np.int64)
    left = np.repeat(offsets[1:], size) - at  # bytes to the end of the text
    key = np.where((left >= WINDOW) & (rank <= CLASSES), (rank << _AT_BITS) | at, _VOID)
    votes = np.zeros(len(data), np.int64)
    if len(data):
        wide = np.concatenate([key, np.full(WINDOW, _VOID)])
        least = common.sliding_min(wide, WINDOW)[: len(data)]
        # a run of positions counts if it lies within the text, or if it is the text's only one
        begins = np.repeat(offsets[:-1], size) == at
        counts = (left >= 2 * WINDOW - 1) | (begins & (left >= WINDOW))
        counts &= least < _VOID
        # short texts: the run reaches into the next text, whose positions must not win
        short = np.flatnonzero(begins & (left < 2 * WINDOW - 1) & (left >= WINDOW))
        for i in short.tolist():
            least[i] = key[i : i + left[i] - WINDOW + 1].min()
        counts[short] = least[short] < _VOID
        votes = np.bincount(least[counts] & ((1 << _AT_BITS) - 1), minlength=len(data))
    row = np.repeat(np.arange(rows), size)
    voted = np.flatnonzero(votes)
    best = voted[np.lexsort((-votes[voted], row[voted]))]
    place = np.arange(len(best)) - np.searchsorted(row[best], row[best])
    chosen = best[(votes[best] >= VOTES) | (place < LEAST_FEATURES)]
    lone = np.flatnonzero((size > 0) & (size < WINDOW))
    starts = np.concatenate([chosen, offsets[:-1][lone]])
    owner = np.concatenate([row[chosen], lone])
    order = np.argsort(starts, kind="stable")
    starts, owner = starts[order], owner[order]
    block = padded[starts[:, None] + np.arange(WINDOW)]
    length = np.minimum(size[owner], WINDOW)
    block[np.arange(WINDOW) >= length[:, None]] = 0
    words = np.ascontiguousarray(block).view("<u8")
    hashes = length.astype(np.uint64)
    for k in range(WINDOW // 8):
        hashes = common.mix(hashes * np.uint64(0x9E3779B97F4A7C15) + words[:, k])
    return hashes, owner


def filters(hashes: np.ndarray, owner: np.ndarray, rows: int) -> list[np.ndarray]:
    """The chained Bloom filters of each text, as rows of bytes."""
    begin = np.searchsorted(owner, np.arange(rows))
    count = np.diff(begin, append=len(owner))
    chain = -(-count // FILTER_FEATURES)
    first = np.cumsum(chain) - chain
    bits = np.zeros((int(chain.sum()), FILTER_BITS), bool)
    at = first[owner] + (np.arange(len(owner)) - begin[owner]) // FILTER_FEATURES
    for k in range(HASHES):
        bits[at, (hashes >> np.uint64(11 * k)).astype(np.int64) % FILTER_BITS] = True
    packed = np.packbits(bits, axis=1)
    return np.split(packed, first[1:]) if rows else []


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Normalised bit overlap of two digests: 1 for equal ones, about 0 for unrelated ones."""
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    # a chain is bounded by its text; one row of the table of overlaps is held at a time
    ones_b = np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    total = 0.0
    for one in a:
        ones = int(np.bitwise_count(one).sum())
        shared = np.bitwise_count(one & b).sum(axis=1, dtype=np.int64)
        chance = ones * ones_b / FILTER_BITS
        room = np.maximum(np.minimum(ones, ones_b) - chance, 1e-9)
        total += float(np.clip((shared - chance) / room, 0, 1).max())
    return min(total / len(a), 1.0)


def as_text(digest: np.ndarray) -> str:
    """Number of filters and their bits."""
    return f"{len(digest)}:{base64.b64encode(digest.tobytes()).decode()}"


def from_text(text: str) -> np.ndarray:
    n, _, bits = text.partition(":")
    return np.frombuffer(base64.b64decode(bits), np.uint8).reshape(int(n), FILTER_BITS // 8)


def digests(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """Digests of whole texts."""
    joined = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    out: list[np.ndarray] = []
    for lo, hi in common.slices(offsets, SLICE_BYTES):
        part, at = joined[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        out.extend(filters(*feature_hashes(part, at, ranks), hi - lo))
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """row (a struct of all columns of ``docs``) and fingerprint, the digest of the whole text.

    A null or empty text has no feature and the fingerprint "0:".
    """
    texts = common.texts(docs)
    ranks = class_ranks(texts)
    rows = docs.select(
        common.whole_rows(docs),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = common.text_bytes(batch["text"])
            for lo, hi in common.slices(offsets):
                raw = data[offsets[lo] : offsets[hi]].tobytes()
                at = (offsets[lo : hi + 1] - offsets[lo]).tolist()
                made = digests([raw[a:b] for a, b in zip(at, at[1:])], ranks)
                yield pa.RecordBatch.from_arrays(
                    [batch["row"].slice(lo, hi - lo), pa.array([as_text(d) for d in made], pa.string())], ["row", "fingerprint"]
                )

    return rows.mapInArrow(found, common.beside_row(rows, "fingerprint string"))


# -- a text, its edit and the next text ----------------------------------------------

_COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(text: str, other: str) -> str:
    """The last third (rounded down) replaced by as many first characters of another text, or all."""
    n = len(text) // 3
    return text[: len(text) - n] + other[:n]


def _compared(ranks: np.ndarray):
    """Rows sorted by bucket and downwards by doc_id; behind a bucket's own rows stands the first
    row of the next bucket, which is only looked at."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int | None, str]]:
        for batch in batches:
            yield from zip(*(batch[name].to_pylist() for name in ("bucket", "guest", "doc_id", "text")))

    def told(part: list[tuple[int | None, str]]) -> pa.RecordBatch:
        """All rows of ``part`` but the last, each against its successor."""
        changed = [edited(a[1], b[1]).encode() for a, b in zip(part, part[1:])]
        plain = digests([text.encode() for _, text in part], ranks)
        other = digests(changed, ranks)
        columns = [
            [doc for doc, _ in part[:-1]],
            [len(text) for _, text in part[:-1]],
            [hashlib.sha256(text).hexdigest() for text in changed],
            [as_text(d) for d in plain[:-1]],
            [as_text(d) for d in other],
            [likeness(a, b) for a, b in zip(plain, other)],
            [likeness(a, b) for a, b in zip(plain, plain[1:])],
        ]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [c.split()[0] for c in _COMPARED.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: list[tuple[int | None, str]] = []
        bucket, size, closed = None, 0, False
        for at, guest, doc, text in rows(batches):
            if at != bucket:
                if len(part) > 1:
                    yield told(part)
                part, size, closed, bucket = [], 0, False, at
            if closed:
                continue  # equal rows can be the first one together; one is enough
            part.append((doc, text))
            size += len(text)
            closed = guest > 0
            if size >= common.SLICE_BYTES and len(part) > 1:
                yield told(part)
                part, size = part[-1:], len(part[-1][1])
        if len(part) > 1:
            yield told(part)

    return found


def compare_edited(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last third replaced by the beginning of the next document's, in
    descending order of doc_id; after the last comes the first. Returns doc_id, n_chars (code
    points), edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next (likeness to
    the edited text's and the next document's fingerprint), a row for each row of ``docs``. A null
    text is empty. Rows with the same doc_id are ordered by a hash of their text; null ids come
    last. A single document is its own next one. Other columns are ignored.

    Documents are dealt out by ranges of doc_id (buckets of about ``bucket_bytes`` of text) and
    sorted there. A bucket also gets the first document of the one behind it. The driver holds a
    few numbers for each bucket.
    """
    texts = common.texts(docs)
    ranks = class_ranks(texts)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shares = [i * bucket_bytes / size for i in range(1, -(-size // bucket_bytes))]
    cuts = texts.agg(F.percentile_approx("doc_id", shares, 10 * len(shares) + 100)).first()[0] if shares else None
    bounds = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def bucket_of(doc_id: pd.Series) -> pd.Series:
        at = np.searchsorted(bounds, doc_id.fillna(0).astype("int64"), side="right")
        return pd.Series(np.where(doc_id.isna(), len(bounds) + 1, len(bounds) - at).astype(np.int32))

    placed = texts.select(bucket_of("doc_id").alias("bucket"), "doc_id", F.xxhash64("text").alias("hash"), "text")
    # the complement falls as the id rises, for every id
    order = F.struct(F.bitwise_not("doc_id").alias("down"), F.col("hash").alias("hash"))
    firsts = placed.groupBy("bucket").agg(F.min(order).alias("first")).orderBy("bucket").collect()
    hosts = [(row["bucket"], firsts[i - 1]["bucket"], row["first"]["down"], row["first"]["hash"]) for i, row in enumerate(firsts)]
    # a row for each bucket
    guests = docs.sparkSession.createDataFrame(hosts, "bucket int, host int, down long, first_hash long")
    is_first = F.bitwise_not("doc_id").eqNullSafe(F.col("down")) & (F.col("hash") == F.col("first_hash"))
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("guest"))
    lent = F.struct(F.col("host").alias("bucket"), F.lit(1).alias("guest"))
    seats = F.explode(F.when(is_first, F.array(own, lent)).otherwise(F.array(own))).alias("seat")
    seated = placed.join(F.broadcast(guests), "bucket").select(seats, "doc_id", "hash", "text")
    seated = seated.select("seat.bucket", "seat.guest", "doc_id", "hash", "text")
    sorted_rows = seated.repartitionById(len(bounds) + 2, F.col("bucket")).sortWithinPartitions(
        "bucket", "guest", F.desc_nulls_last("doc_id"), "hash", "text"
    )
    return sorted_rows.mapInArrow(_compared(ranks), _COMPARED)
