"""What the whole corpus knows about keys that groups of documents hold.

A group sends its distinct 64-bit keys, sorted, as packed arrays: one row for each slot, a slot being a
range of keys. The task of a slot sees every group's keys of its range and answers each group, in
the order of that group's keys, so an answer needs no keys. Slots grow with the input, so a task holds
about ``SLOT_BYTES`` of text's worth of keys whatever the size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from closingbell.llm import common

SLOT_BYTES = 8 << 20


def slot_bits(text_bytes: int, slot_bytes: int = SLOT_BYTES) -> int:
    """Leading bits of a key that name its slot."""
    return max(0, -(-text_bytes // slot_bytes) - 1).bit_length()


def _cuts(keys: np.ndarray, bits: int) -> list[int]:
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).tolist()


def sent(keys: np.ndarray, bits: int, key_bytes: int, **values) -> dict[str, list]:
    """Columns ``slot``, ``keys`` and the values, a row for every slot; ``keys`` are sorted.

    Of a key, ``key_bytes`` behind the bits of its slot are sent. As slots grow with the input, two
    keys of a slot share them about as rarely at any size: of 4 bytes once in some thousand keys, of
    6 once in some hundred million.
    """
    cuts = _cuts(keys, bits)
    rest = (keys << np.uint64(bits)) >> np.uint64(64 - 8 * key_bytes)
    raw = np.ascontiguousarray(rest, "<u8").view(np.uint8).reshape(-1, 8)[:, :key_bytes]
    out = {"slot": list(range(1 << bits)), "keys": [raw[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]}
    for name, array in values.items():
        pack = flags if array.dtype == bool else narrow if array.dtype == np.int64 else np.ndarray.tobytes
        out[name] = [pack(array[a:b]) for a, b in zip(cuts, cuts[1:])]
    return out


def flags(values: np.ndarray) -> bytes:
    return np.packbits(values).tobytes()


def narrow(values: np.ndarray) -> bytes:
    """64-bit numbers as differences from the least, in 1, 2 or 4 bytes each if they fit."""
    if not len(values):
        return b""
    least, span = int(values.min()), int(values.max()) - int(values.min())
    width = next((w for w in (1, 2, 4) if span < 1 << 8 * w), 8)
    if width == 8:
        return b"\x08" + bytes(8) + values.tobytes()
    return bytes([width]) + least.to_bytes(8, "little", signed=True) + (values - least).astype(f"<u{width}").tobytes()


def widened(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.int64)
    if raw[0] == 8:
        return np.frombuffer(raw, np.int64, offset=9)
    return np.frombuffer(raw, f"<u{raw[0]}", offset=9).astype(np.int64) + int.from_bytes(raw[1:9], "little", signed=True)


def keys_of(table: pa.Table, key_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all rows, and where each row's begin."""
    raw = table["keys"].to_pylist()
    begin = np.concatenate([[0], np.cumsum([len(x) // key_bytes for x in raw])]).astype(np.int64)
    wide = np.zeros((int(begin[-1]), 8), np.uint8)
    wide[:, :key_bytes] = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, key_bytes)
    return wide.view("<u8").ravel(), begin


def flagged(raw: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=count).astype(bool)


def numbers_of(table: pa.Table, name: str) -> np.ndarray:
    """The numbers of all rows of a column."""
    return np.concatenate([np.zeros(0, np.int64), *map(widened, table[name].to_pylist())])


def answered(table: pa.Table, name: str) -> np.ndarray:
    """A group's answers in numbers, for its sorted keys."""
    order = np.argsort(table["slot"].to_numpy(), kind="stable")
    return numbers_of(table.take(order), name)


def answered_flags(table: pa.Table, name: str, keys: np.ndarray, bits: int) -> np.ndarray:
    """A group's answers of one bit, for its sorted keys."""
    cuts, raw = _cuts(keys, bits), dict(zip(table["slot"].to_pylist(), table[name].to_pylist()))
    parts = [flagged(raw[slot], b - a) for slot, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def by_slot(rows: DataFrame, judge: Callable[[pa.Table], pa.Table], schema: str, bits: int, *more: str) -> DataFrame:
    """The slots' answers to the groups; ``more`` columns part slots further."""
    tasks = min(1 << bits, common.MOST_TASKS)
    return rows.repartition(tasks, "slot", *more).groupBy("slot", *more).applyInArrow(judge, schema)
