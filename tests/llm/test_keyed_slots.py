"""Packed keys and answers."""

import numpy as np
import pyarrow as pa
import pytest

from closingbell.llm import keyed_slots as ks


def test_slots_follow_the_input():
    assert [ks.slot_bits(n, 8) for n in (0, 1, 8, 9, 16, 17, 64, 65)] == [0, 0, 0, 1, 1, 2, 3, 4]


@pytest.mark.parametrize("bits", [0, 1, 5])
@pytest.mark.parametrize("key_bytes", [4, 6, 8])
def test_keys_come_back_by_slot(bits, key_bytes):
    keys = np.unique(np.random.default_rng(1).integers(0, 2**64, 500, np.uint64))
    rows = ks.sent(keys, bits, key_bytes, odd=(keys % np.uint64(2)).astype(bool), n=np.arange(len(keys)))
    table = pa.table({k: pa.array(v) for k, v in rows.items()})
    rest, begin = ks.keys_of(table, key_bytes)
    slot = np.repeat(np.arange(1 << bits, dtype=np.uint64), np.diff(begin))
    wanted = keys >> np.uint64(max(0, 64 - bits - 8 * key_bytes)) if bits + 8 * key_bytes < 64 else keys
    whole = (slot << np.uint64(8 * key_bytes)) | rest if 8 * key_bytes + bits <= 64 else None
    if whole is not None:
        assert (whole == wanted).all()
    shuffled = table.take(np.random.default_rng(2).permutation(len(table)))
    assert (ks.answered(shuffled, "n") == np.arange(len(keys))).all()
    assert (ks.answered_flags(shuffled, "odd", keys, bits) == (keys % np.uint64(2) == 1)).all()


@pytest.mark.parametrize("values", [[], [7], [-5, 250], [0, 70_000], [2**40, 2**40 + 2**31], [-(2**63), 2**63 - 1]])
def test_numbers_keep_their_values(values):
    array = np.array(values, np.int64)
    assert ks.widened(ks.narrow(array)).tolist() == values
    assert len(ks.narrow(array)) <= 9 + 8 * len(values)
