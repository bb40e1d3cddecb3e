"""Token ids: Re-Pair files and the shared-prefix walk, against the public libraries."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import llm_cases as cases
from closingbell.llm import common, repair, shared_viterbi
from test_repeats import collected

ODD = "aB cdéËİ'st 're\n\t\x1c\x85\xa0<|endoftext|>12漢.,!ñé́▁🙂\r{};()"


def odd_texts(n=1500):
    rng = random.Random(1)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 60))) for _ in range(n)]
    return texts + ["", " ", "a", "ΑΣ ΑΣ. ς", "x́., y", " " * 40 + "z", "a" * 3000, "0" * 99, "don't. won't! it's;", "!" * 50]


# -- grammar -------------------------------------------------------------------------


def shard_of(ids, sizes, first_rule, least):
    row = repair.shard_row(list(range(len(sizes))), ids, sizes, first_rule, least)
    return repair.Shard(row, first_rule)


@pytest.mark.parametrize("width", [1, 7, 16, 17, 32])
def test_packed_values_come_back_from_any_place(width):
    values = np.random.default_rng(width).integers(0, 2**width, 70_001).astype(np.uint32)
    raw = repair.packed(values, width)
    assert len(raw) == -(-len(values) * width // 8)
    for start, stop in ((0, len(values)), (3, 5), (65_530, 65_560), (70_001, 70_001)):
        assert (repair.unpacked(raw, width, start, stop) == values[start:stop]).all()


def test_grammar_goes_on_while_it_pays():
    """At production settings no pair is left that a rule would pay for, and rules beyond 16 bits work."""
    rng = np.random.default_rng(3)
    phrases = rng.integers(0, repair.VOCABULARY, (30_000, 2))
    ids = phrases[rng.integers(0, len(phrases), 400_000)].ravel()
    symbols, ends, rules = repair.compress(ids, np.array([len(ids)]))
    assert len(rules) + repair.VOCABULARY > 1 << 16
    assert repair.stored_bits(len(symbols), len(rules)) < 0.7 * repair.stored_bits(len(ids), 0)
    shard = repair.Shard(repair.shard_row([1], ids, np.array([len(ids)])))
    assert (shard.documents()[0] == ids).all() and (shard.document(0, 1001, 77) == ids[1001:1078]).all()


def test_new_words_reach_the_library_in_lines():
    """Words with letters beyond ASCII, or with marks behind them, are not encoded one by one."""
    tokenizer = repair.WordTokenizer(public_tokenizers.path(repair.TOKENIZER))
    library, texts = tokenizer.library, []

    class Watched:
        def encode_batch_fast(self, some, **settings):
            texts.extend(some)
            return library.encode_batch_fast(some, **settings)

    tokenizer.library = Watched()
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeéñü", k=8)) + rng.choice(["", "###", ",%%%", "."]) for _ in range(2000)]
    words += ["it's", "<|endoftext|>", "a\u0301=", "İa", "क़", "x²"]
    data, offsets = common.text_bytes(pa.array([" ".join(words)]))
    ids, sizes = tokenizer.encode(data, offsets, repair.END)
    assert ids.tolist() == library.encode(" ".join(words), add_special_tokens=False).ids + [repair.END]
    assert sizes.tolist() == [len(ids)] and len(texts) < 1000


def test_grammar_rounds_leave_out_pairs_with_too_few_uses(monkeypatch):
    """Ids whose pairs are all different are counted once, not in every round."""
    rng = np.random.default_rng(5)
    once = rng.permutation(40_000)
    ids = np.concatenate([once, np.tile(rng.integers(40_000, 49_000, 64), 64)]).astype(np.uint32)
    counted, flatnonzero = [], np.flatnonzero
    monkeypatch.setattr(np, "flatnonzero", lambda a: (counted.append(len(a)), flatnonzero(a))[1])
    sizes = np.array([40_000, 4096])
    row = repair.shard_row([1, 2], ids, sizes)
    assert sum(n > 10_000 for n in counted) < 20
    monkeypatch.undo()
    assert (repair.Shard(row).documents()[0] == ids).all()


def test_extreme_and_null_ids_in_files(session):
    rows = [(None, "z y"), (2**63 - 1, "a b"), (-(2**63), "c"), (None, None), (0, "d")]
    library = Tokenizer.from_file(public_tokenizers.path(repair.TOKENIZER))
    for some in (rows, [(None, t) for _, t in rows]):
        docs = session.createDataFrame(some, "doc_id long, text string").repartition(3)
        found = repair.written_digests(docs, shard_tokens=3).collect()
        assert cases.ordered(found) == cases.ordered(cases.token_digests(some, library))


@pytest.mark.parametrize("seed", range(25))
def test_grammar_round_trip(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, 60, rng.integers(1, 12))
    ids = rng.integers(0, rng.integers(1, 6), sizes.sum())
    shard = shard_of(ids, sizes, 10, 2)
    assert (shard.documents()[0] == ids).all()
    for i, (end, size) in enumerate(zip(np.cumsum(sizes), sizes)):
        own = ids[end - size : end]
        assert (shard.document(i) == own).all()
        if size:
            start = int(rng.integers(0, size))
            count = int(rng.integers(0, size - start + 1))
            assert (shard.document(i, start, count) == own[start : start + count]).all()


def test_grammar_replaces_frequent_pairs():
    ids = np.tile([7, 8, 9, 7, 8, 5], 400)
    symbols, ends, rules = repair.compress(ids, np.array([len(ids)]), first_rule=10, least=4)
    assert len(symbols) < len(ids) / 20
    assert [7, 8] in rules.tolist()


def test_pairs_do_not_cross_documents():
    sizes = np.ones(500, np.int64)
    symbols, ends, rules = repair.compress(np.tile([1, 2], 250), np.cumsum(sizes), first_rule=10, least=2)
    assert len(rules) == 0 and (ends == np.arange(1, 501)).all()


def test_word_tokenizer_is_the_library():
    path = public_tokenizers.path(repair.TOKENIZER)
    texts = odd_texts()
    wanted = [[*e.ids, 2] for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    tokenizer = repair.WordTokenizer(path)
    data, offsets = common.text_bytes(pa.array(texts))
    for lo, hi in common.slices(offsets, 5000):
        ids, sizes = tokenizer.encode(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], 2)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == wanted[lo:hi]


@pytest.mark.parametrize("shard_tokens", [50, repair.SHARD_TOKENS])
def test_files(awkward, small, shard_tokens):
    library = Tokenizer.from_file(public_tokenizers.path(repair.TOKENIZER))
    for docs in (awkward, small):
        found = repair.written_digests(docs, shard_tokens=shard_tokens).collect()
        assert sorted(map(tuple, found), key=lambda r: r[1]) == cases.token_digests(collected(docs), library)


def test_files_of_an_empty_table(nothing):
    assert repair.written_digests(nothing).collect() == []


# -- shared prefixes -----------------------------------------------------------------


@pytest.fixture(scope="module")
def viterbi():
    return shared_viterbi.Viterbi(public_tokenizers.path(shared_viterbi.MODEL))


def encoded(viterbi, texts):
    data, offsets = common.text_bytes(pa.array(texts, pa.string()))
    out = []
    for lo, hi in common.slices(offsets, 100_000):
        ids, size = viterbi.encode(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        out += np.split(ids, np.cumsum(size)[:-1])
    return out


def test_walk_is_the_library(viterbi, small):
    texts = odd_texts() + [t for _, t in collected(small)] + ["\n\n x", "a.b.c,d", "▁▁ x▁▁y\n▁▁z  w", ". .a ,b"]
    wanted = viterbi.model.encode(texts, num_threads=1)
    assert [ids.tolist() for ids in encoded(viterbi, texts)] == wanted


def test_prefixes_are_shared(viterbi):
    words = sorted({"▁interest", "▁interesting", "▁interested", "▁in", "▁other"})
    walked = list(viterbi.walk(words))
    assert [w for w, _, _ in walked] == words
    for word, pieces, score in walked:
        assert "".join(pieces) == word
        assert score == sum(viterbi.score[p] for p in pieces)
        assert list(viterbi.walk([word])) == [(word, pieces, score)]


def test_round_trip(viterbi):
    texts = odd_texts()
    decoder = shared_viterbi.Decoder(public_tokenizers.path(shared_viterbi.MODEL))
    ids = encoded(viterbi, texts)
    assert decoder(np.concatenate(ids), np.cumsum([len(x) for x in ids])) == [t.replace("▁", " ") for t in texts]
    assert decoder(np.array([1, 2]), np.array([0, 2])) == ["", ""]


def test_encode_and_decode_rows(awkward, nothing, viterbi):
    decoded = shared_viterbi.decode(shared_viterbi.encode(awkward)).collect()
    assert len(decoded) == awkward.count()
    for row in decoded:
        text = row["row"]["text"] or ""
        assert row["ids"] == viterbi.model.encode(text, num_threads=1)
        assert row["decoded"] == text.replace("▁", " ")
        assert row["ids_crc32"] == zlib.crc32(np.array(row["ids"], "<u4").tobytes())
    assert shared_viterbi.decode(shared_viterbi.encode(nothing)).collect() == []
