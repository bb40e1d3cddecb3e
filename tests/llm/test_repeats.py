"""Repeated substrings: byte index, word windows, line chunks, against brute force."""

import random
from collections import Counter

import pytest

import llm_cases as cases
from closingbell.llm import common, doubling, line_chunks, rlbwt


def collected(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("window", [5, 9, 30])
def test_index_finds_all_long_matches(window):
    rng = random.Random(window)
    for _ in range(20):
        strings = [bytes(rng.choices(b"ab\x00", k=rng.randint(1, 60))) for _ in range(rng.randint(1, 8))]
        strings += [s[2:] for s in strings[:2] if len(s) > 2]
        seen = Counter(s[i : i + window] for s in strings for i in range(len(s) - window + 1))
        wanted = [[i for i in range(len(s) - window + 1) if seen[s[i : i + window]] > 1] for s in strings]
        assert [m.tolist() for m in rlbwt.long_matches(strings, window)] == wanted


def test_index_is_run_length_compressed():
    text = b"".join(random.Random(1).choices([b"abracadabra", b"xyz"], k=30))
    index = rlbwt.RunLengthIndex(rlbwt.np.frombuffer(text * 8, "u1"), rlbwt.np.arange(1, 9) * len(text))
    assert index.run_lengths.sum() == len(text) * 8
    assert len(index.heads) < 2 * len(text)
    assert set(index.sample_first) >= set(range(0, len(text) * 8, len(text)))


def test_index_sorts_only_suffixes_that_share_a_prefix(monkeypatch):
    """Random bytes are told apart by their first ones; only those that other strings hold go on."""
    np, rng, ordered = rlbwt.np, random.Random(2), []
    own = rlbwt.RunLengthIndex._ordered
    monkeypatch.setattr(
        rlbwt.RunLengthIndex, "_ordered", staticmethod(lambda *a: (ordered.append(len(a[1])), own(*a))[1])
    )
    strings = [rng.randbytes(500) for _ in range(40)]
    strings += [strings[0][100:] + b"x", strings[1][:400]]
    ends = np.cumsum([len(s) for s in strings])
    index = rlbwt.RunLengthIndex(np.frombuffer(b"".join(strings), "u1"), ends)
    assert len(index.levels) == len(ordered) + 1 > 5 and max(ordered) < 1700
    # the same order where places and numbers need argsort
    number, ahead = np.array([0, 0, 1, 1]), np.array([7, 3, 5, 1])
    assert own(number, ahead, 8).tolist() == own(number, ahead, 1 << 61).tolist() == [1, 0, 3, 2]


# a hot key's windows are dealt out by their hash instead of being indexed
@pytest.mark.parametrize("settings", [{}, {"shard_contexts": 1, "chunk_bytes": 20_000}])
def test_bytes_awkward(awkward, settings):
    found = rlbwt.remove_repeats(awkward, window=60, gram=16, **settings).collect()
    assert cases.ordered(found) == cases.ordered(cases.repeated_bytes(collected(awkward), 60))


def test_bytes_small(small):
    found = rlbwt.remove_repeats(small, chunk_bytes=100_000).collect()
    assert cases.ordered(found) == cases.ordered(cases.repeated_bytes(collected(small), 200))
    assert sum(r["n_removed"] for r in found) > 0


@pytest.mark.parametrize("chunk_bytes", [20_000, common.CHUNK_BYTES])
def test_words_awkward(awkward, chunk_bytes):
    found = doubling.remove_repeats(awkward, chunk_bytes=chunk_bytes).collect()
    assert cases.ordered(found) == cases.ordered(cases.repeated_words(collected(awkward), doubling.WINDOW))


def test_words_small(small):
    found = doubling.remove_repeats(small, window=5, chunk_bytes=100_000).collect()
    assert cases.ordered(found) == cases.ordered(cases.repeated_words(collected(small), 5))


@pytest.mark.parametrize("start", [1, 2, 4, 13])
def test_words_by_any_first_level(small, start):
    found = doubling.remove_repeats(small, start=start, chunk_bytes=100_000).collect()
    assert cases.ordered(found) == cases.ordered(cases.repeated_words(collected(small), 13))
    assert sum(r["n_removed"] for r in found) > 0


def test_levels_double_up_to_the_window():
    assert doubling.levels(13) == [4, 8, 13] and doubling.levels(3) == [3] and doubling.levels(13, 1) == [1, 2, 4, 8, 13]


def test_words_of_extreme_and_null_ids(session):
    """The largest id comes before a null one, the least first; also with all ids null."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(2**63 - 1, text), (None, "x " + text), (None, "y " + text), (5, None)]
    least = [*rows, (-(2**63), "a " + text)]
    for some in (rows, least, [(None, t) for _, t in rows]):
        docs = session.createDataFrame(some, "doc_id long, text string")
        for size in (10, common.CHUNK_BYTES):
            found = doubling.remove_repeats(docs, chunk_bytes=size).collect()
            assert cases.ordered(found) == cases.ordered(cases.repeated_words(some, 13))


def test_judges_carry_runs_over_batches():
    """Runs of one key cut into batches of one row give the same answers as one batch."""
    import pyarrow as pa

    rng = random.Random(3)
    rows = sorted((rng.randint(0, 3), rng.randint(0, 2), rng.randint(0, 9)) for _ in range(60))
    columns = dict(zip(("key", "ctx", "doc_id"), map(list, zip(*rows))))
    whole = pa.RecordBatch.from_pydict(columns)
    for judge, names in ((rlbwt._judge, "who"),):
        batch = whole.rename_columns(["key", "ctx", names])
        one = sorted(tuple(r.values()) for b in judge(iter([batch])) for r in b.to_pylist())
        cut = [batch.slice(i, 1) for i in range(len(rows))]
        many = sorted(tuple(r.values()) for b in judge(iter(cut)) for r in b.to_pylist())
        assert one == many


def test_lines_awkward(awkward):
    found = line_chunks.mark_lines(awkward, chunk_bytes=20_000).select("row.doc_id", "text", "n_lines", "n_removed").collect()
    assert cases.ordered(found) == cases.ordered(cases.kept_lines(collected(awkward)))


def test_lines_small(small):
    found = line_chunks.mark_lines(small).select("row.doc_id", "text", "n_lines", "n_removed").collect()
    assert cases.ordered(found) == cases.ordered(cases.kept_lines(collected(small)))


def test_lines_keep_columns(awkward):
    found = line_chunks.dedup_lines(awkward)
    assert found.columns == awkward.columns
    assert all(r["n_chars"] == len(r["text"]) for r in found.collect())


def test_line_marks_survive_shifts():
    lines = [f"line {random.Random(i).random()}".encode() for i in range(200)]
    plain = set(line_chunks.chunk_starts(lines))
    shifted = {b - 7 for b in line_chunks.chunk_starts([b"new %d" % i for i in range(7)] + lines)}
    assert {b for b in plain if b > 1} <= shifted
    assert all({i, i + 1} & plain for i in range(198))


@pytest.mark.parametrize("operator", [rlbwt.remove_repeats, doubling.remove_repeats, line_chunks.mark_lines])
def test_empty_table(nothing, operator):
    assert operator(nothing).collect() == []


def blocks_of_lines():
    """Texts of which every second holds 4 to 8 lines of an earlier one, elsewhere, and which those are."""
    rng = random.Random(8)
    new = lambda n: [f"line {rng.random()}" for _ in range(n)]
    texts, passages = [], []
    for i in range(400):
        lines = new(rng.randint(5, 12))
        if i % 2:
            source = texts[rng.randrange(0, i, 2)]
            n = rng.randint(4, min(8, len(source))) if len(source) > 4 else 4
            at = rng.randint(0, len(source) - n)
            passage, own = source[at : at + n], rng.randint(0, len(lines))
            lines[own:own] = passage
            passages.append((i, passage))
        texts.append(lines)
    return texts, passages


def test_lines_recall_of_repeated_blocks(session):
    """Every block of four or more lines that stands in an earlier text goes, and nothing else."""
    texts, passages = blocks_of_lines()
    docs = session.createDataFrame([(i, "\n".join(lines)) for i, lines in enumerate(texts)], "doc_id long, text string").repartition(3)
    found = line_chunks.mark_lines(docs, chunk_bytes=20_000).select("row.doc_id", "text", "n_removed").collect()
    kept = {r["doc_id"]: r["text"].split("\n") for r in found}
    gone = {i: [x for x in lines if x not in set(kept[i])] for i, lines in enumerate(texts)}
    assert all(len(gone[r["doc_id"]]) == r["n_removed"] for r in found)
    repeated = dict(passages)
    assert gone == {i: repeated.get(i, []) for i in range(len(texts))}
    assert {x for lines in kept.values() for x in lines} == {x for lines in texts for x in lines}


def test_lines_of_extreme_and_null_ids(session):
    """The largest id comes before a null one, and both behind others; also with all ids null."""
    block = "\n".join(f"line {i}" for i in range(5))
    rows = [(2**63 - 1, block), (None, block), (-(2**63), "x\n" + block), (None, None)]
    schema = "doc_id long, text string, `a.b` int, `c``d` int"
    for some in (rows, [(None, t) for _, t in rows]):
        docs = session.createDataFrame([(*r, 1, 2) for r in some], schema)
        found = line_chunks.mark_lines(docs).select("row.doc_id", "text", "n_lines", "n_removed").collect()
        assert cases.ordered(found) == cases.ordered(cases.kept_lines(some))
        assert line_chunks.dedup_lines(docs).columns == docs.columns
