"""Exact duplicates by the stream's state against a plain grouping."""

import hashlib

import pytest
from pyspark.sql import functions as F

import llm_cases as cases
from closingbell.llm import exact_stream
from closingbell.llm.common import stored


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for text, ids in groups.items():
        least = max(ids, key=lambda d: (d is not None, d or 0))
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(d, least, len(ids), digest) for d in ids]
    return out


def folder_of(df):
    return df.sparkSession, df.inputFiles()[0].rsplit("/", 1)[0]


def without_kept(rows):
    return [(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows]


def check(found, rows):
    assert cases.ordered(without_kept(found)) == cases.ordered(brute(rows))
    stay = {}
    for r in found:
        stay.setdefault(r["text_sha256"], []).append(r)
    for group in stay.values():
        kept = [r for r in group if r["kept"]]
        assert len(kept) == 1 and kept[0]["doc_id"] == kept[0]["keep_id"]


@pytest.mark.parametrize("files_at_once", [None, 1])
def test_awkward(awkward, files_at_once):
    session, path = folder_of(stored(awkward, "docs"))
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    check(exact_stream.exact_groups(session, path, files_at_once=files_at_once).collect(), rows)


def test_bytes_are_compared_on_hits(awkward):
    """A digest of one letter hits all the time; only equal texts are put together."""
    session, path = folder_of(stored(awkward, "docs"))
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    weak = lambda text: F.substring(F.sha2(text, 256), 1, 1)
    check(exact_stream.exact_groups(session, path, digest=weak).collect(), rows)


def test_state_goes_on(session, tmp_path):
    """Files that come later meet what the state holds; files seen are not read again."""
    path, state = str(tmp_path / "docs"), str(tmp_path / "state")
    frame = lambda rows: session.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    frame([(1, "a"), (2, "b"), (3, None)]).write.parquet(path)
    exact_stream.absorb(session, path, state)
    first = {r["digest"]: r for r in exact_stream.entries(session, state).collect()}
    assert sorted(r["group_size"] for r in first.values()) == [1, 1, 1]
    frame([(9, "a"), (0, "b"), (4, "")]).write.mode("append").parquet(path)
    found = exact_stream.exact_groups(session, path, state).collect()
    check(found, [(1, "a"), (2, "b"), (3, None), (9, "a"), (0, "b"), (4, "")])
    held = {r["digest"]: r for r in exact_stream.entries(session, state).collect()}
    assert sorted(r["group_size"] for r in held.values()) == [2, 2, 2]
    a = bytes.fromhex(hashlib.sha256(b"a").hexdigest())
    assert held[a]["stays"]["doc_id"] == 9 and held[a]["stays"]["file"] != first[a]["stays"]["file"]


def test_empty_table(session, nothing, tmp_path):
    nothing.coalesce(1).write.parquet(str(tmp_path / "docs"))
    assert exact_stream.exact_groups(session, str(tmp_path / "docs")).collect() == []


def test_no_python_in_the_plans(awkward):
    session, path = folder_of(stored(awkward, "docs"))
    plan = exact_stream.exact_groups(session, path)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
