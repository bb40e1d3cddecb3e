"""The registered queries against their SQL, and the pipeline against brute force stage by stage."""

import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as entry
import compare
import corpus_pipeline
import llm_cases as cases
from closingbell.llm import oracle, queries
from test_repeats import collected

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(oracle.SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_matches_sql(session, duck, name):
    assert compare.mismatch(duck, entry.queries()[name](session, SF), oracle.SQL[name]) is None


def test_stages_against_brute_force(session):
    """Each stage on what the one before it kept."""
    docs = session.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "simhash", "decontamination", "sentencepiece"]

    scores = {r["doc_id"]: r["predicted"] for r in queries.callables()["op6_levenshtein_lexicon"](session, SF).collect()}
    kept = stages["toxicity"](session, docs, SF)
    rows = collected(kept)
    assert kept.columns == columns and {d for d, _ in rows} == {d for d, p in scores.items() if not p}

    kept = stages["line_dedup"](session, kept, SF)
    wanted = [(d, t) for d, t, *_ in cases.kept_lines(rows)]
    rows = collected(kept)
    assert kept.columns == columns and sorted(rows) == sorted(wanted)

    kept = stages["simhash"](session, kept, SF)
    firsts = {g[2] for g in cases.near_groups(rows)}
    wanted = [r for r in rows if r[0] in firsts]
    rows = collected(kept)
    assert kept.columns == columns and sorted(rows) == sorted(wanted)

    kept = stages["decontamination"](session, kept, SF)
    benchmark = session.read.parquet(f"{SF}/benchmark.parquet")
    bad = {r[0] for r in cases.contained(rows, [tuple(r) for r in benchmark.select("item_id", "text").collect()])}
    wanted = [r for r in rows if r[0] not in bad]
    rows = collected(kept)
    assert bad and kept.columns == columns and sorted(rows) == sorted(wanted)

    encoded = stages["sentencepiece"](session, kept, SF).collect()
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted((r["doc_id"], r["ids"]) for r in encoded) == sorted((d, model.encode(t, num_threads=1)) for d, t in rows)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in encoded)

    whole = corpus_pipeline.run(session, SF).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, encoded))


def test_pipeline_of_an_empty_table(session, nothing, tmp_path):
    nothing.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        session.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(session, str(tmp_path)).collect() == []


def test_stages_keep_clashing_columns(session, awkward):
    docs = awkward
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(session, docs, SF)
        assert docs.columns == awkward.columns
    assert corpus_pipeline.STAGES[-1][1](session, docs, SF).count() == docs.count() > 0
