"""The corpus pipeline: stages over ``documents``, each an operator of ``closingbell.llm``.

A stage takes what the one before it kept, as a table with the columns of documents, and its
decisions take effect: toxic documents go, repeated line chunks are taken out of texts, one document
of each near-duplicate group stays, documents that contain a benchmark item go, and the last stage
encodes what is left. A document whose lines all repeat others is an empty text after the second
stage; the third keeps one of the empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from closingbell.llm import bktree, containment, line_chunks, shared_viterbi, toxicity
from closingbell.llm.common import read, ship, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.clean_rows(docs, read(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return line_chunks.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bktree.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return containment.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, their number and digest, and whether they decode to the text itself."""
    ship(spark)
    decoded = shared_viterbi.round_trip(docs.select("doc_id", "text"))
    return decoded.select(
        "row.doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids_crc32",
        (F.col("decoded") == F.coalesce("row.text", F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]
#: Learned scores and sketches stand between the stages; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage reads what the one before it wrote."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
