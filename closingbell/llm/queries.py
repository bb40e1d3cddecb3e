"""One query for each numbered operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from closingbell.llm import bktree, containment, digest, doubling, entropy_difference, exact_stream, line_chunks, prefix_tour, repair, rlbwt, shared_lists, shared_viterbi, toxicity
from closingbell.llm.common import read, ship


def op1_improbable_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.compare_edited(read(spark, sf_dir, "documents"))


def op2_repair_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.written_digests(read(spark, sf_dir, "documents"))


def op3_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = line_chunks.mark_lines(read(spark, sf_dir, "documents"))
    return marked.select("row.doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = entropy_difference.score(docs, read(spark, sf_dir, "labels"))
    bits = [F.round(name, 6).alias(name) for name in ("target_loss", "background_loss", "difference")]
    return scored.select("row.doc_id", "n_tokens", *bits)


def op5_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlbwt.remove_repeats(read(spark, sf_dir, "documents"))


def op6_levenshtein_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_level_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubling.remove_repeats(read(spark, sf_dir, "documents"))


def op8_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that contains a benchmark item, with the item."""
    return containment.contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_shared_prefix_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = shared_viterbi.round_trip(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return decoded.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids_crc32",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("row.text", F.lit(""))).alias("round_trip"),
    )


def op10_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bktree.near_duplicates(read(spark, sf_dir, "documents"))


def op11_euler_tour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation begins with up to five turns of the first one of its hundred."""
    shared = F.crc32(F.col("conv_id").cast("string")) % prefix_tour.MOST_SHARED
    base = F.col("conv_id") - F.col("conv_id") % prefix_tour.FAMILY
    return prefix_tour.prefix_tree(read(spark, sf_dir, "conversations"), shared, base)


def op12_stateful_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_stream.exact_groups(spark, f"{sf_dir}/documents.parquet")


def op13_shared_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the ids divisible by 100; every seventh id has the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return shared_lists.hard_negatives(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


QUERIES = {
    query.__name__: query
    for query in (
        op1_improbable_features,
        op2_repair_grammar,
        op3_line_chunks,
        op4_entropy_difference,
        op5_run_length_index,
        op6_levenshtein_lexicon,
        op7_level_doubling,
        op8_minhash_containment,
        op9_shared_prefix_viterbi,
        op10_simhash_bktree,
        op11_euler_tour,
        op12_stateful_stream,
        op13_shared_lists,
    )
}


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return query(spark, sf_dir)

        return run

    return {name: shipped(query) for name, query in QUERIES.items()}
