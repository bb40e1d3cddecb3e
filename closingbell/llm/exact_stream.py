"""Exact duplicates by a stateful stream with state on disk.

The documents are read as a stream of files. Its state, in RocksDB under the checkpoint folder, has one
entry for each distinct digest and never expires: the number of rows, the identifier that stays and
the locator (file and row number) of that row's content. A later call with the same checkpoint reads
only files that are new and goes on with the entries it finds. The entries are read back as a table.

A digest alone proves nothing. Wherever it was hit, the full texts are compared: rows are folded by
digest and bytes, on the map side first, so that a text with any number of copies moves once from
each task. A digest with more than one text (none is known for SHA-256) is split by the texts.

Everything is DataFrame functions: no Python runs on the executors.

Defined results: a null text is the empty text; a null doc_id is smaller than all others (if all ids of
a group are null, ``keep_id`` is null); of rows with equal text and equal largest id, the one that
is last by file and row number stays; an empty table gives no rows; other columns of the files, also
those named like results, are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from closingbell.llm.common import stored
from closingbell.session import setting, work_folder

_STATE = "spark.sql.streaming.stateStore."
#: State on each executor's disk, with one memory limit for all stores of an executor, and no space
#: set aside for stores that stay small.
STATE = {
    f"{_STATE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STATE}rocksdb.allowFAllocate": "false",
    f"{_STATE}rocksdb.boundedMemoryUsage": "true",
    f"{_STATE}rocksdb.maxMemoryUsageMB": "256",
}
PLACE = "struct<doc_id: bigint, file: string, at: bigint>"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _rows(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Text, digest and place of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    place = F.struct(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("at"),
    )
    return docs.select(text.alias("text"), digest(text).alias("digest"), place.alias("place"))


def absorb(
    spark: SparkSession,
    path: str,
    state: str,
    files_at_once: int | None = None,
    digest: Callable[[Column], Column] = sha256,
) -> None:
    """Take the files of ``path`` that ``state`` has not seen into its entries.

    ``path`` is a Parquet file or folder, ``state`` a folder that all executors share.
    ``files_at_once`` bounds a micro-batch; without it, all new files are one.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    source = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_at_once:
        source = source.option("maxFilesPerTrigger", files_at_once)
    # in braces, since a stream takes a single file only as a pattern
    rows = _rows(source.parquet(f"{folder}/{{{name}}}"), digest)
    entries = rows.groupBy("digest").agg(F.count("*").alias("n"), F.max("place").alias("place"))
    with ExitStack() as held:
        for key, value in STATE.items():
            held.enter_context(setting(spark, key, value))
        writer = entries.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
        writer.option("checkpointLocation", state).start().awaitTermination()


def entries(spark: SparkSession, state: str) -> DataFrame:
    """digest, rows seen, place of the row that stays: one row per digest in the state."""
    held = spark.read.format("statestore").load(state)
    return held.select(
        "key.digest",
        F.col("value.count").alias("group_size"),
        F.col("value.max").cast(PLACE).alias("stays"),
    )


def exact_groups(
    spark: SparkSession,
    path: str,
    state: str | None = None,
    files_at_once: int | None = None,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row of ``path``.

    ``state`` may hold entries of earlier files; only those still in ``path`` are judged here.
    """
    state = state or work_folder(spark, "exact_state")
    absorb(spark, path, state, files_at_once, digest)
    rows = _rows(spark.read.parquet(path), digest)
    compared = rows.groupBy("digest", "text").agg(F.count("*").alias("group_size"), F.max("place").alias("stays"))
    texts = stored(compared.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1"), "exact_clashes")
    held = entries(spark, state)
    judged = ["place", "stays", "group_size", F.sha2("text", 256).alias("text_sha256")]
    if texts.isEmpty():
        light = rows.select("digest", "place", F.sha2("text", 256).alias("text_sha256"))
        found = light.join(held, "digest").select("place", "stays", "group_size", "text_sha256")
    else:
        clear = rows.join(texts, "digest", "left_anti").join(held, "digest")
        split = compared.join(texts.select("digest"), "digest", "left_semi")
        clash = rows.join(split, ["digest", "text"])
        found = clear.select(*judged).union(clash.select(*judged))
    return found.select(
        F.col("place.doc_id").alias("doc_id"),
        F.col("stays.doc_id").alias("keep_id"),
        "group_size",
        ((F.col("place.file") == F.col("stays.file")) & (F.col("place.at") == F.col("stays.at"))).alias("kept"),
        "text_sha256",
    )
