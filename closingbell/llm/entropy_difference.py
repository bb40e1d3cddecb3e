"""Language-model scoring by cross-entropy difference.

A target model is counted on documents labelled as good, a background model on all documents. Both
are word bigram models over one vocabulary, which is every word of the corpus and the end of a text;
both have the same smoothing, and background counts are scaled to the size of the target's, so that
only what the texts say differs. Per word the loss under one model less the loss under the other
scores a document: the lower, the more it reads like the target.

Words and pairs are counted per group of documents, then over all groups by ranges of their hashes
(``keyed_slots``), so the models grow with the corpus and no task holds one whole. Texts move once; what
moves of the labels is the ids of good documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from closingbell.llm import common, keyed_slots

SMOOTHING = 1.0
#: The key of a text's end. A text's first word follows it, too.
END = np.uint64(0x5851F42D4C957F2D)
WORD, PAIR = 1, 2
KEY_BYTES = 6

SENT = "chunk int, kind int, slot int, keys binary, target binary, background binary"
ANSWER = "chunk int, kind int, slot int, target binary, background binary, words long, n_target long, n_background long"


def _tokens(table: pa.Table) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Of each slice: first and last row, keys of all words and ends, tokens up to each row's end."""
    data, offsets = common.text_bytes(table["text"])
    for lo, hi in common.slices(offsets):
        part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        starts, ends, row = common.word_spans(part, at)
        bounds = np.searchsorted(row, np.arange(1, hi - lo + 1))
        keys = np.insert(common.word_hashes(part, starts, ends), bounds, END)
        yield lo, hi, keys, bounds + np.arange(1, hi - lo + 1)


def _pairs(keys: np.ndarray) -> np.ndarray:
    """The key of each token and the one before it; the first follows an end, as all firsts do."""
    before = np.concatenate([[END], keys[:-1]])
    return common.mix(before * np.uint64(3) + common.mix(keys))


class _Counted:
    """The distinct words and pairs of a group of documents, and where each token's stand."""

    def __init__(self, table: pa.Table):
        slices = list(_tokens(table)) if table.num_rows else []
        keys = np.concatenate([np.zeros(0, np.uint64), *(s[2] for s in slices)])
        sizes = [np.diff(s[3], prepend=0) for s in slices]
        self.sizes = np.concatenate([np.zeros(0, np.int64), *sizes])
        self.words, self.word = np.unique(keys, return_inverse=True)
        self.pairs, self.pair = np.unique(_pairs(keys), return_inverse=True)


def _counts(bits: int):
    def counted(table: pa.Table, good: pa.Table) -> pa.Table:
        found = _Counted(table)
        ids = set(good["doc_id"].to_pylist())
        flag = np.array([i is not None and i in ids for i in table["doc_id"].to_pylist()], bool)
        mine = np.repeat(flag, found.sizes)
        chunk = (table if table.num_rows else good)["chunk"][0].as_py()
        parts = []
        for kind, keys, index in ((WORD, found.words, found.word), (PAIR, found.pairs, found.pair)):
            n = [np.bincount(i, minlength=len(keys)).astype(np.int64) for i in (index[mine], index)]
            rows = keyed_slots.sent(keys, bits, KEY_BYTES, target=n[0], background=n[1])
            size = len(rows["slot"])
            parts.append(pa.table({
                "chunk": pa.array([chunk] * size, pa.int32()), "kind": pa.array([kind] * size, pa.int32()),
                "slot": pa.array(rows["slot"], pa.int32()),
                **{name: pa.array(rows[name], pa.binary()) for name in ("keys", "target", "background")},
            }))
        return pa.concat_tables(parts)

    return counted


def _summed(table: pa.Table) -> pa.Table:
    """Every group's keys of one slot with the counts of all groups, and the slot's totals."""
    table = table.combine_chunks()
    keys, begin = keyed_slots.keys_of(table, KEY_BYTES)
    distinct, index = np.unique(keys, return_inverse=True)
    out, totals = {}, {}
    for name in ("target", "background"):
        mine = keyed_slots.numbers_of(table, name)
        # whole numbers below 2**53 add up exactly
        total = np.bincount(index, mine, minlength=len(distinct)).astype(np.int64)
        totals[name] = int(total.sum())
        out[name] = pa.array([keyed_slots.narrow(total[index[a:b]]) for a, b in zip(begin, begin[1:])], pa.binary())
    n = table.num_rows
    return pa.table({
        "chunk": table["chunk"], "kind": table["kind"], "slot": table["slot"], **out,
        "words": pa.array([len(distinct)] * n, pa.int64()),
        "n_target": pa.array([totals["target"]] * n, pa.int64()),
        "n_background": pa.array([totals["background"]] * n, pa.int64()),
    })


def losses(single, pair, context, total: float, words: int) -> np.ndarray:
    """-log2 P(word | word before), smoothed by the word's own share, and that by an even one."""
    p = (single + SMOOTHING / words) / (total + SMOOTHING)
    return -np.log2((pair + SMOOTHING * p) / (context + SMOOTHING))


def _scored(table: pa.Table, answers: pa.Table) -> pa.Table:
    names = ("target_loss", "background_loss", "difference")
    if not table.num_rows:
        return pa.table({"row": table["row"], "n_tokens": pa.array([], pa.int64())} | {n: pa.array([], pa.float64()) for n in names})
    found = _Counted(table)
    words, pairs = (answers.filter(pc.equal(answers["kind"], kind)).combine_chunks() for kind in (WORD, PAIR))
    vocabulary = sum(words["words"].to_pylist())
    total = {"target": sum(words["n_target"].to_pylist()), "background": sum(words["n_background"].to_pylist())}
    begin = np.cumsum(found.sizes) - found.sizes
    before = np.concatenate([[0], found.word[:-1]])
    before[begin] = np.searchsorted(found.words, END)  # a first word follows an end
    loss = []
    for name in ("target", "background"):
        scale = total["target"] / total["background"] if name == "background" and total["target"] else 1.0
        single, pair = (keyed_slots.answered(a, name) * scale for a in (words, pairs))
        each = losses(single[found.word], pair[found.pair], single[before], total[name] * scale, vocabulary)
        loss.append(np.add.reduceat(each, begin) / found.sizes)
    values = (*loss, loss[0] - loss[1])
    return pa.table({"row": table["row"], "n_tokens": pa.array(found.sizes)} | {n: pa.array(v) for n, v in zip(names, values)})


def score(docs: DataFrame, labels: DataFrame, chunk_bytes: int = common.CHUNK_BYTES) -> DataFrame:
    """row (a struct of all columns of ``docs``, its text null), n_tokens, target_loss, background_loss, difference.

    Losses are bits per token; tokens are the words of the whole text (whatever stands between blanks)
    and its end, so a null or empty text has one. The target is every document labelled with
    quality 1 (by any of its labels; null labels and ids don't count); without one it is the smoothing
    alone. Repeated rows count and are scored each. Words and pairs are told apart by 48 bits and their slot's.
    """
    parted = common.texts(docs)
    size = parted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks, bits = max(1, -(-size // chunk_bytes)), keyed_slots.slot_bits(size, chunk_bytes)
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk")
    every = docs.select(doc_id.alias("doc_id"), text.alias("text"), common.rows_without_text(docs)).select(chunk, "*")
    by_chunk = common.dealt(every, chunks).groupBy("chunk")
    named = labels.filter(F.col("quality").cast("int") == 1).select(F.col("doc_id").cast("long").alias("doc_id"))
    # labels grow with the documents; only ids meet, no texts
    good = parted.select(chunk, "doc_id").join(named.distinct().hint("merge"), "doc_id").select("chunk", "doc_id")
    rows = by_chunk.cogroup(common.dealt(good, chunks).groupBy("chunk")).applyInArrow(_counts(bits), SENT)
    answers = common.dealt(keyed_slots.by_slot(rows, _summed, ANSWER, bits, "kind"), chunks)
    schema = common.beside_row(every, "n_tokens long, target_loss double, background_loss double, difference double")
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(_scored, schema)
