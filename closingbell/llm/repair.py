"""Token ids in files, compressed by a Re-Pair grammar per shard.

Documents are dealt out by ranges of doc_id and sorted, so files follow each other in that order; a
shard is some whole documents of about ``shard_tokens`` ids. In a shard the most frequent pairs of
neighbouring ids become nonterminals, again and again, as long as a rule saves more bits than it
takes. A round replaces all pairs that are at least a sixteenth as frequent as the most frequent one;
where two of them overlap the more frequent wins, of equal ones the left. Pairs never cross documents.

A shard is a row of a Parquet table (``LAYOUT``). It stores the rules, the number of ids that each
stands for, and where each document's symbols end, so a document, or a range of ids in it, is
decoded without the rest. Symbols are the tokenizer's ids, then the shard's rules, all of as many bits
as the last rule needs, so each is found by its number.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from closingbell.llm import common
from closingbell.session import work_folder

TOKENIZER = "word_bpe_49k.json"
END = 2
VOCABULARY = 49_408
SHARD_TOKENS = 1 << 20
#: A rule takes two symbols and a 32-bit span, which four uses make up for; pairs of four and five uses
#: mostly lose them to overlapping ones, and files come out smaller without.
LEAST_USES = 6
#: A round takes pairs down to this part of the most frequent one's count.
BAND = 16
BIN_BITS = 20
BATCH_BYTES = 2 << 20
KEPT_WORDS = 2_000_000
#: Runs of letters, and of ASCII stops that no special token and no contraction holds: the tokenizer's
#: pattern matches each such run whole.
PIECES = re.compile(r"[^\W\d_]+|[!\"#$%&()*+,\-./:;=?@\[\]^`{}~]+")
LINE_PIECES = 500

#: doc_ids: int64; the last ``nulls`` of them are null; ends: int64, symbols up to each document's end;
#: sizes: int64, ids of each document; spans: uint32, ids of each rule; all little-endian. symbols and
#: rules (two symbols each): ``width`` bits each, the highest first, filled up to a byte at the end.
LAYOUT = (
    "part int, shard int, n_ids long, nulls long, width int, doc_ids binary, ends binary, sizes binary, "
    "rules binary, spans binary, symbols binary"
)


# -- tokens --------------------------------------------------------------------------


class WordTokenizer:
    """Whole texts through the tokenizers library, which sees every distinct word once.

    The tokenizer's pattern never matches across white space and normalising doesn't reach across
    it either, so the ids of a text are those of its runs between ASCII white space; nor across
    the border of an ASCII letter and the stops that end a word, so those are words of their own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.ends_word = np.zeros(1 << 16, bool)
        for token, i in self.library.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")
        self.known = common.WordIds(self._encoded, KEPT_WORDS)

    @staticmethod
    def _spans(data: np.ndarray, offsets: np.ndarray):
        """Words, with the stops behind an ASCII letter split off."""
        starts, ends, row = common.word_spans(data, offsets)
        stops = np.zeros(len(starts), np.int64)
        more = np.arange(len(starts))
        for _ in range(9):
            more = more[common.STOPS[data[ends[more] - 1 - stops[more]]]]
            stops[more] += 1
            more = more[ends[more] - stops[more] > starts[more]]
        split = (stops > 0) & (stops < 9) & (ends - stops > starts)
        split[split] = common.LETTERS[data[(ends - stops)[split] - 1]]
        at = np.flatnonzero(split)
        cut = (ends - stops)[at]
        ends[at], last = cut, ends[at]
        return np.insert(starts, at + 1, cut), np.insert(ends, at + 1, last), np.insert(row, at + 1, row[at])

    def _encoded(self, found_words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words. Words made of ``PIECES`` go to the library in lines of their distinct
        pieces, which are told apart by the tokens that end a match. A piece has one match at least,
        so a line with as many matches as pieces has one for each; other lines' words go by themselves."""
        words = [word.decode("utf-8", "replace") for word in found_words]
        number: dict[str, int] = {}
        parts: list[int] = []  # the pieces of all words
        parted = np.zeros(len(words), np.int64)
        for i, word in enumerate(words):
            pieces = (word,) if word.isalpha() else PIECES.findall(word)
            if sum(map(len, pieces)) == len(word):
                parted[i] = len(pieces)
                for piece in pieces:
                    parts.append(number.setdefault(piece, len(number)))
        listed, part = list(number), np.array(parts, np.int64)
        # letters beyond ASCII may be decomposed by normalising: they have lines of their own
        plain = np.fromiter(map(str.isascii, listed), bool, len(listed))
        lines = []
        for some in (np.flatnonzero(plain), np.flatnonzero(~plain)):
            lines += [some[i : i + LINE_PIECES] for i in range(0, len(some), LINE_PIECES)]
        flat, held = [np.zeros(0, np.uint16)], 0
        start, length = np.zeros(len(listed), np.int64), np.zeros(len(listed), np.int64)
        encodings = self.library.encode_batch_fast([" ".join([listed[i] for i in line]) for line in lines], add_special_tokens=False)
        for line, encoding in zip(lines, encodings):
            ids = np.array(encoding.ids, np.uint16)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(line):
                length[line] = np.diff(ends, prepend=0)
                start[line] = held + ends - length[line]
                flat.append(ids)
                held += len(ids)
        whole = parted == 0
        owner = np.repeat(np.arange(len(words)), parted)
        whole[owner[length[part] == 0]] = True
        rest = np.flatnonzero(whole)
        found = [encoding.ids for encoding in self.library.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat.extend(np.array(ids, np.uint16) for ids in found)
        told = ~whole[owner]
        owner = np.concatenate([owner[told], rest])
        order = np.argsort(owner, kind="stable")
        start = np.concatenate([start[part[told]], held + np.cumsum(size) - size])[order]
        size = np.concatenate([length[part[told]], size])[order]
        picked = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return np.concatenate(flat)[picked], np.bincount(owner[order], size, len(words)).astype(np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end``, and the number of ids of each."""
        starts, ends, row = self._spans(data, offsets)
        bounds = np.searchsorted(row, np.arange(1, len(offsets)))
        return self.known.encode(data, starts, ends, bounds, end)


_LOADED: dict[str, WordTokenizer] = {}


def loaded(path: str) -> WordTokenizer:
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


# -- grammar -------------------------------------------------------------------------


def width_of(rules: int, first_rule: int = VOCABULARY) -> int:
    """Bits of a symbol."""
    return max(1, (first_rule + rules - 1).bit_length())


def packed(values: np.ndarray, width: int) -> bytes:
    """The values as ``width`` bits each."""
    out = []
    for at in range(0, len(values), 1 << 16):  # whole bytes, since the step is a multiple of eight
        some = np.ascontiguousarray(values[at : at + (1 << 16)], ">u4")
        out.append(np.packbits(np.unpackbits(some.view(np.uint8).reshape(-1, 4), axis=1)[:, 32 - width :]).tobytes())
    return b"".join(out)


def unpacked(raw: bytes, width: int, start: int, stop: int) -> np.ndarray:
    """Values ``start`` to ``stop`` of those that were packed; only their bytes are read."""
    first = start * width // 8
    part = np.frombuffer(raw, np.uint8)[first : -(-stop * width // 8)]
    skipped = start * width - first * 8
    n, out = stop - start, []
    bits = np.unpackbits(part)[skipped : skipped + n * width].reshape(n, width)
    for at in range(0, n, 1 << 16):
        some = np.zeros((min(n, at + (1 << 16)) - at, 32), np.uint8)
        some[:, 32 - width :] = bits[at : at + (1 << 16)]
        out.append(np.packbits(some, axis=1).view(">u4").ravel().astype(np.uint32))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def stored_bits(symbols: int, rules: int, first_rule: int = VOCABULARY) -> int:
    return (symbols + 2 * rules) * width_of(rules, first_rule) + 32 * rules


def compress(ids: np.ndarray, ends: np.ndarray, first_rule: int = VOCABULARY, least: int = LEAST_USES):
    """Symbols, each document's end in them, and rules (pairs, rule i being symbol first_rule + i).

    Rounds go on until no pair has ``least`` uses; of the states between them the one that takes the
    fewest bits is returned, so a grammar that outgrows a symbol's width has to be worth it.
    """
    symbols = ids.astype(np.uint32)
    sizes = np.diff(ends, prepend=0)
    last = ends[sizes > 0] - 1  # where documents end: no pair begins there
    rules: list[np.ndarray] = []
    number = first_rule
    best = stored_bits(len(symbols), 0, first_rule), symbols, last, 0
    # where a pair begins that may have enough uses: one that had too few never gets more
    live = np.delete(np.arange(len(symbols)), last)
    while len(live):
        # pairs of 16-bit symbols sort twice as fast
        kind, shift = (np.uint32, 16) if number <= 1 << 16 else (np.uint64, 32)
        pair = symbols.take(live).astype(kind)
        pair <<= kind(shift)
        pair |= symbols.take(live + 1)
        found = np.sort(pair)
        at = np.concatenate([[0], np.flatnonzero(found[1:] != found[:-1]) + 1])
        count = np.diff(at, append=len(found))
        top = int(count.max())
        if top < least:
            break
        good = np.flatnonzero(count >= max(least, top // BAND))
        # a round ends where the symbols would need one more bit
        room = (1 << width_of(number - first_rule, first_rule)) - number or number
        good = good[np.argsort(-count[good], kind="stable")][:room]
        chosen, order = found[at[good]], np.arange(len(good), 0, -1)
        # found again by a hash; of pairs that share a bin the most frequent one has it this round
        bins = np.zeros(1 << BIN_BITS, np.int32)
        bins[_bin(chosen[::-1])] = np.arange(len(good), 0, -1)
        # a small table tells which positions may have one of them, and which have enough uses
        seen = np.zeros(1 << BIN_BITS, np.uint8)
        seen[_bin(found[at[count >= least]])] = 1
        seen[_bin(chosen)] = 2
        here = _bin(pair)
        state = seen.take(here)
        maybe = np.flatnonzero(state == 2)
        place = bins.take(here.take(maybe)) - 1
        same = chosen[place] == pair.take(maybe)
        maybe, mine = live[maybe[same]], order[place[same]]
        # ranks of the pairs that begin one position earlier and one later
        beside = maybe[1:] == maybe[:-1] + 1
        before, after = np.zeros(len(maybe), np.int64), np.zeros(len(maybe), np.int64)
        before[1:], after[:-1] = mine[:-1] * beside, mine[1:] * beside
        # a run of one id holds its pair at every position: each second one of the run is taken
        begin = np.maximum.accumulate(np.where(before == mine, 0, np.arange(len(maybe))))
        wins = (mine[begin] > before[begin]) & (mine >= after)
        taken = np.flatnonzero(wins & ((np.arange(len(maybe)) - begin) % 2 == 0))
        used = np.bincount(mine[taken], minlength=len(good) + 1)[order]
        kept = np.flatnonzero(used >= least)
        if not len(kept):
            # overlaps left too few uses of each: the most used one alone, if it has enough of them
            take = _most_alone(live[pair == chosen[0]], least)
            if not len(take):
                break
            names_of = np.full(len(take), number, np.uint32)
            rules.append(_halves(chosen[:1], shift))
            number += 1
        else:
            names = np.zeros(len(good) + 1, np.uint32)
            names[order[kept]] = np.arange(number, number + len(kept))
            names_of = names[mine[taken]]
            take, names_of = maybe[taken[names_of > 0]], names_of[names_of > 0]
            rules.append(_halves(chosen[kept], shift))
            number += len(kept)
        stay, lives = np.ones(len(symbols), bool), np.zeros(len(symbols), bool)
        stay[take + 1] = False
        lives[live[state > 0]] = True
        lives[take] = True
        lives[take[take > 0] - 1] = True
        symbols = symbols[stay]
        symbols[take - np.arange(len(take))] = names_of
        last = last - np.searchsorted(take + 1, last, side="right")
        lives = lives[stay]
        lives[last] = False
        live = np.flatnonzero(lives)
        bits = stored_bits(len(symbols), number - first_rule, first_rule)
        if bits < best[0]:
            best = bits, symbols, last, number - first_rule
        elif width_of(number - first_rule, first_rule) > width_of(best[3], first_rule):
            break  # the wider symbols were not worth it
    _, symbols, last, kept_rules = best
    pairs = np.concatenate([np.zeros((0, 2), np.uint32), *rules])[:kept_rules]
    done = np.zeros(len(ends), np.int64)  # a document without ids ends where the one before it does
    done[sizes > 0] = last + 1
    return symbols, np.maximum.accumulate(done), pairs


def _bin(pairs: np.ndarray) -> np.ndarray:
    """A bin for each pair, by the leading bits of a product."""
    if pairs.dtype == np.uint32:
        return (pairs * np.uint32(0x9E3779B1)) >> np.uint32(32 - BIN_BITS)
    return (pairs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BIN_BITS)


def _halves(pairs: np.ndarray, shift: int) -> np.ndarray:
    kind = pairs.dtype.type
    return np.stack([pairs >> kind(shift), pairs & kind((1 << shift) - 1)], axis=1).astype(np.uint32)


def _most_alone(at: np.ndarray, least: int) -> np.ndarray:
    """Of one pair's places every second one of a run, if there are enough."""
    new = np.ones(len(at), bool)
    new[1:] = at[1:] > at[:-1] + 1
    begin = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
    at = at[(np.arange(len(at)) - begin) % 2 == 0]
    return at if len(at) >= least else at[:0]


def rule_spans(rules: np.ndarray, first_rule: int = VOCABULARY) -> np.ndarray:
    """How many ids each rule stands for."""
    spans = [1] * first_rule
    for a, b in rules.tolist():
        spans.append(spans[a] + spans[b])
    return np.array(spans[first_rule:], np.uint32)


class Shard:
    """A stored shard, for decoding any document or range of ids."""

    def __init__(self, row: dict, first_rule: int = VOCABULARY):
        self.doc_ids, self.ends, self.sizes = (np.frombuffer(row[c], "<i8") for c in ("doc_ids", "ends", "sizes"))
        self.nulls, self.raw, self.width = row["nulls"], row["symbols"], row["width"]
        spans = np.frombuffer(row["spans"], "<u4")
        rules = unpacked(row["rules"], self.width, 0, 2 * len(spans)).reshape(-1, 2)
        parts = [i.to_bytes(2, "little") for i in range(first_rule)]
        for a, b in rules.tolist():
            parts.append(parts[a] + parts[b])
        self.expanded = np.frombuffer(b"".join(parts), "<u2")
        self.span = np.concatenate([np.ones(first_rule, np.int64), spans.astype(np.int64)])
        self.begin = np.cumsum(self.span) - self.span

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        length = self.span[symbols]
        before = np.cumsum(length) - length
        at = np.repeat(self.begin[symbols] - before, length)
        return self.expanded[at + np.arange(len(at))]

    def document(self, i: int, start: int = 0, count: int | None = None) -> np.ndarray:
        """Ids start .. start + count of the i-th document; only the symbols around them are read."""
        symbols = unpacked(self.raw, self.width, int(self.ends[i - 1]) if i else 0, int(self.ends[i]))
        if start == 0 and count is None:
            return self._expand(symbols)
        reach = np.cumsum(self.span[symbols])
        stop = int(reach[-1]) if count is None else start + count
        low, high = np.searchsorted(reach, start, side="right"), np.searchsorted(reach, stop) + 1
        skipped = int(reach[low - 1]) if low else 0
        return self._expand(symbols[low:high])[start - skipped : stop - skipped]

    def documents(self) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each document's begin."""
        symbols = unpacked(self.raw, self.width, 0, int(self.ends[-1]) if len(self.ends) else 0)
        return self._expand(symbols), np.cumsum(self.sizes) - self.sizes


# -- files ---------------------------------------------------------------------------


def shard_row(docs: list[int | None], ids: np.ndarray, sizes: np.ndarray, first_rule: int = VOCABULARY, least: int = LEAST_USES) -> dict:
    """The columns of a shard from ``n_ids`` on; null ids are the last."""
    symbols, ends, rules = compress(ids, np.cumsum(sizes), first_rule, least)
    width, nulls = width_of(len(rules), first_rule), sum(d is None for d in docs)
    named = np.array([d or 0 for d in docs], "<i8")
    return {
        "n_ids": len(ids), "nulls": nulls, "width": width, "doc_ids": named.tobytes(), "ends": ends.astype("<i8").tobytes(),
        "sizes": sizes.astype("<i8").tobytes(), "rules": packed(rules.ravel(), width),
        "spans": rule_spans(rules, first_rule).astype("<u4").tobytes(), "symbols": packed(symbols, width),
    }


def _shard_batch(part: int, shard: int, docs: list, ids: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    row = {"part": part, "shard": shard} | shard_row(docs, ids, sizes)
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()] + [pa.binary()] * 6
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)], list(row))


def _shards(path: str | None, shard_tokens: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(path or public_tokenizers.path(TOKENIZER))
        part, shard, held = TaskContext.get().partitionId(), 0, 0
        parts: list[tuple[list, np.ndarray, np.ndarray]] = []

        def shard_of() -> pa.RecordBatch:
            docs, ids, sizes = zip(*parts)
            return _shard_batch(part, shard, [d for some in docs for d in some], np.concatenate(ids), np.concatenate(sizes))

        for batch in batches:
            data, offsets = common.text_bytes(batch["text"])
            docs = batch["doc_id"].to_pylist()
            for lo, hi in common.slices(offsets, BATCH_BYTES):
                ids, sizes = tokenizer.encode(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], END)
                row = lo
                while row < hi:  # up to the first document that fills the shard
                    reach = np.cumsum(sizes[row - lo :])
                    to = min(hi, row + int(np.searchsorted(reach, shard_tokens - held)) + 1)
                    n = int(reach[to - row - 1])
                    parts.append((docs[row:to], ids[:n], sizes[row - lo : to - lo]))
                    ids, held, row = ids[n:], held + n, to
                    if held >= shard_tokens:
                        yield shard_of()
                        shard, held, parts = shard + 1, 0, []
        if parts:
            yield shard_of()

    return made


def write(docs: DataFrame, path: str, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the ids of every whole text, and the end id, in ascending order of doc_id.

    A null text is empty and has the end id alone; null ids come last; rows that share a doc_id are
    ordered by their text. ``tokenizer`` is a file of the tokenizers library whose ids fit below
    ``VOCABULARY``, by default the public word BPE. Other columns are ignored.
    """
    rows = common.texts(docs).repartitionByRange(F.asc_nulls_last("doc_id"))
    rows = rows.sortWithinPartitions(F.asc_nulls_last("doc_id"), "text")
    rows.mapInArrow(_shards(tokenizer, shard_tokens), LAYOUT).write.parquet(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            shard = Shard(row)
            ids, begin = shard.documents()
            raw = ids.astype("<u4").tobytes()
            n = len(begin)
            nulls = np.arange(n) >= n - shard.nulls
            crc = [zlib.crc32(raw[4 * a : 4 * (a + s)]) for a, s in zip(begin.tolist(), shard.sizes.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * n, pa.int32()), pa.array([row["shard"]] * n, pa.int32()),
                 pa.array(shard.doc_ids, mask=nulls), pa.array(begin), pa.array(shard.sizes), pa.array(crc, pa.int64())],
                ["part", "shard", "doc_id", "begin", "n_tokens", "ids_crc32"],
            )


def _shard_starts(shards: DataFrame) -> DataFrame:
    """part, shard and the number of ids in all shards before: range partitions follow each other."""
    sizes = shards.select("part", "shard", "n_ids")
    before, starts = 0, []
    # a row for each partition that was written
    for part, total in sizes.groupBy("part").agg(F.sum("n_ids")).orderBy("part").collect():
        starts.append((part, before))
        before += total
    parts = shards.sparkSession.createDataFrame(starts, "part int, before long")
    window = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    within = sizes.withColumn("within", F.coalesce(F.sum("n_ids").over(window), F.lit(0)))
    return within.join(parts, "part").select("part", "shard", (F.col("before") + F.col("within")).alias("shard_start"))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files at ``path``."""
    shards = spark.read.schema(LAYOUT).parquet(path)
    decoded = shards.mapInArrow(
        _digests, "part int, shard int, doc_id long, begin long, n_tokens long, ids_crc32 long"
    )
    joined = decoded.join(_shard_starts(shards), ["part", "shard"])
    return joined.select("doc_id", (F.col("shard_start") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def written_digests(docs: DataFrame, **settings) -> DataFrame:
    """Write the documents' ids to a fresh folder below the shared one and read them back."""
    path = work_folder(docs.sparkSession, "repair-shards")
    write(docs, path, **settings)
    return read_digests(docs.sparkSession, path)
