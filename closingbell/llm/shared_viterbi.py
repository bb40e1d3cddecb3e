"""SentencePiece encoding and decoding with a shared-prefix Viterbi pass.

The words of a batch are marked (each space becomes the mark in front of its word), made distinct
and sorted, so neighbours share prefixes: the sorted list is a trie walked depth first. Along the
walk every prefix keeps its forward score, the sum of its best path's piece scores, and the last
piece of that path; the next word starts from the prefix it shares with the one before.

The model file is of the BPE kind. There the best path of a prefix is the one whose neighbouring
pieces all stand when merges are made in order of their scores, and the last piece of a prefix with
that property is unique. So the transition from one piece to the next is allowed or not, which is
found by undoing the merges at their border, and the path that is left is the one the library
itself encodes. Characters without a piece become byte pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from closingbell.llm import common

MODEL = "piece_bpe_32k.model"
MARK = "▁"
BATCH_BYTES = 1 << 20
#: Words whose ids a worker keeps between batches.
KEPT_WORDS = 600_000


class Viterbi:
    """One model file's pieces, and the walk over sorted words."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        normal = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.model = model
        self.id = {model.id_to_piece(i): i for i in normal}
        self.score = {model.id_to_piece(i): model.get_score(i) for i in normal}
        self.byte_ids = {int(model.id_to_piece(i)[3:-1], 16): i for i in ids if model.is_byte(i)}
        joined = {a + b for piece in self.id for a, b in zip(piece, piece[1:])}
        # texts part where no piece reaches across: before a mark, around a line feed, and between
        # an ASCII letter and a stop
        self.parts_lines = not any("\n" in pair for pair in joined)
        self.parts_stops = not any(common.LETTERS[ord(a)] and common.STOPS[ord(b)] for a, b in joined if (a + b).isascii())
        if any(b == MARK and a != MARK for a, b in joined):
            raise ValueError("a piece of the model holds a space inside")
        self.splits: dict[str, tuple[str, str] | None] = {}
        self.stands: dict[tuple[str, str], bool] = {}
        self.known = common.WordIds(self._learn, KEPT_WORDS)
        # the pieces that merges reach, as a trie from their last character on
        self.backwards: dict = {}
        for piece in self.id:
            if self._last_merge(piece) != ("", ""):
                node = self.backwards
                for c in reversed(piece):
                    node = node.setdefault(c, {})
                node[""] = piece

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two pieces that the last merge of a piece joins; None for one character.

        A piece that merges don't reach from its characters has the empty split ("", "").
        """
        if piece not in self.splits:
            parts, last = list(piece), None
            while len(parts) > 1:
                best = max(
                    (self.score.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(parts, parts[1:]))
                )
                if best[0] == -np.inf:
                    last = ("", "")
                    break
                i = -best[1]
                last = (parts[i], parts[i + 1])
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self.splits[piece] = last
        return self.splits[piece]

    def _stand(self, left: str, right: str) -> bool:
        """Whether the two pieces stay apart: no merge across their border comes before theirs.

        Merges are undone at the border, the latest first. A merge across is made if it scores
        higher than the one that was undone; of equal ones the left one comes first.
        """
        pair = (left, right)
        if pair not in self.stands:
            result, limit, ties = True, -np.inf, False
            while True:
                across = self.score.get(left + right)
                if across is not None and (across > limit or (ties and across == limit)):
                    result = False
                    break
                a, b = self._last_merge(left), self._last_merge(right)
                if a is None and b is None:
                    break
                if b is None or (a is not None and self.score[left] < self.score[right]):
                    limit, ties, left = self.score[left], False, a[1]
                else:
                    limit, ties, right = self.score[right], True, b[0]
            self.stands[pair] = result
        return self.stands[pair]

    def walk(self, words: list[str]) -> Iterator[tuple[str, list[str], float]]:
        """Pieces and forward score of each of the sorted distinct words."""
        last: list[str] = [""]  # last piece of the best path to each prefix
        forward = [0.0]
        before = ""
        for word in words:
            n, shared = min(len(word), len(before)), 0
            while shared < n and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], forward[shared + 1 :]
            for i in range(shared + 1, len(word) + 1):
                ending, node, at = [], self.backwards, i
                while at:
                    at -= 1
                    node = node.get(word[at])
                    if node is None:
                        break
                    if "" in node:
                        ending.append(node[""])
                for piece in reversed(ending):  # the longest first
                    at = i - len(piece)
                    previous = last[at]
                    stands = not at or self.stands.get((previous, piece))
                    if stands is None:
                        stands = previous not in self.id or self._stand(previous, piece)
                    if stands:
                        last.append(piece)
                        forward.append(forward[at] + self.score[piece])
                        break
                else:
                    if word[i - 1] in self.id:
                        raise ValueError(f"no path to {word[:i]!r}")
                    last.append(word[i - 1])  # a character without a piece
                    forward.append(forward[i - 1])
            pieces, i = [], len(word)
            while i:
                pieces.append(last[i])
                i -= len(last[i])
            yield word, pieces[::-1], forward[-1]
            before = word

    def _ids(self, pieces: list[str]) -> list[int]:
        ids: list[int] = []
        for piece in pieces:
            if piece in self.id:
                ids.append(self.id[piece])
            else:
                ids.extend(self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass"))
        return ids

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words. Runs of marks hold pieces of equal score, which the library's own
        order decides; it encodes the few words that have one."""
        marked = [word.decode("utf-8", "replace").replace(" ", MARK) for word in words]
        found = {w: self._ids(pieces) for w, pieces, _ in self.walk(sorted({w for w in marked if MARK * 2 not in w}))}
        for word in marked:
            if word not in found:
                # the library puts a mark first: in front of the line feed it stands alone
                found[word] = self.model.encode("\n" + word.replace(MARK, " "), num_threads=1)[2:]
        length = np.fromiter((len(found[w]) for w in marked), np.int64, len(marked))
        return np.fromiter((i for w in marked for i in found[w]), np.uint16, int(length.sum())), length

    def _spans(self, data: np.ndarray, offsets: np.ndarray):
        """The texts with a space in front of each, and the words that they part into."""
        mark = MARK.encode()
        raw = data.tobytes()
        if mark in raw:  # a text's own mark reads as a space
            at = offsets.tolist()
            rows = [raw[a:b].replace(mark, b" ") for a, b in zip(at, at[1:])]
            data = np.frombuffer(b"".join(rows), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(row) for row in rows])])
        filled = np.flatnonzero(np.diff(offsets))
        data = np.insert(data, offsets[:-1][filled], 0x20)
        offsets = offsets.copy()
        offsets[1:] += np.cumsum(np.bincount(filled, minlength=len(offsets) - 1))
        begins = np.zeros(len(data), bool)
        space = data == 0x20
        begins[1:] = space[1:] & ~space[:-1]
        if self.parts_lines:
            line = data == 0x0A
            begins |= line
            begins[1:] |= line[:-1]
        if self.parts_stops:
            begins[1:] |= common.STOPS[data[1:]] & common.LETTERS[data[:-1]]
        begins[offsets[:-1][filled]] = True
        starts = np.flatnonzero(begins)
        return data, starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets[1:])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, given as bytes, and the number of ids of each."""
        return self.known.encode(*self._spans(data, offsets))


class Decoder:
    """Texts of ids: pieces one after the other, without the mark before the first word."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                pieces.append(bytes([int(piece[3:-1], 16)]))
            else:
                drop = model.is_control(i) or model.is_unknown(i)
                pieces.append(b"" if drop else piece.replace(MARK, " ").encode())
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.all = np.frombuffer(b"".join(pieces), np.uint8)

    def __call__(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """``bounds``: ids up to the end of each text."""
        length = self.length[ids]
        reach = np.cumsum(length)
        raw = self.all[np.repeat(self.start[ids] - (reach - length), length) + np.arange(int(length.sum()))].tobytes()
        ends = np.concatenate([[0], reach])[bounds].tolist()
        return [raw[a:b].removeprefix(b" ").decode("utf-8", "replace") for a, b in zip([0, *ends], ends)]


@cache
def loaded(kind: type, path: str | None):
    """The model for one use, once per worker."""
    return kind(path or public_tokenizers.path(MODEL))


def _encoded(path: str | None):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        viterbi = loaded(Viterbi, path)
        for batch in batches:
            data, offsets = common.text_bytes(batch["text"])
            for lo, hi in common.slices(offsets, BATCH_BYTES):
                ids, size = viterbi.encode(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                at = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch["row"].slice(lo, hi - lo), lists], ["row", "ids"])

    return found


def _decoded(path: str | None):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = loaded(Decoder, path)
        for batch in batches:
            lists, at = batch["ids"], batch["ids"].offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy()
            for lo, hi in common.slices(at, BATCH_BYTES):
                ids, bounds = values[at[lo] : at[hi]], at[lo + 1 : hi + 1] - at[lo]
                begins = [0, *bounds.tolist()]
                raw = ids.astype("<u4").tobytes()
                digest = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins, begins[1:])]
                kept = [batch["row"].slice(lo, hi - lo), lists.slice(lo, hi - lo)]
                made = [pa.array(decoder(ids, bounds), pa.string()), pa.array(digest, pa.int64())]
                yield pa.RecordBatch.from_arrays(kept + made, ["row", "ids", "decoded", "ids_crc32"])

    return found


DECODED = "ids array<int>, decoded string, ids_crc32 long"


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """row (a struct of all columns of ``docs``) and ids (array of int) of its whole text.

    The ids are those of the sentencepiece library for the model file at ``path`` (by default the
    public 32k file). A null or empty text has no ids. Rows are encoded one by one, repeated ones
    alike.
    """
    rows = docs.select(
        common.whole_rows(docs),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(_encoded(path), common.beside_row(rows, "ids array<int>"))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """row, ids, decoded (the text of the ids) and ids_crc32 (of the ids as unsigned 32 bits).

    The decoded text is the text itself, unless that holds the mark U+2581, which reads as a space.
    """
    return encoded.select("row", "ids").mapInArrow(_decoded(path), common.beside_row(encoded, DECODED))


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``decode(encode(docs))`` in one task each, so a row's ids needn't leave Python between."""
    rows = docs.select(
        common.whole_rows(docs),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decoded(path)(_encoded(path)(batches))

    return rows.mapInArrow(both, common.beside_row(rows, DECODED))
