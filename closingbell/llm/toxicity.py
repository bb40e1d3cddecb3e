"""Toxicity: a learned lexicon, matched with spelling errors, and scored by the words around it.

The lexicon is learned from labelled documents: words that hardly occur elsewhere, and stems (word
beginnings) that many such words share. It is a trie; a word is read by the Levenshtein automata of
all its terms at once. The automata and the trie are walked together, and the sets of (trie node,
errors) that turn up are numbered, so a batch's words advance together, one letter per step, through
one growing transition table, and most leave it after two or three letters.

Each match is scored in its context window: quotation marks around it and words of reporting before
it speak for a quotation, words of address for abuse. A logistic model of a few sums decides.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from closingbell.llm import common

#: Labelled rows that are learned from, at most: those of least hash of their id.
SAMPLE_ROWS = 20_000
LEAST_PRECISION = 0.95
LEAST_DOCUMENTS = 4
STEM_LETTERS = (3, 4, 5, 6, 7, 8)
STEM_WORDS = 8
WINDOW = 6
FOLDS = 5

# Words of reporting and of address in the languages of the texts.
REPORTING = frozenset(
    "said says say wrote writes called calls quote quoted quotes allegedly reportedly word term "
    "dit disait écrit appelé mot sagte sagt schrieb nannte wort dijo dice escribió llamó palabra".split()
)
ADDRESS = frozenset("you your youre yourself u tu vous ton votre du dich dein ihr sie tú usted vosotros".split())
QUOTES = "\"“”„«»‟"

_WORD = np.array([chr(c).isalnum() for c in range(0x10000)])
_TOKEN = re.compile(r"[^\W_]+")


def _errors_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


# -- the automaton -------------------------------------------------------------------


class Lexicon:
    """Levenshtein automata of all terms, walked together over their trie, made as needed.

    A state is a set of (trie node, errors). ``step`` holds the transitions found so far, -1
    where none was tried; state 0 is dead. ``result`` is what a word that ends in the state
    matches: the term with the fewest errors, as 2 * term + (1 if it has errors), or -1. A stem
    that is complete matches whatever follows: without errors the word needn't be read on, with
    errors the state keeps it as the complement of its node.

    ``code`` numbers the letters of the terms, the most frequent ones first; transitions by the
    letters from ``WIDTH`` on are in ``far``, since few states meet them.
    """

    WIDTH = 256

    def __init__(self, terms: list[tuple[str, bool]]):
        """``terms``: (text, is a stem)."""
        self.terms = terms
        count = Counter(c for text, _ in terms for c in text)
        self.letters = {c: i + 1 for i, c in enumerate(sorted(count, key=lambda c: (-count[c], c)))}
        self.code = np.zeros(0x110000, np.int32)
        for c, i in self.letters.items():
            self.code[ord(c)] = i
        self.far: dict[tuple[int, int], int] = {}
        self.children: list[dict[int, int]] = [{}]
        self.word_at: dict[int, int] = {}
        self.stem_at: dict[int, int] = {}
        self.budget = [0]  # most errors that a term below the node allows
        for number, (text, stem) in enumerate(terms):
            node, allowed = 0, _errors_allowed(text)
            self.budget[0] = max(self.budget[0], allowed)
            for c in text:
                node = self.children[node].setdefault(self.letters[c], len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.budget.append(0)
                self.budget[node] = max(self.budget[node], allowed)
            (self.stem_at if stem else self.word_at)[node] = number
        self.numbers: dict[frozenset, int] = {frozenset(): 0}
        self.sets = [frozenset()]
        self.result = np.full(1, -1, np.int64)
        self.sure = np.zeros(1, bool)  # a stem is complete
        self.step = np.full((1, self.WIDTH), -1, np.int32)
        self.step[0] = 0
        self.start = self._number(self._closed({(0, 0)}))

    def _closed(self, pairs: set[tuple[int, int]]) -> frozenset:
        """With the letters of a term left out; of a node only the fewest errors are kept, of the
        complete stems the best, and nothing that has more errors than it."""
        least: dict[int, int] = {}
        todo = [(node, errors) for node, errors in pairs if node >= 0]
        while todo:
            node, errors = todo.pop()
            if errors > self.budget[node] or least.get(node, 9) <= errors:
                continue
            least[node] = errors
            todo.extend((child, errors + 1) for child in self.children[node].values())
        stems = [(errors, self.stem_at[~node], node) for node, errors in pairs if node < 0]
        stems += [(e, self.stem_at[n], ~n) for n, e in least.items() if n in self.stem_at and e <= self._allowed(self.stem_at[n])]
        if stems:
            errors, _, node = min(stems)
            least = {n: e for n, e in least.items() if e <= errors} | {node: errors}
        return frozenset(least.items())

    def _allowed(self, term: int) -> int:
        return _errors_allowed(self.terms[term][0])

    def _next(self, state: int, letter: int) -> frozenset:
        pairs = set()
        for node, errors in self.sets[state]:
            if node < 0:
                pairs.add((node, errors))
                continue
            for c, child in self.children[node].items():
                same = c == letter and letter > 0
                pairs.add((child, errors if same else errors + 1))
            pairs.add((node, errors + 1))  # a letter too many
        return self._closed(pairs)

    def _number(self, pairs: frozenset) -> int:
        if pairs in self.numbers:
            return self.numbers[pairs]
        number = self.numbers[pairs] = len(self.sets)
        self.sets.append(pairs)
        stems = [(e, self.stem_at[~n]) for n, e in pairs if n < 0]
        words = [(e, self.word_at[n]) for n, e in pairs if n in self.word_at and e <= self._allowed(self.word_at[n])]
        sure = any(e == 0 for e, _ in stems)
        errors, term = min(stems if sure else stems + words, default=(0, None))
        best = -1 if term is None else 2 * term + (errors > 0)
        if number >= len(self.step):
            grow = len(self.step)
            self.step = np.concatenate([self.step, np.full((grow, self.WIDTH), -1, np.int32)])
            self.result = np.concatenate([self.result, np.full(grow, -1, np.int64)])
            self.sure = np.concatenate([self.sure, np.zeros(grow, bool)])
        self.result[number], self.sure[number] = best, sure
        return number

    def _far(self, state: int, letter: int) -> int:
        if (state, letter) not in self.far:
            self.far[state, letter] = self._number(self._next(state, letter)) if state else 0
        return self.far[state, letter]

    def match(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words codes[start:end] that match, and their results."""
        word = np.arange(len(starts))
        state = np.full(len(starts), self.start)
        at = starts.copy()
        found, results = [], []
        while len(word):
            over = (at == ends[word]) | self.sure[state]
            done = np.flatnonzero(over & (self.result[state] >= 0))
            found.append(word[done])
            results.append(self.result[state[done]])
            word, state, at = word[~over], state[~over], at[~over]
            letter = codes[at]
            far = letter >= self.WIDTH
            column = np.where(far, 0, letter)
            after = self.step[state, column]
            new = np.flatnonzero((after < 0) & ~far)
            if len(new):
                for key in np.unique(state[new] * self.WIDTH + letter[new]).tolist():
                    source, by = divmod(key, self.WIDTH)
                    target = self._number(self._next(source, by))
                    self.step[source, by] = target
                after = self.step[state, column]
            if far.any():
                after[far] = [self._far(*key) for key in zip(state[far].tolist(), letter[far].tolist())]
            alive = after > 0
            word, state, at = word[alive], after[alive].astype(np.int64), at[alive] + 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        found, results = np.concatenate(found), np.concatenate(results)
        order = np.argsort(found)
        return found[order], results[order]


# -- matches and their context -------------------------------------------------------

FEATURES = 6


def _quoted(text: str, begin: int, end: int) -> bool:
    """Between quotation marks of its own line."""
    line = text.rfind("\n", 0, begin) + 1
    stop = text.find("\n", end)
    before = sum(c in QUOTES for c in text[line:begin])
    return before % 2 == 1 and any(c in QUOTES for c in text[end : stop if stop >= 0 else len(text)])


def _context(text: str, words: list[tuple[int, int]], i: int) -> float:
    """How much a match counts as abuse: less in a quotation or after words of reporting."""
    begin, end = words[i]
    near = [text[a:b] for a, b in words[max(0, i - WINDOW) : i + WINDOW + 1]]
    ahead = near[: min(i, WINDOW)]
    score = 0.0
    if _quoted(text, begin, end):
        score -= 1.5
    if any(w in REPORTING for w in ahead):
        score -= 0.5
    if any(w in ADDRESS for w in near):
        score += 0.5
    return 1 / (1 + np.exp(-(score + 1.5)))


def features(texts: list[str], lexicon: Lexicon, weights: np.ndarray) -> np.ndarray:
    """Per text: sums of matched weight by spelling and context, whether any, and their density."""
    out = np.zeros((len(texts), FEATURES))
    lowered = [text.lower() for text in texts]
    size = np.fromiter(map(len, lowered), np.int64, len(lowered))
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    bmp = np.minimum(points, 0xFFFF).astype(np.uint16)
    offsets = np.concatenate([[0], np.cumsum(size)])
    inside = _WORD[bmp] | (points > 0xFFFF)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(points))]
    first[edges], last[edges - 1] = inside[edges], inside[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    word, result = lexicon.match(lexicon.code[points], starts, ends)
    bounds = np.searchsorted(row, np.arange(len(texts) + 1))
    hits = np.searchsorted(row[word], np.arange(len(texts) + 1))
    for r in np.flatnonzero(np.diff(hits)).tolist():
        a, b = bounds[r], bounds[r + 1]
        spans = list(zip((starts[a:b] - offsets[r]).tolist(), (ends[a:b] - offsets[r]).tolist()))
        sums = np.zeros((2, 2))
        for w, found in zip(word[hits[r] : hits[r + 1]].tolist(), result[hits[r] : hits[r + 1]].tolist()):
            share, weight = _context(lowered[r], spans, w - int(a)), weights[found >> 1]
            sums[found & 1] += weight * share, weight * (1 - share)
        out[r, :4] = np.log1p(sums).ravel()
        out[r, 4] = sums[0].sum() > 0
        out[r, 5] = np.log1p(1000 * sums.sum() / (b - a))
    return out


# -- learning ------------------------------------------------------------------------


@dataclass
class Model:
    terms: list[tuple[str, bool]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES + 1))

    def scores(self, found: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.coefficients[0] + found @ self.coefficients[1:])))


def _terms_of(text: str) -> set[tuple[str, int, str]]:
    """(term, 0, word) for words and (stem, 1, word) for their beginnings."""
    words = {w for w in _TOKEN.findall(text.lower()) if not w.isdigit()}
    return {(w, 0, w) for w in words if len(w) > 2} | {(w[:n], 1, w) for w in words for n in STEM_LETTERS if len(w) > n}


_TERM = "term string, stem int"


def _toxic_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic documents that hold a term, and some words that complete it."""
    for batch in batches:
        count: Counter = Counter()
        words: dict[tuple[str, int], set[str]] = {}
        for text in batch["text"].to_pylist():
            found = _terms_of(text)
            for term, stem, word in found:
                mine = words.setdefault((term, stem), set())
                if len(mine) < STEM_WORDS:
                    mine.add(word)
            count.update({(term, stem) for term, stem, _ in found})
        rows = [(t, s, n, sorted(words[t, s])) for (t, s), n in count.items()]
        columns = list(zip(*rows)) or [(), (), (), ()]
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["term", "stem", "toxic", "words"])


def _clean_terms(known: set[tuple[str, int]]):
    """Clean documents that hold a term in question."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        for batch in batches:
            for text in batch["text"].to_pylist():
                count.update(known & {(term, stem) for term, stem, _ in _terms_of(text)})
        rows = [(t, s, n) for (t, s), n in count.items()]
        columns = list(zip(*rows)) or [(), (), ()]
        kinds = (pa.string(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["term", "stem", "clean"])

    return counted


def _learn_terms(sample: DataFrame, most: int | None) -> tuple[list[tuple[str, bool]], np.ndarray]:
    """Terms whose documents are nearly all toxic, best first, and their log odds; ``most`` cuts them.

    Only terms of several toxic documents come into question; they are what the sample's toxic
    part holds, so the set that the tasks get is bounded by ``SAMPLE_ROWS``.
    """
    toxic = sample.filter("toxic = 1").select("text").mapInArrow(
        _toxic_terms, f"{_TERM}, toxic long, words array<string>"
    )
    asked = toxic.groupBy("term", "stem").agg(
        F.sum("toxic").alias("toxic"),
        F.size(F.array_distinct(F.flatten(F.collect_list("words")))).alias("words"),
    ).filter(
        (F.col("toxic") >= LEAST_DOCUMENTS) & ((F.col("stem") == 0) | (F.col("words") >= STEM_WORDS))
    )
    asked = common.stored(asked, "toxicity-terms")
    known = {(r["term"], r["stem"]) for r in asked.select("term", "stem").collect()}
    clean = sample.filter("toxic = 0").select("text").mapInArrow(_clean_terms(known), f"{_TERM}, clean long")
    clean = clean.groupBy("term", "stem").agg(F.sum("clean").alias("clean"))
    counted = asked.join(clean, ["term", "stem"], "left").withColumn("clean", F.coalesce("clean", F.lit(0)))
    totals = sample.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    odds = F.log((F.col("toxic") + 0.5) / (totals[0] + 1)) - F.log((F.col("clean") + 0.5) / (totals[1] + 1))
    good = counted.filter(F.col("toxic") >= LEAST_PRECISION * (F.col("toxic") + F.col("clean"))).select("term", "stem", odds.alias("odds"))
    rows = _best(good.collect(), most)  # part of ``known``
    return [(r["term"], bool(r["stem"])) for r in rows], np.array([max(0.1, r["odds"]) for r in rows])


def _best(good: list, most: int | None) -> list:
    """The rows (term, stem, odds) of highest odds, without those that match nothing more
    than a stem of at least their odds: one that begins them and allows as many errors."""
    stems: dict[str, int] = {}
    rows = []
    for row in sorted(good, key=lambda r: (-r["odds"], -r["stem"], len(r["term"]), r["term"])):
        if len(rows) == most:
            break
        term, allowed = row["term"], _errors_allowed(row["term"])
        if any(stems.get(term[:n], -1) >= allowed for n in STEM_LETTERS):
            continue
        rows.append(row)
        if row["stem"]:
            stems[term] = allowed
    return rows


def _fit(found: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards a prior that counts matches as toxic."""
    prior = np.array([-3.0, 1.0, 0.3, 0.3, 0.1, 3.0, 0.0])
    x, w = np.column_stack([np.ones(len(found)), found]), prior.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - toxic) + 0.1 * (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _feature_rows(model: Model, keep: str, name: str):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.terms)
        for batch in batches:
            _, offsets = common.text_bytes(batch["text"])
            for lo, hi in common.slices(offsets, 1 << 20):
                values = features(batch["text"].slice(lo, hi - lo).to_pylist(), lexicon, model.weights)
                kept = batch[keep].slice(lo, hi - lo)
                out = pa.array(list(values)) if name == "found" else pa.array(model.scores(values))
                yield pa.RecordBatch.from_arrays([kept, out], [keep, name])

    return found


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, lexicon: int | None = None) -> Model:
    """Fit lexicon and model on labelled documents outside the held-out fold.

    At most ``sample_rows`` labelled ids are used, those of least hash; the lexicon has all good terms
    of them, or the ``lexicon`` best. A doc_id with several
    labels is toxic if one says so; null labels and ids don't count. Without toxic or without clean
    rows the lexicon is empty and every score the same.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .dropna()
        .filter(~held_out("id"))
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample_rows)
    )
    known = common.stored(known, "toxicity-sample")
    text = common.texts(docs)
    # at most sample_rows pairs of numbers
    sample = text.join(F.broadcast(known), text["doc_id"] == known["id"]).select("text", "toxic")
    sample = common.stored(sample, "toxicity-texts")
    n, toxic = sample.agg(F.count("*"), F.sum("toxic")).first()
    if not n or not toxic or toxic == n:
        return Model(coefficients=np.array([8.0 if toxic else -8.0] + [0.0] * FEATURES))
    terms, weights = _learn_terms(sample, lexicon)
    model = Model(terms, weights)
    rows = sample.mapInArrow(_feature_rows(model, "toxic", "found"), "toxic int, found array<double>").collect()
    model.coefficients = _fit(np.array([r["found"] for r in rows]), np.array([r["toxic"] for r in rows], float))
    return model


def score_rows(docs: DataFrame, model: Model) -> DataFrame:
    """row (a struct of all columns of ``docs``) and its score, from the whole text alone."""
    rows = docs.select(
        common.whole_rows(docs),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(_feature_rows(model, "row", "score"), common.beside_row(rows, "score double"))


def toxicity(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Toxicity of every document.

    Returns doc_id, held_out (its fold is not learned from), score (0 to 1) and predicted (1 from
    0.5 on), a row for each row of ``docs``. A null or empty text has no match and gets the score
    of one; a null doc_id is not held out and has no label. Other columns are ignored.
    """
    model = learn(docs, labels, **settings)
    scored = score_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return scored.select("row.doc_id", "score").select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def clean_rows(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below 0.5."""
    scored = score_rows(docs, learn(docs, labels, **settings)).filter("score < 0.5")
    return scored.select(*(common.column(c, "row").alias(c) for c in docs.columns))
