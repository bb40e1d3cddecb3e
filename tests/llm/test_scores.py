"""Fingerprints, language-model scores and toxicity."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

import llm_cases as cases
from closingbell.llm import digest, entropy_difference, toxicity
from test_repeats import collected

LABELS = "doc_id long, toxic int, quality int, text string"


# -- fingerprints --------------------------------------------------------------------


def test_entropy_classes():
    data = np.random.default_rng(0).integers(0, 6, 500).astype(np.uint8)
    found = digest.entropy_classes(data)
    assert len(found) == 437
    for i in range(437):
        counts = collections.Counter(data[i : i + 64].tolist()).values()
        entropy = 6 - sum(c * math.log2(c) for c in counts) / 64
        assert abs(found[i] - entropy / 6 * 1000) <= 1.5


def features(text, ranks):
    if not text:
        return []
    if len(text) < 64:
        return [0]
    rank = ranks[digest.entropy_classes(np.frombuffer(text, np.uint8))]
    votes = np.zeros(len(rank), int)
    for s in range(max(1, len(rank) - 63)):
        votes[s + int(np.argmin(rank[s : s + 64]))] += 1
    order = sorted((i for i in range(len(rank)) if votes[i]), key=lambda i: (-votes[i], i))
    return sorted(i for n, i in enumerate(order) if votes[i] >= digest.VOTES or n < digest.LEAST_FEATURES)


def test_features_do_not_depend_on_neighbours():
    rng = np.random.default_rng(1)
    ranks = rng.permutation(digest.CLASSES + 1)
    texts = [bytes(rng.integers(97, 97 + int(rng.integers(1, 20)), int(rng.integers(0, 400))).astype(np.uint8)) for _ in range(60)]
    texts += [b"", b"a", b"ab" * 31, b"ab" * 32, b"z" * 63 + b"y"]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    hashes, owner = digest.feature_hashes(np.frombuffer(b"".join(texts), np.uint8), offsets, ranks)
    for i, text in enumerate(texts):
        alone, _ = digest.feature_hashes(np.frombuffer(text, np.uint8), np.array([0, len(text)]), ranks)
        assert (hashes[owner == i] == alone).all() and len(alone) == len(features(text, ranks))


def test_digest_likeness():
    rng = random.Random(2)
    ranks = np.random.default_rng(2).permutation(digest.CLASSES + 1)
    a = bytes(rng.choices(b"abcdefghij klmnop", k=40_000))
    b = bytes(rng.choices(b"abcdefghij klmnop", k=40_000))
    half = a[:20_000] + b[:20_000]
    da, db, dh, again = digest.digests([a, b, half, a], ranks)
    assert digest.likeness(da, again) == 1.0 and len(da) > 1
    assert digest.likeness(da, db) < 0.1 < 0.4 < digest.likeness(da, dh) < 0.8
    assert (digest.from_text(digest.as_text(da)) == da).all()
    assert digest.likeness(digest.from_text("0:"), da) == 0 and digest.likeness(digest.from_text("0:"), digest.from_text("0:")) == 1


def check_edits(docs, **settings):
    rows = collected(docs)
    found = digest.compare_edited(docs, **settings).collect()
    by_id = sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0])
    known = {r["doc_id"]: r for r in found}
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(d) for d, _ in rows)
    ids = [d for d, _ in by_id]
    for (d, text), (after, other) in zip(by_id, by_id[1:]):
        if ids.count(d) == 1 and ids.count(after) == 1:
            text, other = text or "", other or ""
            n = len(text) // 3
            changed = text[: len(text) - n] + other[:n]
            row = known[d]
            assert row["n_chars"] == len(text)
            assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
            if changed == text:
                assert row["near_edited"] == 1 and row["fingerprint"] == row["edited_fingerprint"]
    prints = collections.defaultdict(set)
    texts = {d: t or "" for d, t in by_id}
    for row in found:
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        if row["doc_id"] is not None and ids.count(row["doc_id"]) == 1:
            prints[texts[row["doc_id"]]].add(row["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    return known, by_id


@pytest.mark.parametrize("bucket_bytes", [3_000, digest.BUCKET_BYTES])
def test_edited_awkward(awkward, bucket_bytes):
    check_edits(awkward, bucket_bytes=bucket_bytes)


def test_edited_small(small):
    known, by_id = check_edits(small, bucket_bytes=50_000)
    last, first = by_id[-1], by_id[0]
    n = len(last[1]) // 3
    changed = last[1][: len(last[1]) - n] + first[1][:n]
    assert known[last[0]]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
    long = [r for r in known.values() if r["n_chars"] > 1000]
    assert np.median([r["near_edited"] for r in long]) > 0.5 > 0.2 > np.median([r["near_next"] for r in long])


def test_fingerprints_of_rows(awkward, nothing):
    found = digest.fingerprints(awkward).collect()
    assert {r["fingerprint"] for r in found if not r["row"]["text"]} == {"0:"}
    assert digest.fingerprints(nothing).collect() == [] and digest.compare_edited(nothing).collect() == []


def test_a_single_document_is_its_own_next(session):
    row = digest.compare_edited(cases.docs_of(session, [(4, "some text " * 30, *[None] * 11)])).collect()
    assert len(row) == 1 and row[0]["near_next"] == 1


MASK = 2**64 - 1


def plain_class(window):
    """Entropy class of 64 bytes, from whole millionths of c log2 c."""
    grown = [0] + [round(1e6 * c * math.log2(c)) if c > 1 else 0 for c in range(1, 65)]
    total = sum(grown[c] for c in collections.Counter(window).values())
    return (grown[64] - total) * 1000 // grown[64]


def plain_mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def plain_digest(text, rank):
    """The chained filters of one text as sets of bits, from the definition."""
    classes = [plain_class(text[i : i + 64]) for i in range(len(text) - 63)]
    if not text:
        starts = []
    elif len(text) < 64:
        starts = [0]
    else:
        votes = collections.Counter()
        for s in range(max(1, len(classes) - 63)):
            run = [(rank[c], s + i) for i, c in enumerate(classes[s : s + 64]) if rank[c] <= 1000]
            if run:
                votes[min(run)[1]] += 1
        order = sorted(votes, key=lambda i: (-votes[i], i))
        starts = sorted(i for n, i in enumerate(order) if votes[i] >= 16 or n < 8)
    chain = [set() for _ in range(-(-len(starts) // 160))]
    for n, i in enumerate(starts):
        window = text[i : i + 64]
        h, padded = len(window), window.ljust(64, b"\0")
        for k in range(8):
            h = plain_mix((h * 0x9E3779B97F4A7C15 + int.from_bytes(padded[8 * k : 8 * k + 8], "little")) & MASK)
        chain[n // 160] |= {(h >> 11 * k) % 2048 for k in range(5)}
    return chain


def plain_likeness(a, b):
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    a, b = sorted((a, b), key=len) if len(a) != len(b) else (a, b)
    total = 0.0
    for one in a:
        found = []
        for other in b:
            chance = len(one) * len(other) / 2048
            found.append((len(one & other) - chance) / max(min(len(one), len(other)) - chance, 1e-9))
        total += min(1.0, max(0.0, max(found)))
    return min(total / len(a), 1.0)


def test_edits_against_brute_force(session):
    """The whole query: ranks of the corpus, features, filters, both likenesses."""
    rng = random.Random(6)
    texts = [cases._prose(i, n) for i, n in enumerate((400, 12, 1, 150, 90, 60))] + ["", None, "é漢" * 30, "z" * 200]
    texts += [texts[0][:900] + texts[3], "".join(rng.choices("abcdefghijklm", k=30_000)), texts[4]]
    ids = [-(2**63), 2**63 - 1, *rng.sample(range(-1000, 1000), len(texts) - 2)]
    rows = list(zip(ids, texts))
    docs = session.createDataFrame(rows, "doc_id long, text string").repartition(3)
    raw = [(t or "").encode() for t in texts]
    count = collections.Counter(plain_class(t[i : i + 64]) for t in raw for i in range(len(t) - 63))
    order = sorted(range(1001), key=lambda c: (count[c], -c))
    rank = {c: n for n, c in enumerate(order)} | {0: 1001}
    down = sorted(((d, t or "") for d, t in rows), key=lambda r: -r[0])
    wanted = {}
    for (d, text), (_, other) in zip(down, [*down[1:], down[0]]):
        n = len(text) // 3
        changed = text[: len(text) - n] + other[:n]
        prints = [plain_digest(x.encode(), rank) for x in (text, changed, other)]
        wanted[d] = (hashlib.sha256(changed.encode()).hexdigest(), prints, plain_likeness(*prints[:2]), plain_likeness(prints[0], prints[2]))
    bits = lambda text: [set(np.flatnonzero(np.unpackbits(f)).tolist()) for f in digest.from_text(text)]
    for size in (2_000, digest.BUCKET_BYTES):
        found = digest.compare_edited(docs, bucket_bytes=size).collect()
        assert sorted(r["doc_id"] for r in found) == sorted(wanted)
        for r in found:
            sha, prints, near_edited, near_next = wanted[r["doc_id"]]
            assert r["edited_sha256"] == sha
            assert bits(r["fingerprint"]) == prints[0] and bits(r["edited_fingerprint"]) == prints[1]
            assert abs(r["near_edited"] - near_edited) < 1e-12 and abs(r["near_next"] - near_next) < 1e-12


# -- language models -----------------------------------------------------------------


def labels_of(session, rows):
    return session.createDataFrame(rows, LABELS)


def brute_losses(rows, good):
    texts = [(d, [*cases.WORD.findall(t or ""), None]) for d, t in rows]  # None: the end
    pairs = lambda words: list(zip([None, *words], words))
    counts = [collections.Counter(), collections.Counter()]
    for d, words in texts:
        counts[1].update(pairs(words))
        if d in good:
            counts[0].update(pairs(words))
    size = len({v for _, v in counts[1]})
    totals = [sum(c.values()) for c in counts]
    models = []
    for c, scale in zip(counts, (1, totals[0] / totals[1] if totals[0] else 1)):
        single = collections.Counter()
        for (_, v), n in c.items():
            single[v] += n * scale
        models.append(({g: n * scale for g, n in c.items()}, single, sum(c.values()) * scale))
    s, out = entropy_difference.SMOOTHING, []
    for d, words in texts:
        means = []
        for two, one, total in models:
            loss = 0.0
            for u, v in pairs(words):
                p = (one[v] + s / size) / (total + s)
                loss -= math.log2((two.get((u, v), 0) + s * p) / (one[u] + s))
            means.append(loss / len(words))
        out.append((d, len(words), *means))
    return out


@pytest.mark.parametrize("chunk_bytes", [20_000, entropy_difference.common.CHUNK_BYTES])
def test_losses_awkward(session, awkward, chunk_bytes):
    rows = collected(awkward) + [(2**63 - 1, "the largest id"), (-(2**63), "the least id")]
    docs = session.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, `r.w` int").repartition(3)
    some = [(1, 0, 1, ""), (2, 0, 0, ""), (2, 0, 1, ""), (3, 0, None, ""), (None, 0, 1, ""), (11, 0, 0, ""), (2**63 - 1, 0, 1, "")]
    for labels, good in ((some, {1, 2, 2**63 - 1}), ([], set())):
        found = entropy_difference.score(docs, labels_of(session, labels), chunk_bytes=chunk_bytes).collect()
        found = [(r["row"]["doc_id"], *(round(r[c], 9) if c != "n_tokens" else r[c] for c in ("n_tokens", "target_loss", "background_loss"))) for r in found]
        wanted = [(d, n, round(a, 9), round(b, 9)) for d, n, a, b in brute_losses(rows, good)]
        for one, other in zip(cases.ordered(found), cases.ordered(wanted), strict=True):
            assert one[:2] == other[:2] and np.allclose(one[2:], other[2:], atol=1e-8)


def test_difference_tells_good_from_bad(session):
    folder = "/root/testdata/sf0.01"
    labels = session.read.parquet(f"{folder}/labels.parquet")
    found = entropy_difference.score(session.read.parquet(f"{folder}/documents.parquet"), labels)
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    scores = [[], []]
    for row in found.collect():
        if row["row"]["doc_id"] in quality:
            scores[quality[row["row"]["doc_id"]]].append(row["difference"])
    assert np.mean(scores[1]) < 0.1 < np.mean(scores[0])


def test_scores_without_target_or_rows(session, awkward, nothing):
    assert entropy_difference.score(nothing, labels_of(session, [])).collect() == []
    assert entropy_difference.score(awkward, labels_of(session, [])).count() == awkward.count()


# -- toxicity ------------------------------------------------------------------------


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def test_automata_are_the_edit_distance():
    rng = random.Random(2)
    terms = [("abcab", False), ("bcabcabca", False), ("abba", False), ("ccab", True)]
    lexicon = toxicity.Lexicon(terms)
    words = ["".join(rng.choices("abcd", k=rng.randint(1, 11))) for _ in range(5000)]
    words += ["abcab", "abca", "abcabd", "bcabcabc", "xbcabcabcax", "ccabxyz", "abb"]
    codes = np.concatenate([lexicon.code[[ord(c) for c in w]] for w in words])
    ends = np.cumsum([len(w) for w in words])
    found, results = lexicon.match(codes, ends - [len(w) for w in words], ends)
    wanted = {}
    for i, word in enumerate(words):
        near = [(distance(word, t), k) for k, (t, stem) in enumerate(terms) if not stem and distance(word, t) <= toxicity._errors_allowed(t)]
        if word.startswith("ccab"):
            wanted[i] = 6
        elif near:
            wanted[i] = 2 * min(near)[1] + (min(near)[0] > 0)
    assert dict(zip(found.tolist(), results.tolist())) == wanted


def test_quotation_counts_less_than_abuse():
    lexicon, weights = toxicity.Lexicon([("idiot", False)]), np.array([3.0])
    abuse, report, none, wrong = toxicity.features(
        ["you are an idiot today", 'he said "some idiot wrote it" there', "nothing of that", "you are an idoit idi0t"], lexicon, weights
    )
    assert abuse[0] > report[0] > 0 and report[1] > abuse[1]
    assert not none.any() and wrong[0] == 0 < wrong[2]


def toxic_corpus(session, n=600):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        text = cases._prose(1000 + i, rng.randint(20, 80))
        toxic = i % 5 == 0
        if toxic:
            words = text.split(" ")
            for _ in range(4):
                words.insert(rng.randint(0, len(words)), rng.choice(["grobulant", "flimzy", "snarkoid"]))
            text = " ".join(words)
        rows.append((i, text, *[None] * 11))
        labels.append((i, int(toxic), 1, "clash"))
    return cases.docs_of(session, rows), labels_of(session, labels)


def test_held_out_accuracy(session):
    docs, labels = toxic_corpus(session)
    found = toxicity.toxicity(docs, labels).collect()
    assert len(found) == 600
    for row in found:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert row["predicted"] == (row["score"] >= 0.5) and 0 <= row["score"] <= 1
    held = [r for r in found if r["held_out"]]
    assert sum(r["predicted"] == (r["doc_id"] % 5 == 0) for r in held) >= 0.98 * len(held)
    kept = toxicity.clean_rows(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in found if not r["predicted"]}


def test_misspelled_terms_are_found(session):
    docs, labels = toxic_corpus(session)
    model = toxicity.learn(docs, labels)
    texts = ["plain words and a grobuulant here snarkiod", "plain words and nothing else here"]
    scores = model.scores(toxicity.features(texts, toxicity.Lexicon(model.terms), model.weights))
    assert scores[0] > scores[1]


def test_awkward_rows_and_labels(session, awkward, nothing):
    labels = labels_of(session, [(1, 1, 1, ""), (1, 0, 0, ""), (None, 1, 1, ""), (2, None, 1, ""), (6, 0, 1, ""), (7, 0, 0, "")])
    for known in (labels, labels_of(session, [])):
        found = toxicity.toxicity(awkward, known).collect()
        assert sorted(str(r["doc_id"]) for r in found) == sorted(str(d) for d, _ in collected(awkward))
    assert toxicity.toxicity(nothing, labels).collect() == []


def matches(lexicon, words):
    codes = np.concatenate([lexicon.code[[ord(c) for c in w]] for w in words])
    ends = np.cumsum([len(w) for w in words])
    found, results = lexicon.match(codes, ends - [len(w) for w in words], ends)
    return dict(zip(found.tolist(), results.tolist()))


def test_stems_have_errors_beside_words():
    rng = random.Random(5)
    terms = [("abcabc", True), ("abcabcabca", False), ("bcab", True), ("cacacb", False), ("ccbba", True)]
    words = ["".join(rng.choices("abcd", k=rng.randint(1, 13))) for _ in range(6000)]
    words += ["abcabcab", "acabcxyz", "abccabc", "xabcabc", "abxabcabca", "baacabcabca", "bcabq", "ccbb", "cbbaddd"]
    wanted = {}
    for i, word in enumerate(words):
        near, sure = [], []
        for k, (term, stem) in enumerate(terms):
            errors = min(distance(word[:n], term) for n in range(len(word) + 1)) if stem else distance(word, term)
            if errors <= toxicity._errors_allowed(term):
                near.append((errors, k))
            if stem and errors == 0:
                sure.append((word.index(term) + len(term), k))
        if sure:
            wanted[i] = 2 * min(sure)[1]
        elif near:
            wanted[i] = 2 * min(near)[1] + (min(near)[0] > 0)
    assert matches(toxicity.Lexicon(terms), words) == wanted


def test_letters_of_many_scripts_match():
    """More distinct letters than the dense part of the table has, some beyond 16 bits."""
    letters = [chr(0xAC00 + i) for i in range(900)] + [chr(0x10400 + i) for i in range(40)] + [chr(0x61 + i) for i in range(26)]
    terms = [("".join(letters[i : i + 6]), False) for i in range(0, len(letters), 6)]
    words = [t for t, _ in terms]
    wrong = [w[:2] + "￿" + w[3:] for w in words if len(w) > 4]
    other = [w[:2] + "ÿÿÿ" for w in words]
    found = matches(toxicity.Lexicon(terms), words + wrong + other)
    assert {i: r for i, r in found.items() if i < len(words)} == {i: 2 * i for i in range(len(words))}
    assert {i - len(words): r for i, r in found.items() if len(words) <= i < len(words) + len(wrong)} == {i: 2 * i + 1 for i in range(len(wrong))}
    assert not any(i >= len(words) + len(wrong) for i in found)
    texts = [f"some text {words[0]} and {words[152]} here"]
    assert toxicity.features(texts, toxicity.Lexicon(terms), np.ones(len(terms)))[0, 0] > 0


def test_best_terms_go_by_odds():
    row = lambda term, stem, odds: {"term": term, "stem": stem, "odds": odds}
    good = [row("low", 1, 1.0), row("lowest", 0, 1.0), row("grob", 1, 5.0), row("grobu", 1, 4.0), row("grobul", 1, 4.0),
            row("grobulant", 0, 4.5), row("grobu", 0, 4.0), row("flimzy", 0, 6.0)]
    kept = [(r["term"], r["stem"]) for r in toxicity._best(good, 4)]
    assert kept == [("flimzy", 0), ("grob", 1), ("grobulant", 0), ("grobu", 1)]
    assert [r["term"] for r in toxicity._best(good, 9)][4:] == ["low", "lowest"]


def test_misspelled_beginnings_of_stems_are_found(session):
    rng = random.Random(6)
    ends = ["ant", "ous", "ify", "ern", "ish", "ette", "oid", "ling", "arian", "esque"]
    rows, labels = [], []
    for i in range(600):
        words = cases._prose(3000 + i, rng.randint(20, 60)).split(" ")
        if i % 5 == 0:
            for _ in range(4):
                words.insert(rng.randint(0, len(words)), "grobul" + rng.choice(ends))
        rows.append((i, " ".join(words), *[None] * 11))
        labels.append((i, int(i % 5 == 0), 1, ""))
    model = toxicity.learn(cases.docs_of(session, rows), labels_of(session, labels))
    texts = ["plain words and gorbulish here", "plain words and grxbulquux here", "plain words and nothing else here"]
    found = toxicity.features(texts, toxicity.Lexicon(model.terms), model.weights)
    assert found[0, 2] > 0 and found[1, 2] > 0 and not found[2].any()
