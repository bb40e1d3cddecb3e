"""Rows with every awkward case, and brute-force versions of what SQL can't express."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, chunk string, key string, `print` int, ids string, score string, bucket int, _bad long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _prose(seed, words):
    rng = random.Random(seed)
    vocabulary = [("".join(rng.choices("aeioubcdglmnrst", k=rng.randint(2, 7)))) for _ in range(400)]
    out = []
    for i in range(words):
        out.append(rng.choice(vocabulary) + (".\n" if i % 9 == 8 else " "))
    return "".join(out).strip()


def awkward_rows():
    shared = _prose(1, 120)
    near = shared.split(" ")
    near[60] = "changed"
    texts = [
        (1, shared), (2, shared), (2, shared), (3, None), (4, ""), (5, "   \n\t "), (6, "one"),
        (7, "two words"), (8, " ".join(near)), (9, _prose(2, 30_000)), (10, "a" * 5000),
        (11, "Ünï cödé ▁ 漢字 \x00 \x85 😀 " * 30), (12, _prose(3, 90) + "\n" + shared + "\n" + _prose(4, 90)),
        (13, _prose(3, 90) + "\n\n" + _prose(5, 40)), (None, shared), (None, None), (None, "lonely text of a null id"),
        (14, "same line\n" * 40), (15, "ab " * 700), (-5, "negative id with few words here"), (16, None),
    ]
    return [(d, t, "en", "s", len(t or ""), 1, "c", "k", 2, "i", "x", 3, 4) for d, t in texts]


def docs_of(spark, rows=None):
    return spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA)


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: [(x is None, x) for x in r])


def spans(flags):
    return sum(1 for i, f in enumerate(flags) if f and (i == 0 or not flags[i - 1]))


def repeated_bytes(rows, window):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + window] for _, b in texts for i in range(len(b) - window + 1))
    out = []
    for d, b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if seen[b[i : i + window]] > 1:
                gone[i : i + window] = True
        rest = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((d, len(b), int(gone.sum()), spans(gone.tolist()), hashlib.sha256(rest).hexdigest()))
    return out


def repeated_words(rows, window):
    order = lambda d: (d is None, d or 0)
    texts = [(d, WORD.findall(t or "")) for d, t in rows]
    first = {}
    for d, words in texts:
        for i in range(len(words) - window + 1):
            gram = tuple(words[i : i + window])
            first[gram] = min(first.get(gram, order(d)), order(d))
    out = []
    for d, words in texts:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < order(d):
                gone[i : i + window] = [True] * window
        rest = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((d, len(words), sum(gone), hashlib.sha256(rest.encode()).hexdigest()))
    return out


def simhash(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(rows, radius=4):
    prints = [simhash(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                group[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, f"{prints[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)]


def contained(rows, items, n=5, threshold=0.8):
    def words_of(text):
        return re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))

    def shingles(words, size):
        return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}

    out = []
    for d, t in rows:
        mine = words_of(t)
        for i, text in items:
            words = words_of(text)
            size = min(n, len(words))
            asked = shingles(words, size) if size else set()
            shared = len(asked & shingles(mine, size)) if asked else 0
            if asked and shared >= threshold * len(asked):
                out.append((d, i, shared, len(asked)))
    return out


def marked_pairs(lines):
    """Starts of the pairs of lines that are chunks, from the definition."""
    x = [int(hashlib.md5(line.encode()).hexdigest()[:8], 16) for line in lines]
    value = {}
    for i in range(len(lines) - 1):
        if (lines[i] + lines[i + 1]).encode().strip():
            value[i] = (x[i] * 1_000_003 + x[i + 1]) % 2**32
    if len(lines) == 2:
        return sorted(value)
    windows = [(i, i + 1) for i in range(len(lines) - 2)]
    return sorted({min(w, key=lambda i: (value.get(i, 2**32), i)) for w in windows} & set(value))


def kept_lines(rows):
    """(doc_id, text left, lines, lines removed), from all chunks of the corpus at once."""
    texts = [(d, (t or "").split("\n")) for d, t in rows]
    order = lambda d, at: (d is None, d or 0, at)
    marks = [marked_pairs(lines) for _, lines in texts]
    places = {}
    for (d, lines), starts in zip(texts, marks):
        for n, at in enumerate(starts):
            low = starts[n - 1] if n else 0
            high = starts[n + 1] + 2 if n + 1 < len(starts) else len(lines)
            body = "\n".join(lines[at : at + 2])
            around = [("".join(x + "\n" for x in part)).encode() for part in (lines[low:at], lines[at + 2 : high])]
            places.setdefault(body, []).append((order(d, at), *around, lines[low:at], lines[at + 2 : high]))
    first = {body: min(found) for body, found in places.items()}
    out = []
    for (d, lines), starts in zip(texts, marks):
        gone = set()
        for at in starts:
            place, _, _, before, behind = first["\n".join(lines[at : at + 2])]
            if place < order(d, at):
                low, high = at, at + 2
                while at - low < len(before) and low > 0 and lines[low - 1] == before[-1 - (at - low)]:
                    low -= 1
                while high - at - 2 < len(behind) and high < len(lines) and lines[high] == behind[high - at - 2]:
                    high += 1
                gone |= set(range(low, high))
        kept = [x for i, x in enumerate(lines) if i not in gone]
        out.append((d, "\n".join(kept), len(lines), len(gone)))
    return out


def token_digests(rows, tokenizer, end=2):
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, end]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out
