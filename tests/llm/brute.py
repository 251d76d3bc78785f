"""Plain versions of the corpus operators for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def repeated_words(rows, length):
    words = [WORD.findall((t or "").encode()) for _, t in rows]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (key, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone.update(range(i, i + length))
        out.append((key, len(w), len(gone), sha(b" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def earlier_strings(rows, length):
    """A null id is larger than any other."""
    texts = [(float("inf") if k is None else k, (t or "").encode()) for k, t in rows]
    first = {}
    for k, t in texts:
        for i in range(len(t) - length + 1):
            s = t[i : i + length]
            first[s] = min(first.get(s, float("inf")), k)
    out = []
    for (key, _), (k, t) in zip(rows, texts, strict=True):
        gone = set()
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < k:
                gone.update(range(i, i + length))
        spans = sum(i - 1 not in gone for i in gone)
        out.append((key, len(t), len(gone), spans, sha(bytes(x for i, x in enumerate(t) if i not in gone))))
    return out


def simhash(text, shingle=3):
    words = WORD.findall((text or "").encode().lower())
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    digests = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(d >> b & 1 for d in digests) > len(digests))


def linked(values, distance):
    """The smallest index reachable from each, over links of at most ``distance`` bits."""
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if (a ^ b).bit_count() <= distance and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def contaminated(docs, items, length):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: cut.findall((t or "").translate(lower))
    windows = {}
    for key, text in items:
        w = words(text)
        for i in range(max(1, len(w) - length + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + length]), set()).add(str(key))
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((key, len(w), len(hit), sorted(found), bool(hit)))
    return out


def crc(text) -> int:
    return zlib.crc32((text or "").encode())
