"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    w = words(lower(text))
    return {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def join(docs, k, percent):
    """{doc_id: (n, component, links)} of [(doc_id, text)]."""
    sets = [(i, shingles(t, k)) for i, t in docs]
    up, links = {i: i for i, _ in docs}, Counter()

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            (i, s), (j, t) = sets[a], sets[b]
            if s and t and min(len(s), len(t)) * 100 >= percent * max(len(s), len(t)):
                both = len(s & t)
                if 100 * both >= percent * (len(s) + len(t) - both):
                    links[i] += 1
                    links[j] += 1
                    x, y = root(i), root(j)
                    up[max(x, y)] = min(x, y)
    return {i: (len(s), root(i), links[i]) for i, s in sets}


def repeats(docs, size=13):
    """{doc_id: (words, removed, sha)}: words covered by a window that also starts in a document of smaller id."""
    first = {}
    for i, t in docs:
        w = words(t)
        for p in range(len(w) - size + 1):
            key = tuple(w[p: p + size])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - size + 1):
            if first[tuple(w[p: p + size])] < i:
                gone[p: p + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def byte_repeats(docs, size=400):
    """{row: (doc_id, bytes, removed, spans, sha)}: bytes covered by a string of ``size`` that also starts elsewhere."""
    data = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[p: p + size] for _, b in data for p in range(len(b) - size + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if seen[b[p: p + size]] > 1:
                gone[p: p + size] = b"\x01" * size
        spans = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def longest_repeats(docs, size=250):
    """Per row: (doc_id, longest run covered by strings of ``size`` bytes that also start elsewhere)."""
    out = []
    data = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[p: p + size] for _, b in data for p in range(len(b) - size + 1))
    for i, b in data:
        hit = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if seen[b[p: p + size]] > 1:
                hit[p: p + size] = b"\x01" * size
        out.append((i, max((len(r) for r in bytes(hit).split(b"\x00")), default=0)))
    return out


def quality(text):
    w = words(text)
    seen = Counter(tuple(w[i: i + 8]) for i in range(len(w) - 7))
    hit = set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i: i + 8])] > 1:
            hit.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))
