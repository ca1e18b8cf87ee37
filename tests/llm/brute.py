"""Plain single-process versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
NULL_ID = -(1 << 63)


def key(doc_id):
    return NULL_ID if doc_id is None else doc_id


def cover(n, starts, length):
    gone = bytearray(n)
    for s in starts:
        gone[s : s + length] = b"\1" * length
    return gone


def byte_dedup(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for (d, _), b in zip(rows, texts):
        gone = cover(len(b), [i for i in range(len(b) - length + 1) if seen[b[i : i + length]] > 1], length)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def word_dedup(rows, length):
    """(doc_id, n_words, n_removed, kept_sha256)."""
    words = [WORD.findall((t or "").encode()) for _, t in rows]
    least = {}
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - length + 1):
            k = tuple(w[i : i + length])
            least[k] = min(least.get(k, 1 << 63), key(d))
    out = []
    for (d, _), w in zip(rows, words):
        gone = cover(len(w), [i for i in range(len(w) - length + 1) if least[tuple(w[i : i + length])] < key(d)], length)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, n):
    b = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = WORD.findall(b)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def jaccard(rows, num, den, n):
    """(doc_id, n_shingles, component)."""
    sets = [shingles(t, n) for _, t in rows]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holders[x])
        for x in s:
            holders[x].append(i)
        for j, c in common.items():
            if den * c >= num * (len(s) + len(sets[j]) - c):
                a, b = root(key(rows[i][0])), root(key(rows[j][0]))
                up[max(a, b)] = min(a, b)
    real = {NULL_ID: None}
    return [(d, len(s), real.get(root(key(d)), root(key(d)))) for (d, _), s in zip(rows, sets)]
