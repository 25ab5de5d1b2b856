"""Plain-Python versions of the operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re

WORDS, GOOD = "the of and river stone light garden winter market bridge letter music window silver forest".split(), 5

PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def shingles(text, n=5):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) or frozenset([tuple(w)])


def jaccard_components(texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def luhn(digits):
    return sum(d if k % 2 == 0 else (2 * d) // 10 + (2 * d) % 10 for k, d in enumerate(map(int, digits[::-1]))) % 10 == 0


def pii_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                "card": 12 <= len(d) <= 19 and luhn(d) if d else False,
                "phone": 9 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), rank, kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def repeats(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def longest_match(word, begin, inside):
    at, n, pieces = 0, 0, begin
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return 1
        at, n, pieces = end, n + 1, inside
    return n
