"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=True):
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER) if lower else text)


def without_repeats(texts, length):
    """(bytes, removed, spans, sha256 of the rest) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, size):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def near_groups(rows, size, percent=80):
    """(number of shingles, smallest id reachable) of each (id, text)."""
    sets = [shingles(t, size) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            ids[g] = min(i, ids.get(g, i))
    return [(len(s), ids.get(g) if s else i) for s, g, (i, _) in zip(sets, group, rows)]
