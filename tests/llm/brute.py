"""Plain Python versions of the operators, for small tables."""

import hashlib
from collections import Counter

import numpy as np
import regex
import xxhash


def without_repeats(texts, length):
    """(bytes left, bytes removed, runs) of each text."""
    bodies = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for body in bodies:
        gone = np.zeros(len(body), bool)
        for i in range(len(body) - length + 1):
            if seen[body[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((kept, int(gone.sum()), int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0))
    return out


def print_of(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius):
    """Smallest index that each can reach."""
    group = list(range(len(prints)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = sorted((root(i), root(j)))
                group[y] = x
    return [root(i) for i in range(len(prints))]


def words(text):
    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def best_window(text, item):
    """Highest similarity of any window of the item's size, all shingles alike."""
    doc, wanted = words(text), words(item)
    runs = lambda x: Counter(tuple(x[i : i + 5]) for i in range(len(x) - 4)) or Counter([tuple(x)] if x else [])
    target, best = runs(wanted), 0.0
    for start in range(max(1, len(doc) - len(wanted) + 1)):
        window = runs(doc[start : start + len(wanted)])
        if window | target:
            best = max(best, (window & target).total() / (window | target).total())
    return best


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
