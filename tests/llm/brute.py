"""Plain Python forms of the operators, for small inputs."""

from __future__ import annotations

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


class Forest:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def jaccard_components(docs):
    """doc_id -> (set size, component) of (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t) for i, t in docs}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    forest = Forest(sets)
    for i, s in sets.items():
        common = collections.Counter(j for g in s for j in holders[g] if j < i)
        for j, both in common.items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                forest.join(i, j)
    return {i: (len(s), forest.root(i)) for i, s in sets.items()}


def repeat_words(text):
    words = WORD.findall(text or "")
    at = collections.defaultdict(list)
    for k in range(len(words) - 2):
        at[tuple(words[k:k + 3])].append(k)
    return len({k + o for places in at.values() if len(places) > 1 for k in places for o in range(3)})
