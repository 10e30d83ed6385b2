"""Brute-force twins of the pipeline's stages."""

import itertools
import re
import string


def _words(text):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return re.findall(rb"[^\x20\x09-\x0D]+", raw)


def components_of(texts, percent):
    """Smallest ids of the components of near copies."""
    sets = {}
    for i, t in texts.items():
        w = _words(t)
        sets[i] = {tuple(w[k: k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
            lo, hi = sorted((root(a), root(b)))
            comp[hi] = lo
    return [i for i in comp if root(i) == i]


def tiles_cover(text, item, least, share):
    """Whether greedy tiles cover the share of the item (tiles without overlaps that matter here: distinct words)."""
    strip = string.punctuation.encode()
    p, t = ([x for x in (w.strip(strip) for w in _words(s)) if x] for s in (item, text))
    if len(p) < least:
        return False
    seeds = {tuple(p[k: k + least]) for k in range(len(p) - least + 1)}
    if not any(tuple(t[k: k + least]) in seeds for k in range(len(t) - least + 1)):
        return False
    covered, used = [False] * len(p), [False] * len(t)
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(p)):
            for j in range(len(t)):
                k = 0
                while i + k < len(p) and j + k < len(t) and p[i + k] == t[j + k] and not covered[i + k] and not used[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return sum(covered) >= share * len(p)
        n, i, j = best
        covered[i: i + n] = used[j: j + n] = [True] * n
