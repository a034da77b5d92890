"""All-pairs near duplicates on full sets, for the tests."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, width, num, den):
    """doc -> (set size, smallest id reached), over shingles in common."""
    sets = {i: shingles(t, width) for i, t in rows}
    by = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            by[x].add(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        common = defaultdict(int)
        for x in s:
            for j in by[x]:
                if j < i:
                    common[j] += 1
        for j, c in common.items():
            if den * c >= num * (len(s) + len(sets[j]) - c):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}
