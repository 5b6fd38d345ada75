"""Plain versions of the operators, for comparison."""

from __future__ import annotations

import re
import string
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def shingles(text: str | None) -> frozenset:
    w = words((text or "").translate(_LOWER))
    return frozenset(tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset()


def near_components(docs: list[tuple[int, str | None]]) -> dict[int, int]:
    """Least doc_id reachable over links of all pairs."""
    sets = [(i, shingles(t)) for i, t in docs]
    root = {i: i for i, _ in sets}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and min(len(a), len(b)) * 100 >= 85 * max(len(a), len(b)):
                shared = len(a & b)
                if 100 * shared >= 85 * (len(a) + len(b) - shared):
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in sets}


def quality(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen: set[str] = set()
    duplicates = 0
    for x in lines:
        duplicates += x in seen
        seen.add(x)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered: set[int] = set()
    for i in range(len(w) - 4):
        if grams[tuple(w[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered)
