"""Plain versions of the operators, to hold their results against."""

from __future__ import annotations

import re
import struct
from collections import Counter, defaultdict

import xxhash

SPACE = r"[\x20\x09-\x0D]+"


def hashed(*parts):
    """Spark's hash of longs and texts, nulls left out."""
    h = 42
    for part in parts:
        if part is not None:
            data = part.encode() if isinstance(part, str) else struct.pack("<q", part)
            h = xxhash.xxh64(data, seed=h).intdigest()
    return h - (1 << 64) if h >> 63 else h


def words(text: str) -> list[str]:
    return [w for w in re.split(SPACE, text) if w]


def shingles(text: str, n: int = 5) -> set:
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def near_classes(rows: list[tuple]) -> list[tuple]:
    """``(id, class, links)`` of ``(id, text)`` by comparing all pairs that share an n-gram."""
    sets = [shingles(t) if i is not None else set() for i, t in rows]
    parent = list(range(len(rows)))

    def find(a: int) -> int:
        while parent[a] != a:
            a = parent[a]
        return a

    holders = defaultdict(list)
    links = [0] * len(rows)
    for a, own in enumerate(sets):
        shared = Counter(b for gram in own for b in holders[gram])
        for gram in own:
            holders[gram].append(a)
        for b, n in shared.items():
            if 9 * n >= 4 * (len(own) + len(sets[b])):
                links[a] += 1
                links[b] += 1
                parent[max(find(a), find(b))] = min(find(a), find(b))
    least: dict[int, int] = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return [(i, None if i is None else least[find(a)], links[a]) for a, (i, _) in enumerate(rows)]


def repeated(texts: list[str], length: int = 400) -> list[tuple[int, int, bytes]]:
    """Removed bytes, runs and what is left of each text, string by string."""
    data = [t.encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    result = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        result.append((sum(gone), runs, bytes(b for b, g in zip(d, gone) if not g)))
    return result


def quality_counts(text: str) -> tuple[int, int, int, int, int]:
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count = Counter(grams)
    covered = {k for i, g in enumerate(grams) if count[g] > 1 for k in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the four formats."""
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    return sorted(
        (m.start(), k, m.end())
        for k, (pattern, good) in enumerate(kinds)
        for m in re.finditer(pattern, text)
        if good(m.group())
    )
