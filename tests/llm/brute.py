"""Plain-Python versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"


def lower(s: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def line_dedup(docs, min_chars=20, min_docs=3):
    """[(id, text)] -> [(id, kept text, lines, dropped)]"""
    key = lambda line: lower(line.strip(SPACE))
    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (
            len(holders.get(key(x), ())) >= min_docs and i != max((h for h in holders[key(x)] if h is not None), default=None))]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def words(text: str) -> list[str]:
    """Normalised words: ASCII letters and digits and what lies beyond ASCII, capitals lowered."""
    folded = re.sub("[À-ÖØ-Þ]", lambda m: m[0].lower(), lower(text))
    return re.findall("[0-9a-z\x80-\U0010ffff]+", folded)


def shingles(text: str | None) -> frozenset:
    w = words(text or "")
    if not w:
        return frozenset()
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)])


def near_classes(docs, threshold=0.8):
    """[(id, text)] with ids -> {id: (class id, copy of, links)}"""
    least = {}
    for i, t in sorted(docs):
        least.setdefault(t, i)
    sets = {i: shingles(t) for t, i in least.items()}
    links = Counter()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: ((find(least[t]), least[t], links[least[t]]) if sets[least[t]] else (i, i, 0)) for i, t in docs}


def best_edits(pattern, text) -> int:
    """Least edits between the pattern and any run of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern):
        now = [i + 1]
        for j, t in enumerate(text):
            now.append(min(row[j] + (p != t), row[j + 1] + 1, now[j] + 1))
        row = now
    return min(row)


def leaks(text, items, budget=0.2):
    """[(item id, distance)] of the items within their budget."""
    w = words(text or "")
    out = []
    for i, item in items:
        p = words(item or "")
        if p and w:
            d = best_edits(p, w)
            if d <= int(budget * len(p)):
                out.append((i, d))
    return sorted(out)
