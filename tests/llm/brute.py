"""Plain versions of the operators, for small fixtures."""

from __future__ import annotations

import re
from itertools import combinations


def shingles(text: str | None, words: int) -> frozenset:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1)))


def jaccard_components(rows: list[tuple], words: int, share: int = 85, of: int = 100) -> dict:
    """id -> (n_shingles, component_id), ids unique."""
    sets = {i: shingles(t, words) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    pairs = {p for own in by.values() for p in combinations(sorted(own), 2)}
    for a, b in pairs:
        if of * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def repeated(rows: list[tuple], least: int, keep_first: bool) -> list[tuple]:
    """(id, n_bytes, n_removed, n_spans, kept bytes) by row."""
    raws = [(i, (t or "").encode()) for i, t in rows]
    seen: dict[bytes, list] = {}
    for k in sorted(range(len(raws)), key=lambda k: (raws[k][0] is not None, raws[k][0] or 0)):
        r = raws[k][1]
        for a in range(len(r) - least + 1):
            seen.setdefault(r[a : a + least], []).append((k, a))
    cover = [bytearray(len(r)) for _, r in raws]
    for places in seen.values():
        if len(places) > 1:
            for k, a in places[keep_first:]:
                cover[k][a : a + least] = b"\x01" * least
    out = []
    for (i, r), c in zip(raws, cover):
        kept = bytes(x for x, y in zip(r, c) if not y)
        spans = sum(1 for j in range(len(c)) if c[j] and not (j and c[j - 1]))
        out.append((i, len(r), len(r) - len(kept), spans, kept))
    return out
