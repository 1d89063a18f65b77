"""Plain single-process versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def shingles(text: str | None, size: int = 5) -> set[tuple[str, ...]]:
    words = WORD.findall(_lower(text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def roots(nodes, edges) -> dict:
    """Smallest node reachable from each."""
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def near_components(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id -> (number of shingles, component)."""
    sets = {d: shingles(t) for d, t in rows}
    at, both = defaultdict(list), Counter()
    for d, s in sets.items():
        for x in s:
            both.update((o, d) for o in at[x])
            at[x].append(d)
    edges = [(a, b) for (a, b), n in both.items() if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n)]
    return {d: (len(sets[d]), r) for d, r in roots(sets, edges).items()}


def removed_repeats(rows: list[tuple[int, str | None]], keep_first: bool, size: int = 200) -> dict[int, tuple[int, int, int, str]]:
    """doc_id -> (bytes, removed, spans, digest of the rest); rows in order of their places."""
    texts = [(d, (t or "").encode()) for d, t in rows]
    count: Counter = Counter()
    seen: set[bytes] = set()
    for _, t in texts:
        count.update(t[i : i + size] for i in range(len(t) - size + 1))
    out = {}
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            s = t[i : i + size]
            if s in seen if keep_first else count[s] > 1:
                gone[i : i + size] = b"\1" * size
            seen.add(s)
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out[d] = (len(t), len(t) - len(kept), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out
