"""Periodic runs of words: longest common extensions on suffix trees of a text and of its reversal, Lyndon roots extended both ways."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walkgrid.llm.common import raw_texts, with_columns_in_arrow

#: Bytes of text whose results are held before they are handed on.
SLICE_BYTES = 4 << 20


def suffix_tree(s: list[int]) -> tuple[list[int], list[int], dict[int, int], int]:
    """Ukkonen's tree of ``s``, whose last symbol is 0 and occurs nowhere else: where each node's edge label starts and stops, and
    the child of ``node * width + symbol`` (also returned: ``width``). Node 0 is the root; leaves are made in order of suffixes."""
    n, width = len(s), max(s) + 1
    start, stop, link, child = [0], [0], [0], {}
    node = edge = length = waiting = 0
    for i, c in enumerate(s):
        need = 0  # inner node that still lacks its suffix link
        waiting += 1
        while waiting:
            if not length:
                edge = i
            key = node * width + s[edge]
            under = child.get(key)
            if under is None:
                child[key] = len(start)
                start.append(i), stop.append(n), link.append(0)
                if need:
                    link[need] = node
                need = node
            else:
                at = start[under]
                long = (stop[under] if stop[under] <= i else i + 1) - at
                if length >= long:
                    edge += long
                    length -= long
                    node = under
                    continue
                if s[at + length] == c:
                    length += 1
                    if need:
                        link[need] = node
                    break
                mid = len(start)
                child[key] = mid
                child[mid * width + c] = mid + 1
                child[mid * width + s[at + length]] = under
                start.append(at), stop.append(at + length), link.append(0)
                start.append(i), stop.append(n), link.append(0)
                start[under] = at + length
                if need:
                    link[need] = mid
                need = mid
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return start, stop, child, width


class Extensions:
    """Longest common extension of any two suffixes in constant time: the lowest point of the Euler tour between two leaves.

    Of the tour only the string depth at its lowest point between neighbouring leaves is kept; a table of minima over powers
    of two answers for any pair. ``rank`` is the place of each suffix in lexical order (the terminal symbol is the smallest).
    """

    def __init__(self, s: list[int]) -> None:
        start, stop, child, width = suffix_tree(s)
        n, nodes = len(s), len(start)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        order = np.argsort(keys)[::-1]  # of a parent the largest symbol first, so that the smallest is on top of the stack
        kids = np.fromiter(child.values(), np.int64, len(child))[order]
        parent = keys[order] // width
        first = np.searchsorted(-parent, -np.arange(nodes))
        last = np.searchsorted(-parent, -np.arange(nodes), side="right")
        opens = np.zeros(nodes, bool)  # the smallest child of its parent
        opens[kids[np.append(parent[1:] != parent[:-1], True)]] = True
        up = np.zeros(nodes, np.int64)
        up[kids] = parent
        up, opens, kids, first, last = up.tolist(), opens.tolist(), kids.tolist(), first.tolist(), last.tolist()
        depth, leaves, low, stack = [0] * nodes, [], [], kids[first[0] : last[0]]
        while stack:
            v = stack.pop()
            above = depth[up[v]]
            if not opens[v]:
                low.append(above)
            a, b = first[v], last[v]
            if a == b:
                leaves.append(n - start[v] + above)  # its suffix, by length
            else:
                depth[v] = above + stop[v] - start[v]
                stack += kids[a:b]
        self.rank = np.empty(n, np.int64)
        self.rank[n - np.array(leaves)] = np.arange(n)
        self.minima = [np.array(low, np.int32)]
        step = 1
        while 2 * step <= len(low):
            row = self.minima[-1]
            self.minima.append(np.minimum(row[:-step], row[step:]))
            step *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of suffixes ``i`` and ``j``, which differ."""
        a, b = self.rank[i], self.rank[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        level = np.log2(b - a).astype(np.int64)
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            of = level == k
            out[of] = np.minimum(self.minima[k][a[of]], self.minima[k][b[of] - (1 << k)])
        return out


def _next_lower(rank: list[int]) -> list[int]:
    """For each suffix the next one that is lower; the end if there is none."""
    out, open_ = [len(rank)] * len(rank), []
    for j, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            out[open_.pop()] = j
        open_.append(j)
    return out


def runs_of(s: np.ndarray) -> np.ndarray:
    """All maximal repetitions (length at least twice the smallest period) of a sequence of small numbers: rows ``start, length,
    period``, sorted. Every run holds a Lyndon root, in the order of symbols or in its reverse, that is the longest Lyndon word
    at its place, so the longest Lyndon words of both orders are all candidates."""
    n = len(s)
    if n < 2:
        return np.empty((0, 3), np.int64)
    ahead, back = Extensions([*(s + 1).tolist(), 0]), Extensions([*(s[::-1] + 1).tolist(), 0])
    rank, found = ahead.rank, []
    for order in (rank, -rank):
        i = np.arange(n)
        p = np.array(_next_lower(order.tolist())[:n]) - i
        i, p = i[i + 2 * p <= 2 * n], p[i + 2 * p <= 2 * n]
        inside = i + p < n
        i, p = i[inside], p[inside]
        right = ahead(i, i + p)
        left = np.zeros(len(i), np.int64)
        has = i > 0
        left[has] = back(n - i[has], n - i[has] - p[has])  # what ends before i and before i + p, read backwards
        keep = left + right >= p
        found.append(np.stack(((i - left)[keep], (left + right + p)[keep], p[keep]), 1))
    return np.unique(np.concatenate(found), axis=0)


def numbered(texts: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word of several texts, one after the other (the place of its first occurrence in its own text, so no two
    texts share a number), and where each text starts, with the end of the last."""
    ends, ids = [0], []
    for words in texts:
        first: dict = {}
        ids += map(first.setdefault, words, range(ends[-1], ends[-1] + len(words)))
        ends.append(len(ids))
    return np.array(ids, np.int64), np.array(ends)


def pieces(ids: np.ndarray, ends: np.ndarray, min_length: int, min_exponent: int) -> list[tuple[int, int]]:
    """Disjoint stretches, none across texts, that hold, with a word to each side, every run of ``min_exponent`` periods and
    ``min_length`` words.

    After its first period each word of a run of period q has occurred within the last q words. So for q from 2**j on below
    2**(j+1) only stretches of that many words of which each has a nearer earlier occurrence need to be looked at.
    """
    order = np.argsort(ids, kind="stable")
    gap = np.full(len(ids), len(ids) + 1)
    same = ids[order[1:]] == ids[order[:-1]]
    gap[order[1:][same]] = (order[1:] - order[:-1])[same]
    found, q, longest = [], 1, int(np.diff(ends).max(initial=0))
    while q * min_exponent <= longest:
        near = np.concatenate(([False], gap < 2 * q, [False]))
        edge = np.flatnonzero(near[1:] != near[:-1])
        a, b = edge[::2], edge[1::2]
        long = b - a >= max((min_exponent - 1) * q, min_length - 2 * q + 1)
        if long.any():
            a, b = a[long], b[long]
            of = np.searchsorted(ends, a, side="right")
            found += zip(np.maximum(ends[of - 1], a - 2 * q).tolist(), np.minimum(ends[of], b + 1).tolist(), ends[of].tolist(), strict=True)
        q *= 2
    out: list[tuple[int, int, int]] = []
    for x, y, end in sorted(found):
        if out and x <= out[-1][1] and end == out[-1][2]:
            out[-1] = (out[-1][0], max(y, out[-1][1]), end)
        else:
            out.append((x, y, end))
    return [(x, y) for x, y, _ in out]


def repetitions(texts: list[list], min_length: int = 6, min_exponent: int = 4) -> list[list[tuple[int, int, int]]]:
    """For each list of words its runs ``start, length, period`` of ``min_length`` words and ``min_exponent`` periods at least."""
    ids, ends = numbered(texts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for a, b in pieces(ids, ends, min_length, min_exponent):
        got = runs_of(np.unique(ids[a:b], return_inverse=True)[1])
        got = got[got[:, 1] >= np.maximum(min_length, min_exponent * got[:, 2])]
        of = int(np.searchsorted(ends, a, side="right")) - 1
        out[of] += [(a - int(ends[of]) + s, m, p) for s, m, p in got.tolist()]
    return out


_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_ARROW_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])


def find_runs(docs: DataFrame, text: str = "text", min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed_text``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0 and compared exactly. A run ``start, length, period`` is a stretch of smallest
    period q and at least ``max(min_length, min_exponent * q)`` words that no neighbour extends with that period; ``runs`` has all,
    by start, then period. ``collapsed_text`` has each run's first period only: a word that stands in any run after its first q
    words goes; the rest is joined by single blanks.

    Each text is handled alone, whole, where it lies: no shuffle. Trees are built only of stretches that can hold a run
    (``pieces``, an exact test), at about 600 bytes a word of the longest stretch. Null or empty text: no words, no runs, empty
    ``collapsed_text``. Repeated rows each keep their row; columns of ``docs`` named as an output are replaced, all others stay.
    An empty table gives no rows.
    """

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        n_words, runs, kept = [], [], []
        texts = [(raw or b"").split() for raw in raw_texts(batch.column(text))]
        for words, found in zip(texts, repetitions(texts, min_length, min_exponent), strict=True):
            n_words.append(len(words))
            runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
            if found:
                gone = np.zeros(len(words) + 1, np.int64)
                for start, length, period in found:
                    gone[start + period] += 1
                    gone[start + length] -= 1
                words = [words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]
            kept.append(b" ".join(words))
        return {
            "n_words": pa.array(n_words, pa.int64()),
            "runs": pa.array(runs, pa.list_(_ARROW_RUN)),
            "collapsed_text": pa.array(kept, pa.binary()).cast(pa.string()),
        }

    fields = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(_RUN)), T.StructField("collapsed_text", T.StringType())]
    return with_columns_in_arrow(docs, make, fields, sized_by=text, slice_bytes=SLICE_BYTES)


def with_loops(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 10) -> DataFrame:
    """``docs`` with periodic tails written into one text of ``every``, for trials of the search: let h = crc32(decimal id) and g =
    floor(h / every); if ``every`` divides h and the text has n > 0 words, each word i >= a = g % n becomes word a + (i - a) % p,
    p = 1 + floor((n - a) / (3 + g % 8)), words joined by blanks. Null ids and all other texts stay as they are."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / every)
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def looped(w):
        n = F.greatest(F.size(w), F.lit(1))
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + F.pmod(i - a, p)).cast("int")))), " ")

    changed = F.transform(F.array(words), looped)[0]  # the words are cut once, and only for the chosen rows
    return docs.withColumn(text, F.when(F.pmod(h, F.lit(every)) == 0, changed).otherwise(F.col(text)))
