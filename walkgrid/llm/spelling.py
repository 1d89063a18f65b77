"""Spelling variants: a trie over letter counts, searched with one surplus and one deficit, near words verified at its leaves."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from walkgrid.llm.common import Batches, mix, powers, table

#: Letter groups of the frequency vector, in the order of the trie's levels. Fixed values; any others give the same result.
GROUPS = ("e", "n", "t", "i", "a", "o", "r", "s", "h", "l", "d", "u", "cgmpw", "bfjkqvxyz")
#: Words that one part of the trie holds on average, and at most before it is dealt to blocks.
PART, BLOCK = 40_000, 100_000
#: Counts of words that a task holds before it hands them on, and characters of texts that are cut into runs at a time.
HELD, PIECE = 300_000, 1 << 20
#: Runs of more bytes have their checksum taken one by one.
SHORT = 64
#: Pairs that are verified at a time, and words up to this length in arrays; longer ones one by one.
PAIRS, WIDTH = 1 << 17, 64

_CUT = re.compile("[^A-Za-zÀ-ÿ]")
#: A-Z lower-cased, a-z and U+00C0 to U+00FF as they are, all else 0.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 192 else 0 for c in range(256))
_ZEROS = [zlib.crc32(bytes(k)) for k in range(SHORT)]


def _group_of() -> np.ndarray:
    """The group of each code point up to U+00FF: those of GROUPS, then two for letters outside ASCII."""
    out = np.array([len(GROUPS) + c % 2 for c in range(256)])
    for g, letters in enumerate(GROUPS):
        out[[ord(x) for x in letters]] = g
    return out


GROUP = _group_of()
LEVELS = len(GROUPS) + 2


def run_hashes(letters: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, start and end of each maximal run of bytes that are not 0."""
    raw = np.frombuffer(letters, np.uint8)
    edge = np.diff(np.concatenate(([True], raw == 0, [True])).view(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = powers(len(raw) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(raw * up[: len(raw)])))
    return mix((total[end] - total[start]) * down[start]), start, end


def _pieces(rows):
    """Lists of ``(id, text)`` of about PIECE characters, none of which cuts a run; a longer text is cut, a null one left out."""
    held, size = [], 0
    for i, text in rows:
        at = 0
        while at < len(text or ""):
            found = _CUT.search(text, at + PIECE) if len(text) - at > PIECE else None
            end = found.start() if found else len(text)
            held.append((i, text[at:end]))
            size, at = size + end - at, end
            if size >= PIECE:
                yield held
                held, size = [], 0
    if held:
        yield held


def _count(texts: list[tuple[str | None, str]], noise: int, shortest: int, held: Counter) -> None:
    """Adds the words of some texts to ``held``. Equal runs are told by 64 bits, once for each piece; a checksum that goes on from the
    id's is the run's own, combined with what the id's becomes over as many zero bytes."""
    raw = [t.encode("latin-1", "replace").translate(_FOLD) for _, t in texts]
    letters = b"\0".join(raw)
    hashes, start, end = run_hashes(letters)
    if not len(start):
        return
    _, first, which, n = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    runs = [letters[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
    if noise:
        wide = [r.decode("latin-1").encode() for r in runs]
        crc = np.fromiter(map(zlib.crc32, wide), np.uint32, len(wide))
        size = np.fromiter(map(len, wide), np.int64, len(wide))
        own = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i, _ in texts]
        moved = np.array([[zlib.crc32(bytes(k), c) ^ _ZEROS[k] for k in range(1, min(SHORT, int(size.max()) + 1))] for c in own], np.uint32)
        text = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), start, side="right")
        bytes_ = size[which]
        h = np.zeros(len(which), np.uint32)
        short = bytes_ < SHORT
        h[short] = moved[text[short], bytes_[short] - 1] ^ crc[which[short]]
        for k in np.flatnonzero(~short):
            h[k] = zlib.crc32(wide[which[k]], own[text[k]])
        hit = np.flatnonzero(h % noise == 0)
        n -= np.bincount(which[hit], minlength=len(n))
        for k, run in zip(h[hit].tolist(), which[hit].tolist(), strict=True):
            cut = k % len(runs[run])
            word = runs[run][:cut] + runs[run][cut + 1 :]
            if len(word) >= shortest:
                held[word] += 1
    for run, k in zip(runs, n.tolist(), strict=True):
        if k and len(run) >= shortest:
            held[run] += k


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", noise: int = 0, shortest: int = 5, least: int = 3) -> DataFrame:
    """``word, n``: occurrences of each word of ``shortest`` code points and ``least`` occurrences at least, over all texts.

    Words are the maximal runs ``[A-Za-z\\u00C0-\\u00FF]+``, with A-Z lower-cased. With ``noise``, for trials, each run whose
    h = crc32 of ``<id>:<run>`` is a multiple of it first loses the code point h % length. Counts are summed within a task before
    they are shuffled. Null texts have no words; a null id counts as empty text; a repeated row counts as often as it stands there.
    """

    def count(batches: Batches) -> Batches:
        held: Counter = Counter()

        def made() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for texts in _pieces(zip(batch.column(0).to_pylist(), (v.as_py() for v in batch.column(1)), strict=True)):
                _count(texts, noise, shortest, held)
                if len(held) >= HELD:
                    yield made()
        if held:
            yield made()

    parts = docs.select(F.col(doc_id).cast("string"), F.col(text)).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def vectors(words: list[bytes]) -> np.ndarray:
    """Letters of each group, in words of code points up to U+00FF; counts stop at 255, which keeps differences of one or less."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    letters = GROUP[np.frombuffer(b"".join(words), np.uint8)]
    out = np.bincount(np.repeat(np.arange(len(words)), size) * LEVELS + letters, minlength=len(words) * LEVELS)
    return np.minimum(out, 255).reshape(-1, LEVELS).astype(np.int16)


def _key(vectors: np.ndarray) -> np.ndarray:
    out = np.zeros(len(vectors), np.int64)
    for column in vectors.T:
        out = out * 256 + column
    return out


def _dealt(depth: int):
    """Rows ``part, visits, word, n``: each word at home in the part of the trie that its first ``depth`` counts name, and as a visitor
    in every later part that a budget of one surplus and one deficit reaches. Earlier parts send their words here."""

    def deal(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            vec = vectors([w.encode("latin-1") for w in batch.column(0).to_pylist()])[:, :depth]
            every = np.arange(batch.num_rows)
            rows = [(every, _key(vec), False)]
            for i in range(depth):
                more = vec[:, i] < 255
                for j in [None, *range(i + 1, depth)]:
                    can = every[more if j is None else more & (vec[:, j] > 0)]
                    there = vec[can].copy()
                    there[:, i] += 1
                    if j is not None:
                        there[:, j] -= 1
                    rows.append((can, _key(there), True))
            for of, part, visits in rows:
                of_words = pa.array(of)
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.full(len(of), visits)), batch.column(0).take(of_words), batch.column(1).take(of_words)], ["part", "visits", "word", "n"])

    return deal


def _reached(trie: np.ndarray, seekers: np.ndarray):
    """Depth-first search of the trie that the sorted rows ``trie`` form, for all ``seekers`` at once: pairs (rows of the trie, seekers)
    whose counts differ by one surplus and one deficit at most. A node is a range of rows; an edge skips the levels that all its
    rows share; a seeker goes on while its budget lasts."""
    none = np.zeros(len(seekers), np.int8)
    stack = [(0, 0, len(trie), np.arange(len(seekers)), none, none)]
    while stack:
        level, lo, hi, who, over, under = stack.pop()
        shared = trie[lo] != trie[hi - 1]
        until = int(np.argmax(shared)) if shared.any() else LEVELS
        if until > level:
            gap = trie[lo, level:until] - seekers[who, level:until]
            over, under = over + np.maximum(gap, 0).sum(1), under + np.maximum(-gap, 0).sum(1)
            go = (over <= 1) & (under <= 1)
            who, over, under = who[go], over[go], under[go]
        if not len(who):
            continue
        if until == LEVELS:
            yield np.repeat(np.arange(lo, hi), len(who)), np.tile(who, hi - lo)
            continue
        column = trie[lo:hi, until]
        cuts = [lo, *(np.flatnonzero(column[1:] != column[:-1]) + lo + 1).tolist(), hi]
        own = seekers[who, until]
        for a, b in zip(cuts, cuts[1:], strict=False):
            gap = int(trie[a, until]) - own
            go = ((gap == 0) | ((gap == 1) & (over == 0)) | ((gap == -1) & (under == 0))) & (abs(gap) <= 1)
            if go.any():
                g = gap[go]
                stack.append((until + 1, a, b, who[go], over[go] + (g > 0), under[go] + (g < 0)))


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether exactly one inserted, deleted or replaced letter leads from one word to the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def _verified(words: list[bytes], letters: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of words are one edit apart; ``letters`` holds the words up to WIDTH, filled up with zeros."""
    swap = size[a] > size[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    out = np.zeros(len(a), bool)
    gap = size[b] - size[a]
    long = size[b] > WIDTH
    for k in np.flatnonzero(long & (gap <= 1)):
        out[k] = one_edit(words[a[k]], words[b[k]])
    for g in (0, 1):
        of = np.flatnonzero((gap == g) & ~long)
        x, y = letters[a[of]], letters[b[of]]
        wrong = x != y
        if g == 0:
            out[of] = wrong.sum(1) == 1
        else:  # from the first difference on, the longer word must be the shorter one moved by a place
            first = wrong.argmax(1)
            moved = (x[:, :-1] != y[:, 1:]) & (np.arange(x.shape[1] - 1) >= first[:, None])
            out[of] = ~moved.any(1)
    return out


HOME, OTHER, VISITOR = 0, 1, 2


def near_in_block(words: list[bytes], n: np.ndarray, role: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the number of near words met here and the place of the best of them (largest n, then smallest; -1: none).

    The trie holds the words with role HOME. All words seek in it; VISITOR words are also met by what they meet, while two words
    of one part (HOME, or OTHER from another block of it) each seek the other somewhere.
    """
    home = np.flatnonzero(role == HOME)
    size = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.array([w if len(w) <= WIDTH else b"" for w in words], f"S{WIDTH}").view(np.uint8).reshape(len(words), WIDTH)
    letters = np.ascontiguousarray(letters[:, : int(size[size <= WIDTH].max(initial=0)) + 1])
    by_word = np.array(sorted(range(len(words)), key=words.__getitem__))
    at = by_word[np.argsort(-n[by_word], kind="stable")]  # the best first
    place = np.empty(len(words), np.int64)
    place[at] = np.arange(len(words))
    vec = vectors(words)
    home = home[np.lexsort(vec[home].T[::-1])]
    count, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))

    def take(found: list[tuple[np.ndarray, np.ndarray]]) -> None:
        a, b = home[np.concatenate([x for x, _ in found])], np.concatenate([y for _, y in found])
        ok = _verified(words, letters, size, a, b)
        a, b = a[ok], b[ok]
        guest = role[b] == VISITOR
        for x, y in ((b, a), (a[guest], b[guest])):
            count[:] += np.bincount(x, minlength=len(words))
            np.minimum.at(best, x, place[y])

    held, pairs = [], 0
    for a, b in _reached(vec[home], vec) if len(home) else ():
        for k in range(0, len(a), PAIRS):
            held.append((a[k : k + PAIRS], b[k : k + PAIRS]))
            pairs += len(held[-1][0])
            if pairs >= PAIRS:
                take(held)
                held, pairs = [], 0
    if held:
        take(held)
    return count, np.where(best < len(words), at[np.minimum(best, len(words) - 1)], -1)


def _search(block: pd.DataFrame) -> pd.DataFrame:
    word, n = block["word"].to_numpy(), block["n"].to_numpy()
    count, best = near_in_block([w.encode("latin-1") for w in word], n, block["role"].to_numpy())
    has = np.flatnonzero(count)
    return pd.DataFrame({"word": word[has], "n_near": count[has], "best_n": n[best[has]], "best": word[best[has]]})


def near_words(counts: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of every word of ``counts`` (``word, n``; distinct words) that has a near word: their number, and
    the one of largest n (ties: the smallest in code-point order)."""
    total = counts.count()
    depth = 2
    while depth < LEVELS // 2 and total > PART * 4**depth:
        depth += 1
    dealt = counts.select("word", "n").mapInArrow(_dealt(depth), "part long, visits boolean, word string, n long")
    hot = dealt.filter("not visits").groupBy("part").agg(F.count("*").alias("size")).filter(F.col("size") > BLOCK)
    hot = hot.select("part", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))  # at most (number of words / BLOCK) rows
    rows = dealt.join(F.broadcast(hot), "part", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = F.pmod(F.xxhash64("word"), "blocks") == F.col("block")
    rows = rows.withColumn("role", F.when(F.col("visits"), VISITOR).when(own, HOME).otherwise(OTHER))
    found = rows.select("part", "block", "role", "word", "n").groupBy("part", "block").applyInPandas(_search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.best").alias("best"))


def group_variants(counts: DataFrame, ratio: int = 2) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of ``counts`` (``word, n``; distinct words of code points up to U+00FF).

    Two words are near if exactly one inserted, deleted or replaced code point leads from one to the other; ``n_near`` counts them.
    ``form`` is the near word of largest n (ties: smallest in code-point order) if its n is at least ``ratio`` times the word's n,
    else null. ``root`` is where following forms ends, the word itself if it has none.

    Words are arranged in a trie by their counts of successive letter groups; one edit changes the counts by one surplus and one
    deficit at most, which is the budget of the depth-first search; words at the leaves reached are verified. The first levels of
    the trie deal it to tasks: a word goes to its own part and to those later ones that the budget reaches (of the square of the
    number of levels, which grows with the logarithm of the number of words). A part of more than BLOCK words is dealt to blocks,
    each searched by all that seek in the part. Only one row a word and block leaves a task, never the pairs. Roots are found by
    doubling: n grows ``ratio``-fold with each step, so log2 of the logarithm of the largest n rounds do.

    An empty table gives no rows; a word without near words has ``n_near`` 0 and is its own root.
    """
    counts = table(counts.select("word", "n"), "spelling-words")
    near = table(near_words(counts), "spelling-near")
    is_form = F.col("best_n") >= ratio * F.col("n")
    rows = counts.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"))
    rows = table(rows, "spelling-forms")
    steps = rows.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = table(steps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if steps.filter("moved").isEmpty():
            break
        steps = steps.drop("moved")
    return rows.join(steps.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))
