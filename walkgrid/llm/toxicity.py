"""Toxicity: a weighted lexicon learned from labels, matched by one automaton over folded text, with exception phrases."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walkgrid.llm.common import Batches, mix, shingle_hashes, table, with_columns_in_arrow, word_hashes

#: Labelled rows that a model is learned from at most, of each label: those whose hashed id is smallest.
SAMPLE = 8_000
#: Letters of a stem, from and to. A pattern is a whole word or a stem, which any word may begin with.
STEM = (3, 7)
#: A pattern stands in this many different toxic texts at least, and its log odds are this high.
LEAST, ODDS = 5, 2.5
#: A pattern is passed over for a longer one that stands in this share of its toxic texts: the longest common form is kept.
CLOSED = 0.95
#: Hash functions by which near copies in the sample are told.
SKETCHES = 8
#: Patterns and exceptions of a lexicon at most (the weightiest); so much is broadcast.
PATTERNS = 20_000
#: Characters folded at a time.
PIECE = 1 << 20

# Letters of other scripts that look like Latin ones, and signs that stand for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q",
    "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "α": "a", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ℓ": "l", "ſ": "s",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l", "€": "e"}

_WIDE = {0xFF01 + k: 0x21 + k for k in range(94)}  # full-width forms of ASCII
_GONE = dict.fromkeys([0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF, *range(0x300, 0x370)])  # joiners, marks
_LETTERS = _WIDE | _GONE | {ord(k): v for k, v in LOOKALIKES.items()}
_ODD = re.compile("[" + "".join(map(re.escape, LOOKALIKES)) + "­̀-ͯ​-‏⁠﻿！-～]")
_SIGNED = re.compile(r"(?:(?<=[^\W\d_])|(?<![\w@$!|€]))[013457-9@$!|€]+(?=[^\W\d_])")
_SIGN = str.maketrans(SIGNS)
_WORD, _BLANK = re.compile(r"[^\W\d_]+"), re.compile(r"\s")


def fold(text: str) -> list[str]:
    """Words of a text: lower-cased, look-alikes of other scripts made Latin, marks and joiners dropped, signs and digits before a
    letter made letters (within a word or at its start); then the maximal runs of letters."""
    text = text.lower()
    if _ODD.search(text):
        text = text.translate(_LETTERS).lower()
    return _WORD.findall(_SIGNED.sub(lambda m: m[0].translate(_SIGN), text))


def pieces(text: str | None) -> Iterator[str]:
    """A text in pieces that end at white space, if it is long."""
    at = 0
    while at < len(text or ""):
        found = _BLANK.search(text, at + PIECE) if len(text) - at > PIECE else None
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def patterns_of(words: Iterable[str]) -> set[str]:
    """Whole words (between blanks) and stems (after a blank) of some words."""
    out = set()
    for w in set(words):
        if len(w) >= STEM[0]:
            out.add(f" {w} ")
            out.update(f" {w[:k]}" for k in range(STEM[0], min(STEM[1], len(w)) + 1))
    return out


@dataclass
class Lexicon:
    """Weights of patterns, phrases within which no pattern counts, and the logistic curve of a text's two features."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (-4.0, 2.0, 1.0)

    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for phrase in self.exceptions:
            made.add_word(phrase, (len(phrase), None))
        for pattern, weight in self.weights.items():
            if pattern not in made:
                made.add_word(pattern, (len(pattern), weight))
        made.make_automaton()
        return made


def hits(automaton: ahocorasick.Automaton, line: str) -> list[tuple[int, float]]:
    """Start and weight of the words of a folded line (single blanks between and around words) that the lexicon matches and no
    exception covers: of the patterns that begin a word the weightiest counts."""
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for last, (size, weight) in automaton.iter(line):
        start = last + 1 - size
        if weight is None:
            spared.append((start, last))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    return [(at, w) for at, w in sorted(best.items()) if not any(a <= at < b for a, b in spared)] if spared else sorted(best.items())


def features(automaton: ahocorasick.Automaton, text: str | None) -> tuple[float, int, int]:
    """Sum of weights, number of matched words, number of words."""
    total, n, words = 0.0, 0, 0
    for piece in pieces(text):
        folded = fold(piece)
        found = hits(automaton, f" {' '.join(folded)} ")
        total += sum(w for _, w in found)
        n += len(found)
        words += len(folded)
    return total, n, words


def _inputs(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The curve's inputs: weight in all, and weight by length, both damped."""
    return np.stack((np.ones(len(total)), np.log1p(total), np.log1p(100 * total / np.maximum(words, 25))), 1)


def _curve(total: np.ndarray, words: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton's method, both labels weighing the same, with a small ridge; slopes are not negative."""
    x, w = _inputs(total, words), np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum()))
    b = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (w * (toxic - p)) - 1e-3 * b
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(3), grad)
        b += step
        if abs(step).max() < 1e-9:
            break
    return float(b[0]), max(0.0, float(b[1])), max(0.0, float(b[2]))


def closed_patterns(found: list[tuple[str, float, int]]) -> dict[str, float]:
    """Weights of the patterns to keep of ``(pattern, odds, toxic texts)``: those that no longer pattern replaces (CLOSED) and no
    shorter kept stem of nine tenths of their odds covers."""
    longest: dict[str, int] = {}  # of each beginning, the toxic texts of the most frequent longer pattern
    for pattern, _, n in found:
        for k in range(STEM[0] + 1, len(pattern)):
            longest[pattern[:k]] = max(longest.get(pattern[:k], 0), n)
    out: dict[str, float] = {}
    for pattern, odds, n in sorted(found, key=lambda r: (len(r[0]), r[0])):
        covered = any(out.get(pattern[:k], -1.0) >= 0.9 * odds for k in range(STEM[0] + 1, len(pattern)))
        if not covered and longest.get(pattern, 0) < CLOSED * n:
            out[pattern] = float(odds)
    return out


def _emit(counts: Counter, schema: tuple[str, ...]) -> pa.RecordBatch:
    keys, values = list(counts), np.array(list(counts.values()), np.int64).reshape(-1)
    toxic = np.array([k[1] for k in keys])
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array(np.where(toxic, values, 0)), pa.array(np.where(toxic, 0, values))], list(schema))


def _tally(rows: DataFrame, of: Callable[[str | None], Iterable[str]]) -> DataFrame:
    """``pattern, toxic, clean``: texts of each label that hold a pattern. ``rows`` is ``text, toxic``. Summed in tasks first."""

    def count(batches: Batches) -> Batches:
        held: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.update((p, toxic) for p in of(text))
                if len(held) > 300_000:
                    yield _emit(held, ("pattern", "toxic", "clean"))
                    held = Counter()
        if held:
            yield _emit(held, ("pattern", "toxic", "clean"))

    parts = rows.mapInArrow(count, "pattern string, toxic long, clean long")
    return parts.groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _log_odds(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    return F.log((toxic + 0.5) / (n_toxic + 1.0)) - F.log((clean + 0.5) / (n_clean + 1.0))


def _sketches(docs: DataFrame) -> DataFrame:
    """``docs`` with ``sketches``: the smallest values of the text's five-word shingles under SKETCHES hash functions."""
    seeds = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64)) | np.uint64(1)

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        out = []
        for text in batch.column("text"):
            found = shingle_hashes(word_hashes((text.as_py() or "").encode()))
            out.append([int((found * seed).min().view(np.int64)) for seed in seeds] if len(found) else [])
        return {"sketches": pa.array(out, pa.list_(pa.int64()))}

    return with_columns_in_arrow(docs, make, [T.StructField("sketches", T.ArrayType(T.LongType()))], sized_by="text")


def _one_of_each(rows: list[tuple]) -> list:
    """Of rows ``(id, toxic, sketches)`` one id, the first, of each label and each set of rows that are chained by shared sketches."""
    up = list(range(len(rows)))

    def top(k: int) -> int:
        while up[k] != k:
            up[k] = up[up[k]]
            k = up[k]
        return k

    holder: dict = {}
    for k, (_, _, sketches) in enumerate(rows):
        for s in enumerate(sketches):
            a, b = sorted((top(holder.setdefault(s, k)), top(k)))
            up[b] = a
    kept: dict = {}
    for k, (own, toxic, _) in enumerate(rows):
        kept.setdefault((top(k), toxic), own)
    return list(kept.values())


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> DataFrame:
    """``text, toxic`` of at most SAMPLE labelled documents of each label, those with the smallest hashed ids; of near copies, told by
    a shared sketch, one stays, so that a group of copies counts once. A document with labels of both kinds counts as toxic.
    What the driver sees of a document is its id and its sketches; both tables are bounded by SAMPLE."""
    marks = labels.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg((F.max(label) > 0).alias("toxic")).filter("toxic is not null")
    order = [F.xxhash64(F.col("id").cast("string"), F.lit(17)), F.col("id")]
    chosen = table(marks.filter("toxic").orderBy(*order).limit(SAMPLE).unionByName(marks.filter("not toxic").orderBy(*order).limit(SAMPLE)), "toxic-sample")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")  # 2 * SAMPLE rows
    rows = table(_sketches(rows), "toxic-rows")
    kept = _one_of_each(sorted(map(tuple, rows.select("id", "toxic", "sketches").collect()), key=lambda r: str(r[0])))
    ids = docs.sparkSession.createDataFrame([(k,) for k in kept], T.StructType([T.StructField("id", rows.schema["id"].dataType)]))
    return table(rows.join(F.broadcast(ids), "id").dropDuplicates(["id"]).select("text", "toxic"), "toxic-texts")


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", exceptions: Iterable[str] = ()) -> Lexicon | None:
    """A lexicon from labelled documents; None if one of the labels is missing.

    A pattern's weight is its smoothed log odds: the share of toxic texts that hold it against that of clean ones, in the sample
    (``sample``). Patterns below ODDS, or in fewer than LEAST toxic texts, are left out, and so are those that others make
    needless (``closed_patterns``). Phrases of a matched word and a neighbour, and whole matched words, that clean texts
    hold at least as often as toxic ones, in LEAST texts, become exceptions, beside those given (folded here). The curve is fitted
    to the same sample. What reaches the driver is bounded by PATTERNS and SAMPLE, not by the table.
    """
    rows = sample(docs, labels, doc_id, text, label)
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return None
    n_toxic, n_clean = size[True], size[False]

    def all_patterns(value: str | None) -> set[str]:
        return patterns_of(w for piece in pieces(value) for w in fold(piece))

    odds = _log_odds(F.col("toxic"), F.col("clean"), n_toxic, n_clean)
    found = _tally(rows, all_patterns).filter(F.col("toxic") >= LEAST).withColumn("odds", odds).filter(F.col("odds") >= ODDS)
    top = found.orderBy(F.desc("odds"), F.desc("toxic"), "pattern").limit(PATTERNS).select("pattern", "odds", "toxic").collect()
    weights = closed_patterns([tuple(r) for r in top])
    made = Lexicon(weights, sorted({f" {' '.join(fold(e))} " for e in exceptions} - {"  "}))

    def around(value: str | None) -> set[str]:
        """Matched words, and each with the word before and after it."""
        out, automaton = set(), _automaton(made)
        for piece in pieces(value):
            words = fold(piece)
            line = f" {' '.join(words)} "
            starts = {}
            at = 0
            for k, w in enumerate(words):
                starts[at] = k
                at += len(w) + 1
            for at, _ in hits(automaton, line):
                k = starts[at]
                out.update(f" {' '.join(words[a:b])} " for a, b in ((k, k + 1), (k - 1, k + 1), (k, k + 2)) if 0 <= a and b <= len(words))
        return out

    spare = _tally(rows, around).filter(F.col("clean") >= LEAST).filter(_log_odds(F.col("toxic"), F.col("clean"), n_toxic, n_clean) <= 0)
    learned = [r[0] for r in spare.orderBy(F.desc("clean"), "pattern").limit(PATTERNS).collect()]
    made = Lexicon(weights, sorted({*made.exceptions, *learned}))
    seen = _features(rows, made).select("total", "words", "toxic").collect()
    total, words, toxic = (np.array([r[k] for r in seen]) for k in range(3))
    return Lexicon(made.weights, made.exceptions, _curve(total, words, toxic.astype(bool)))


_BUILT: list = [None, None]  # the lexicon in use in this worker, and its automaton


def _automaton(lexicon: Lexicon) -> ahocorasick.Automaton:
    if _BUILT[0] is not lexicon:
        _BUILT[:] = [lexicon, lexicon.automaton()]
    return _BUILT[1]


def _features(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        automaton = _automaton(shared.value)
        found = [features(automaton, t.as_py()) for t in batch.column(text)]
        total, n, words = zip(*found, strict=True)
        return {"total": pa.array(total, pa.float64()), "n_matched": pa.array(n, pa.int64()), "words": pa.array(words, pa.int64())}

    return with_columns_in_arrow(docs, make, [T.StructField("total", T.DoubleType()), T.StructField("n_matched", T.LongType()), T.StructField("words", T.LongType())], sized_by=text)


def score(docs: DataFrame, lexicon: Lexicon | None, text: str = "text") -> DataFrame:
    """``docs`` with ``n_matched`` (words that the lexicon matches and no exception covers) and ``score`` (0 to 1, higher: more toxic).

    Each text is folded and scanned once by one automaton of patterns and exceptions, where it lies: no shuffle. The score is a
    logistic curve of the matched words' weight and of that weight by number of words (25 at least). Null and empty texts match
    nothing and get the curve's lowest value; without a lexicon all scores are 0. Ties of weight at a word count once. Repeated
    rows each keep their row; long texts are folded in pieces; columns of ``docs`` named ``n_matched`` or ``score`` are replaced,
    all others stay. An empty table gives no rows.
    """
    rest = [c for c in docs.columns if c not in ("n_matched", "score")]
    if lexicon is None:
        return docs.select(*rest, F.lit(0).cast("long").alias("n_matched"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        automaton = _automaton(shared.value)
        total, n, words = (np.array(x) for x in zip(*(features(automaton, t.as_py()) for t in batch.column(text)), strict=True))
        curve = _inputs(total, words) @ np.array(shared.value.curve)
        return {"n_matched": pa.array(n, pa.int64()), "score": pa.array(1 / (1 + np.exp(-np.clip(curve, -30, 30))))}

    return with_columns_in_arrow(docs.select(*rest), make, [T.StructField("n_matched", T.LongType()), T.StructField("score", T.DoubleType())], sized_by=text)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learned from: crc32 of the id as text is a multiple of 5. False for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
