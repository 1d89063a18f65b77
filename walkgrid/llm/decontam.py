"""Benchmark decontamination: one automaton over normalised benchmark windows, texts scanned once."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walkgrid.llm.common import raw_texts, table, with_columns_in_arrow

#: Windows (and distinct words) of one automaton at most. What is broadcast is bounded by it; more windows make more automata.
BLOCK_WINDOWS = 300_000
#: Words are [0-9a-z] and everything outside ASCII, once A-Z are lower-cased; all else separates.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class _Block:
    """Windows as strings over an alphabet of words: one code point for each distinct word."""

    def __init__(self) -> None:
        self.alphabet: dict[bytes, str] = {}
        self.items: dict[str, set[str]] = {}

    def add(self, words: list[bytes], item: str | None) -> None:
        letters = []
        for w in words:
            if w not in self.alphabet:
                code = len(self.alphabet) + 1
                self.alphabet[w] = chr(code + 2048 if code >= 0xD800 else code)  # no surrogates
            letters.append(self.alphabet[w])
        found = self.items.setdefault("".join(letters), set())
        if item is not None:
            found.add(item)

    def full(self) -> bool:
        return len(self.items) >= BLOCK_WINDOWS or len(self.alphabet) >= BLOCK_WINDOWS


def _blocks(benchmark: DataFrame, item_id: str, text: str, window: int) -> Iterator[_Block]:
    """The driver holds one block at a time."""
    block = _Block()
    for item, raw in benchmark.select(F.col(item_id).cast("string"), F.col(text).cast("binary")).toLocalIterator():
        words = words_of(bytes(raw)) if raw is not None else []
        for i in range(max(1, len(words) - window + 1) if words else 0):
            block.add(words[i : i + window], item)
            if block.full():
                yield block
                block = _Block()
    yield block


_BUILT: dict[int, ahocorasick.Automaton] = {}  # of the block in use, once for each worker


def _automaton(key: int, block: _Block) -> ahocorasick.Automaton:
    if key not in _BUILT:
        _BUILT.clear()
        made = ahocorasick.Automaton()
        for letters, items in block.items.items():
            made.add_word(letters, (len(letters), items))
        made.make_automaton()
        _BUILT[key] = made
    return _BUILT[key]


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _offsets(text: bytes, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Code point offsets in the original text of runs of words."""
    raw = np.frombuffer(text, np.uint8)
    word = np.frombuffer(text.translate(_FOLD), np.uint8) != 32
    edge = np.diff(np.concatenate(([False], word, [False])).view(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    point = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))  # code points before each byte
    return [{"start": int(point[start[a]]), "end": int(point[end[b - 1]])} for a, b in runs]


_PAIR = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("word_runs", _PAIR),
    T.StructField("spans", _PAIR),
]
_ARROW_PAIR = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def find_benchmark_text(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10) -> DataFrame:
    """``docs`` with the benchmark passages they hold: ``n_words``, ``n_hit`` (words inside an occurrence), ``item_ids``
    (sorted strings), ``word_runs`` (maximal runs of hit words) and ``spans`` (the same as code points of the original text).

    A window is ``window`` consecutive words of an item, or the whole item if it has fewer, but not none. All windows go into
    one automaton, whose letters are words, and each text is scanned once. Only beyond ``BLOCK_WINDOWS`` windows there are
    several automata, one pass each. No shuffle; the benchmark passes through the driver block by block.

    A null or empty text has no words and no hits. A null item counts for the hits, but has no id to report; repeated items
    count once. Repeated documents each keep their row. Columns of ``docs`` named as an output are replaced. Empty tables
    give no hits or no rows.
    """
    sc = docs.sparkSession.sparkContext
    out = docs
    for k, block in enumerate(_blocks(benchmark, item_id, item_text, window)):
        if k:
            out = table(out, "decontam")  # else the automata of all passes would sit in memory together
        out = _pass(out, sc.broadcast(block), k, text)
    return out


def _pass(docs: DataFrame, shared, k: int, text: str) -> DataFrame:
    key = shared.id if hasattr(shared, "id") else id(shared)

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        block = shared.value
        automaton, letter = _automaton((key, k), block), block.alphabet.get
        n_words, n_hit, ids, runs, spans = [], [], [], [], []
        before = zip(batch.column("word_runs").to_pylist(), batch.column("item_ids").to_pylist(), strict=True) if k else repeat(((), ()))
        for raw, (old_runs, old_ids) in zip(raw_texts(batch.column(text)), before):
            words = words_of(raw or b"")
            found, items = [(r["start"], r["end"]) for r in old_runs], set(old_ids)
            if words and block.items:
                for last, (size, of) in automaton.iter("".join(map(letter, words, repeat("\0")))):
                    found.append((last + 1 - size, last + 1))
                    items |= of
            found = _merged(found)
            n_words.append(len(words))
            n_hit.append(sum(b - a for a, b in found))
            ids.append(sorted(items))
            runs.append([{"start": a, "end": b} for a, b in found])
            spans.append(_offsets(raw, found) if found else [])
        return {
            "n_words": pa.array(n_words, pa.int64()),
            "n_hit": pa.array(n_hit, pa.int64()),
            "item_ids": pa.array(ids, pa.list_(pa.string())),
            "word_runs": pa.array(runs, _ARROW_PAIR),
            "spans": pa.array(spans, _ARROW_PAIR),
        }

    return with_columns_in_arrow(docs, make, _FIELDS)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a benchmark window; columns and all other rows stay as they are."""
    kept = docs.withColumn("_row", F.struct(*docs.columns))
    return find_benchmark_text(kept.select("_row", F.col("_row.text").alias("text")), benchmark).filter("n_hit = 0").select("_row.*")
