"""Exact substring dedup: longest-previous-factor arrays over suffixes that are dealt to buckets by content.

A suffix is told by its first ``LENGTH`` bytes, its window. Each window has an anchor: the ``GRAM`` bytes in it with the smallest
hash (the first of equals), so equal windows have equal grams at equal places. The windows that share an anchor lie side by side
and form a stretch; all stretches of one gram form a bucket, so every repeat of a window is in its bucket. Only grams that occur
again go on, with one copy of each different stretch, and there the suffixes are sorted and matched.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walkgrid.llm.common import Batches, keyed, mix, powers, raw_texts, table

LENGTH, GRAM = 200, 48
#: Windows of a text that are hashed at a time.
PIECE = 1 << 20
#: Different stretches of one gram that one task sorts at most; the windows of larger buckets meet by their own hash instead.
BUCKET = 2048
#: Suffixes sorted at a time, about.
SORTED = 50_000

_BASE = 0x5851F42D4C957F2D
_BYTE = [mix(np.arange(256, dtype=np.uint64) + np.uint64(1000 * salt)) for salt in (1, 2, 3)]


def _rolling(raw: np.ndarray, size: int, salt: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place on, put together from powers of two."""
    value, have, done, got = _BYTE[salt][raw], 1, None, 0
    while True:
        up = np.uint64(pow(_BASE, have, 1 << 64))
        if size & have:
            n = len(raw) - got - have + 1
            done = value if done is None else done[:n] * up + value[got : got + n]
            got += have
        if got == size:
            return mix(done)
        value = value[: len(value) - have] * up + value[have:]
        have *= 2


def stretches(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text: gram hash, hash of the stretch's bytes (and of the gram's place in them), start, and number of windows."""
    out = []
    reach, low = LENGTH - GRAM + 1, np.uint64(2 * PIECE - 1)  # grams of a window
    for at in range(0, max(0, len(text) - LENGTH + 1), PIECE):
        raw = np.frombuffer(text[at : at + PIECE + LENGTH - 1], np.uint8)
        windows = len(raw) - LENGTH + 1
        gram = _rolling(raw, GRAM, 0)
        # Smallest gram of each window, the first of equals: from the rest of one block and the start of the next.
        key = np.full(-(-len(gram) // reach) * reach, ~np.uint64(0))
        key[: len(gram)] = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
        block = key.reshape(-1, reach)
        ahead = np.minimum.accumulate(block, axis=1).reshape(-1)
        back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        place = (np.minimum(back[:windows], ahead[reach - 1 : reach - 1 + windows]) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        count = np.diff(np.concatenate((first, [windows])))
        up, down = powers(len(raw) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[1][raw] * up[: len(raw)])))
        size = count + LENGTH - 1
        own = (total[first + size] - total[first]) * down[first]
        own = mix(own + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + (place[first] - first).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        out.append((gram[place[first]], own, first + at, count))
    if not out:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _stretched(batches: Batches) -> Batches:
    """``k2, k1, gram, own, at`` of every stretch of every text; ``at`` is 256 * start + windows."""
    for batch in batches:
        found = [stretches(t or b"") for t in raw_texts(batch.column("text"))]
        if found:
            of = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            gram, own, start, n = (np.concatenate([f[i] for f in found]) for i in range(4))
            cols = [batch.column("k2").take(of), batch.column("k1").take(of), *(pa.array(x.astype(np.int64, copy=False) if x.dtype != np.uint64 else x.view(np.int64)) for x in (gram, own, start * 256 + n))]
            yield pa.RecordBatch.from_arrays(cols, ["k2", "k1", "gram", "own", "at"])


def previous_factors(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of suffixes in text order, given by their windows: does an earlier one match, does any other match.

    Sorted by window, equal ones by position, this is their suffix order. The longest earlier match of a suffix is with the
    previous or the next smaller position in that order; one as long as the window is with the row before, in a run of equal
    windows. A factor's length is only needed up to the window's, so the array is one of flags.
    """
    text = np.array(windows, f"S{LENGTH}")  # one length: trailing zero bytes do not matter
    order = np.argsort(text, kind="stable")
    equal = text[order][1:] == text[order][:-1]
    earlier, other = np.zeros(len(windows), bool), np.zeros(len(windows), bool)
    earlier[order[1:]] = other[order[1:]] = equal
    other[order[:-1]] |= equal
    return earlier, other


def _runs(flags: np.ndarray) -> list[int]:
    """Starts and ends of the runs of true flags, in turn."""
    return np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).view(np.int8))).tolist()


_MATCHED = "gram long, own long, earlier array<int>, other array<int>"


def _match(batches: Batches) -> Batches:
    """Of stretches sorted by gram and text order: the runs of their windows that match (an earlier; any other)."""

    def done(rows: list[tuple]) -> pa.RecordBatch:
        earlier, other = previous_factors([raw[i : i + LENGTH] for _, _, raw, n in rows for i in range(n)])
        cut = np.cumsum([r[3] for r in rows])[:-1]
        runs = [pa.array([_runs(x) for x in np.split(f, cut)], pa.list_(pa.int32())) for f in (earlier, other)]
        return pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)), *runs], ["gram", "own", "earlier", "other"])

    rows: list[tuple] = []
    waiting: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "own", "bytes", "n")), strict=True):
            if waiting and row[0] != waiting[-1][0]:
                rows, waiting, size = rows + waiting, [], size + sum(r[3] for r in waiting)
                if size > SORTED:
                    yield done(rows)
                    rows, size = [], 0
            if not waiting or row[:2] != waiting[-1][:2]:  # rows that are repeated whole
                waiting.append(row)
    if rows or waiting:
        yield done(rows + waiting)


def _cut_out(batches: Batches) -> Batches:
    """The bytes of the stretches that are asked for (``parts``)."""
    names = ("k2", "k1", "gram", "own", "at", "many")
    for batch in batches:
        texts, parts = raw_texts(batch.column("text")), batch.column("parts").to_pylist()
        k2, k1 = batch.column("k2").to_pylist(), batch.column("k1").to_pylist()
        rows = [(k2[i], k1[i], p["gram"], p["own"], p["at"], p["many"], texts[i][p["at"] // 256 : p["at"] // 256 + p["at"] % 256 + LENGTH - 1], p["at"] % 256) for i, own in enumerate(parts) for p in own]
        cols = list(zip(*rows, strict=True)) or [()] * 8
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.binary(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], [*names, "bytes", "n"])


_CUT = "k2 long, k1 long, gram long, own long, at long, many boolean, bytes binary, n int"


def _windows(batches: Batches) -> Batches:
    """128 bits of hash for each window of a stretch."""
    for batch in batches:
        raw, n = batch.column("bytes").to_pylist(), batch.column("n").to_numpy()
        of = pa.array(np.repeat(np.arange(len(raw)), n))
        h = [np.concatenate([_rolling(np.frombuffer(r, np.uint8), LENGTH, salt) for r in raw]) if raw else np.empty(0, np.uint64) for salt in (1, 2)]
        i = np.concatenate([np.arange(k) for k in n]) if len(n) else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(of) for c in ("k2", "k1", "gram", "own", "at")), pa.array(i.astype(np.int32)), *(pa.array(x.view(np.int64)) for x in h)], ["k2", "k1", "gram", "own", "at", "i", "h1", "h2"])


def _crowded(cut: DataFrame) -> DataFrame:
    """The same as ``_match`` for grams with very many different stretches: windows meet by hash, with counts and first places
    combined before the shuffle, so neither a gram nor a window is one task's work."""
    rows = cut.filter("many").mapInArrow(_windows, "k2 long, k1 long, gram long, own long, at long, i int, h1 long, h2 long").dropDuplicates(["gram", "own", "i"])
    place = F.struct("k2", "k1", (F.shiftright("at", 8) + F.col("i")).alias("p"))
    twice = table(rows.groupBy("h1", "h2").agg(F.count("*").alias("c"), F.min(place).alias("first")).filter("c > 1"), "suffix-crowded")
    found = rows.join(twice, ["h1", "h2"]).withColumn("later", place > F.col("first"))
    run = F.array("i", F.col("i") + 1)
    return found.groupBy("gram", "own").agg(F.flatten(F.collect_list(F.when(F.col("later"), run))).alias("earlier"), F.flatten(F.collect_list(run)).alias("other"))


def _remove(batches: Batches) -> Batches:
    """Texts without the bytes of the matched windows."""
    for batch in batches:
        ids, out = [], []
        for raw, runs in zip(raw_texts(batch.column("text")), batch.column("runs").to_pylist(), strict=True):
            raw = raw or b""
            gone, spans = np.zeros(len(raw) + 1, np.int32), []
            for a, b in runs or ():
                gone[a] += 1
                gone[b + LENGTH - 1] -= 1
            if runs:
                off = np.cumsum(gone[:-1]) > 0
                spans = np.flatnonzero(np.diff(np.concatenate(([False], off, [False])).view(np.int8))).reshape(-1, 2).tolist()
                kept = np.frombuffer(raw, np.uint8)[~off].tobytes()
            else:
                kept = raw
            out.append((len(raw), len(raw) - len(kept), [{"start": a, "end": b} for a, b in spans], kept))
            ids.append(hashlib.sha256(kept).hexdigest())
        cols = list(zip(*out, strict=True)) or [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True)), pa.array(ids, pa.string())], ["doc_id", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_first: bool = True) -> DataFrame:
    """A row per row of ``docs``: ``doc_id, n_bytes, n_removed, spans, kept`` (bytes) and ``kept_sha256``.

    Removed is every byte covered by a string of ``LENGTH`` bytes that also starts at an earlier place (``keep_first``), or
    anywhere else. Places are ordered by numeric id, then hash of the text, then offset; strings never cross documents, overlaps
    count, and all is judged on the input. Kept bytes may not be valid UTF-8 where a removal cuts a letter, hence bytes.

    Null text counts as empty; texts shorter than ``LENGTH`` lose nothing. Rows equal in id and text get the same answer: with
    ``keep_first`` they count as one place that stands first, else they are copies of each other. Ids may be null or text.
    An empty table gives no rows. Very long texts are hashed piece by piece.

    Shuffled are 24 to 48 bytes for each stretch (one for about 77 bytes of text), then only stretches whose gram occurs again,
    and each text once. Joins on a gram or stretch have one row per key on one side, so the hot side can be split.
    """
    rows = keyed(docs, doc_id, text)
    every = rows.mapInArrow(_stretched, "k2 long, k1 long, gram long, own long, at long")
    again = table(every.groupBy("gram").agg(F.count("*").alias("c")).filter("c > 1").select("gram"), "suffix-grams")
    found = table(every.join(again, "gram"), "suffix-found")
    place = F.struct("k2", "k1", "at")
    kinds = table(found.groupBy("gram", "own").agg(F.count("*").alias("c"), F.min(place).alias("first")), "suffix-kinds")
    mixed = kinds.groupBy("gram").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("gram", (F.col("kinds") > BUCKET).alias("many"))
    parts = kinds.join(mixed, "gram").groupBy(F.col("first.k2").alias("k2"), F.col("first.k1").alias("k1")).agg(F.collect_list(F.struct("gram", "own", "first.at", "many")).alias("parts"))
    cut = rows.join(parts, ["k2", "k1"]).select("k2", "k1", "text", "parts").mapInArrow(_cut_out, _CUT)
    cut = table(cut, "suffix-cut")
    few = cut.filter("not many").select("gram", "own", "bytes", "n", "k2", "k1", "at").repartition("gram").sortWithinPartitions("gram", "k2", "k1", "at").mapInArrow(_match, _MATCHED)
    matched = table(few.unionByName(_crowded(cut)), "suffix-matched")
    none = F.array().cast("array<int>")
    whole = F.array(F.lit(0), F.pmod("at", F.lit(256)).cast("int"))
    is_first = place == F.col("first")
    if keep_first:
        runs = F.when(is_first, F.coalesce("earlier", none)).otherwise(whole)
    else:
        runs = F.when(F.col("c") > 1, whole).otherwise(F.coalesce("other", none))
    # One row per stretch, so that the join with the many copies of a stretch is a single one, which can be split.
    told = table(kinds.join(matched, ["gram", "own"], "left"), "suffix-told")
    spans = found.join(told, ["gram", "own"]).select("k2", "k1", F.shiftright("at", 8).alias("start"), runs.alias("runs"))
    pairs = F.transform(F.sequence(F.lit(0), F.size("runs") - 2, F.lit(2)), lambda i: F.array(F.col("start") + F.get("runs", i), F.col("start") + F.get("runs", i + 1)))
    spans = spans.filter(F.size("runs") > 0).select("k2", "k1", F.explode(pairs).alias("run")).groupBy("k2", "k1").agg(F.collect_list("run").alias("runs"))
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *T._parse_datatype_string("n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary, kept_sha256 string").fields])
    return rows.join(spans, ["k2", "k1"], "left").select("doc_id", "text", "runs").mapInArrow(_remove, schema)
