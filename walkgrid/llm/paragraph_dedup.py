"""Substring dedup by paragraphs: MinHash bands tuned for recall, exact Jaccard, removals by connected components.

A paragraph ends at a line end or after a word that ends a sentence; runs of more than ``LONG`` words without either are cut
before words chosen by their hash, so that a passage is cut alike wherever it stands.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walkgrid.llm.common import JOINED, Batches, by_owner, joined, keyed, mix, powers, raw_texts, shingle_sets, slices, table, words_of
from walkgrid.llm.near_dedup import linked_in_clusters

SHINGLE = 5
#: Shorter paragraphs are never removed.
MIN_WORDS = 10
LONG, CUT = 64, 16
#: A pair of likeness 0.75 meets in a band with probability 1 - (1 - 0.75**3)**10 = 0.996, one of 0.85 with 0.9999.
BANDS, ROWS = 10, 3
#: Different paragraphs before it in a band that a paragraph is first compared with. Those of this likeness, in per cent, form
#: clusters, within which all are compared; so are all paragraphs of a band with more of them that no one cluster holds.
NEAR, LOOSE = 3, 50

_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def paragraphs_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end byte (in its text) of each paragraph of ``MIN_WORDS`` or more of some texts; the words' hashes, the paragraphs'
    first and last words as an array of pairs, the number of each one's text, and the number of all paragraphs of each text."""
    h, start, end, text_of, base = words_of(texts)
    if not len(h):
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), none, none, h, np.empty((0, 2), np.int64), none, np.zeros(len(texts), np.int64)
    raw = np.frombuffer(b"\n".join(texts), np.uint8)  # a line end between texts, so no paragraph is of two
    lines = np.concatenate(([0], np.cumsum(raw == 10)))
    last = raw[end[:-1] - 1]
    opens = np.concatenate(([True], (lines[start[1:]] > lines[end[:-1]]) | (last == 46) | (last == 33) | (last == 63)))
    size = np.diff(np.append(np.flatnonzero(opens), len(h)))
    if size.max() > LONG:
        opens |= np.repeat(size > LONG, size) & (h % np.uint64(CUT) == 0)
    first = np.flatnonzero(opens)
    stop = np.append(first[1:], len(h))
    n = np.bincount(text_of[first], minlength=len(texts))
    long_enough = stop - first >= MIN_WORDS
    first, stop = first[long_enough], stop[long_enough]
    up, down = powers(len(h) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up[: len(h)])))
    own = mix((total[stop] - total[first]) * down[first] + (stop - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    of = text_of[first]
    return own, start[first] - base[of], end[stop - 1] - base[of], h, np.stack((first, stop), 1), of, n


def paragraphs(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """``paragraphs_of`` one text, without the number of the text."""
    own, start, stop, h, span, _, n = paragraphs_of([text])
    return own, start, stop, h, span, int(n[0])


def _places(batches: Batches) -> Batches:
    """``k2, k1, h, start, stop`` of every paragraph."""
    for batch in batches:
        found, row = [], 0
        for texts in joined(raw_texts(batch.column("text"))):
            own, start, stop, _, _, of, _ = paragraphs_of(texts)
            found.append((own.view(np.int64), start, stop, of + row))
            row += len(texts)
        if found:
            h, start, stop, of = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column("k2").take(pa.array(of)), batch.column("k1").take(pa.array(of)), pa.array(h), pa.array(start), pa.array(stop)], ["k2", "k1", "h", "start", "stop"])


def _bands(h: np.ndarray, span: np.ndarray) -> np.ndarray:
    """The bands (a row each) of the paragraphs at ``span`` of the words ``h``."""
    shingle = np.zeros(len(h) - SHINGLE + 1, np.uint64)
    for i in range(SHINGLE):
        shingle = shingle * np.uint64(0xD1342543DE82EF95) + h[i : len(h) - SHINGLE + 1 + i]
    n = span[:, 1] - span[:, 0] - SHINGLE + 1
    first = np.cumsum(n) - n
    shingle = mix(shingle[np.arange(n.sum()) + np.repeat(span[:, 0] - first, n)])  # paragraph by paragraph, none between
    bands = np.zeros((BANDS, len(span)), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)[:, None] * np.uint64(0x632BE59BD9B4E019)
    for b in range(BANDS):
        for r in range(ROWS):
            bands[b] = mix(bands[b] + (np.minimum.reduceat(shingle * _SEEDS[b * ROWS + r], first) >> np.uint64(24)))
    return bands


def _banded(batches: Batches) -> Batches:
    """``band, h`` of the paragraphs of a batch, each different one once."""
    for batch in batches:
        found = [f for f in map(paragraphs_of, joined(raw_texts(batch.column("text")))) if len(f[0])]
        if not found:
            continue
        own, at = np.unique(np.concatenate([f[0] for f in found]), return_index=True)
        ends = np.cumsum([0, *(len(f[0]) for f in found)])
        order = np.argsort(at)
        own, at = own[order], at[order]
        cuts = np.searchsorted(at, ends)
        bands = [_bands(f[3], f[4][at[lo:hi] - begin]) for f, begin, lo, hi in zip(found, ends, cuts, cuts[1:], strict=False) if hi > lo]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(bands, 1).reshape(-1).view(np.int64)), pa.array(np.tile(own, BANDS).view(np.int64))], ["band", "h"])


def _colliding(batches: Batches) -> Batches:
    """Of rows sorted by band and hash: pairs ``a, b`` of different paragraphs near each other in a band; for each paragraph ``a`` of
    a band with more than ``NEAR + 1`` also the ``band`` (null in pairs)."""
    kept = [np.empty(0, np.int64)] * 2
    for batch in batches:
        band, h = (np.concatenate((k, batch.column(i).to_numpy())) for i, k in enumerate(kept))
        new = np.concatenate(([True], (band[1:] != band[:-1]) | (h[1:] != h[:-1]))) if len(band) else np.empty(0, bool)
        band, h = band[new], h[new]
        a, b = [], []
        for lag in range(1, NEAR + 1):
            i = np.arange(max(lag, len(kept[0])), len(band))
            i = i[band[i] == band[i - lag]]
            a.append(np.minimum(h[i], h[i - lag]))
            b.append(np.maximum(h[i], h[i - lag]))
        i = np.arange(max(NEAR + 1, len(kept[0])), len(band))
        i = i[band[i] == band[i - NEAR - 1]]
        crowd = np.unique(np.concatenate([i - lag for lag in range(NEAR + 2)]))
        kept = [band[-NEAR - 1 :], h[-NEAR - 1 :]]
        pair = np.unique(np.stack((np.concatenate(a), np.concatenate(b)), 1), axis=0)
        of = np.concatenate((np.zeros(len(pair), np.int64), band[crowd]))
        single = np.arange(len(of)) >= len(pair)
        other = np.concatenate((pair[:, 1], np.zeros(len(crowd), np.int64)))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((pair[:, 0], h[crowd]))), pa.array(other, mask=single), pa.array(of, mask=~single)], ["a", "b", "band"])


def _cut_out(batches: Batches) -> Batches:
    for batch in batches:
        rows = [(p["h"], raw[p["start"] : p["stop"]]) for raw, parts in zip(raw_texts(batch.column("text")), batch.column("parts").to_pylist(), strict=True) for p in parts]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["h", "bytes"])


def _loosely_alike(batches: Batches) -> Batches:
    for whole in batches:
        for batch in slices(whole, "xa", JOINED):
            sets = list(shingle_sets(batch.column("xa").to_pylist() + batch.column("xb").to_pylist(), SHINGLE))
            if not sets:
                continue
            n = np.array([len(s) for s in sets]).reshape(2, -1)
            value, pair = np.concatenate(sets), np.repeat(np.tile(np.arange(batch.num_rows), 2), n.reshape(-1))
            order = by_owner(value, pair)
            value, pair = value[order], pair[order]
            both = (value[1:] == value[:-1]) & (pair[1:] == pair[:-1])  # a set has a value once
            common = np.bincount(pair[1:][both], minlength=batch.num_rows)
            yield batch.select(["a", "b"]).filter(pa.array(100 * common >= LOOSE * (n.sum(0) - common)))


def _remove(batches: Batches) -> Batches:
    """Texts without the paragraphs to go; a kept line end stays where it was."""
    for batch in batches:
        raws, parts = raw_texts(batch.column("text")), batch.column("parts")
        n = np.concatenate([np.empty(0, np.int64), *(paragraphs_of(texts)[6] for texts in joined(raws))])
        start, stop, off = (parts.values.field(c).to_numpy(zero_copy_only=False).tolist() for c in ("start", "stop", "gone"))
        at_part = parts.offsets.to_numpy().tolist()
        repeated, removed, left, digest = [], [], [], []
        for raw, lo, hi in zip(raws, at_part, at_part[1:], strict=False):
            text, at, kept, gone = raw or b"", 0, [], 0
            places = dict(zip(zip(start[lo:hi], stop[lo:hi], strict=True), off[lo:hi], strict=True))
            for (begin, end), away in sorted(places.items()):
                if away:
                    kept.append(text[at:begin])
                    at, gone = end, gone + 1
            own = b"".join([*kept, text[at:]]) if gone else text
            repeated.append(len(places))
            removed.append(gone)
            left.append(None if raw is None else own)
            digest.append(None if raw is None else hashlib.sha256(own).hexdigest())
        counts = [pa.array(c, pa.int64()) for c in (n, repeated, removed)]
        texts = pa.array(left, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, texts, pa.array(digest, pa.string())], ["doc_id", "n_paragraphs", "n_repeated", "n_removed", "kept_text", "kept_sha256"])


def remove_repeated_paragraphs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: ``doc_id, n_paragraphs, n_repeated`` (paragraphs that also stand elsewhere, word for word or
    nearly), ``n_removed, kept_text, kept_sha256``.

    Two paragraphs are linked if they are the same words (A-Z lower-cased), or if their distinct shingles of five words have a
    likeness of 0.75 or more and they meet in a band or are in one candidate cluster: those that meet in a band, near each other, and
    are alike by a half at least are chained, and within a cluster all are compared exactly (``linked_in_clusters``), however many
    they are. The paragraphs of a crowded band that such chains leave apart are one more cluster, so none that meet are missed.
    Linked ones form a group, of which the first place stays (by numeric id, hash of the text, offset) and all others are
    removed. Paragraphs of fewer than ``MIN_WORDS`` words stay.

    Null and empty texts have no paragraphs; a null text stays null. Rows equal in id and text are one document and get the
    same answer. An empty table gives no rows. Equal paragraphs are one node, named by 64 bits, and are counted before the
    shuffle, so a passage in a third of all documents is neither paired with itself nor one task's work.
    """
    rows = keyed(docs, doc_id, text)
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = rows.mapInArrow(_banded, "band long, h long").repartition(width, "band").sortWithinPartitions("band", "h").mapInArrow(_colliding, "a long, b long, band long")
    met = table(pairs.distinct(), "paragraph-pairs")
    pairs, crowded = met.filter("band is null").select("a", "b"), met.filter("band is not null")
    places = table(rows.mapInArrow(_places, "k2 long, k1 long, h long, start long, stop long"), "paragraph-places")
    near = pairs.select(F.col("a").alias("h")).union(pairs.select("b"))
    again = places.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h")
    found = table(places.join(table(again.union(near).distinct(), "paragraph-again"), "h"), "paragraph-found")
    place = F.struct("k2", "k1", "start", "stop")
    kinds = table(found.groupBy("h").agg(F.count("*").alias("c"), F.min(place).alias("first")), "paragraph-kinds")
    parts = kinds.join(near.distinct(), "h", "left_semi").groupBy("first.k2", "first.k1").agg(F.collect_list(F.struct("h", "first.start", "first.stop")).alias("parts"))
    cut = table(rows.join(parts, ["k2", "k1"]).select("text", "parts").mapInArrow(_cut_out, "h long, bytes binary").dropDuplicates(["h"]), "paragraph-cut")
    sides = (cut.select(F.col("h").alias(n), F.col("bytes").alias(f"x{n}")) for n in "ab")
    loose = table(pairs.join(next(sides), "a").join(next(sides), "b").mapInArrow(_loosely_alike, "a long, b long"), "paragraph-loose", pairs.count())
    name = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
    sets = cut.select(name("h").alias("node"), (F.length("bytes") / 6).cast("long").alias("n_shingles"))  # about; it only sizes blocks
    texts_of = lambda nodes: cut.select(name("h").alias("node"), F.col("bytes").alias("text")).join(nodes, "node")
    groups = crowded.select(F.concat(F.lit(b"band"), name("band")).alias("group"), name("a").alias("node"))
    labels = linked_in_clusters(loose.select(name("a").alias("a"), name("b").alias("b")), sets, texts_of, groups)
    number = lambda c: F.conv(F.hex(c), 16, -10).cast("long").alias(c)
    labels = labels.select(number("node"), number("component"))
    cluster = F.coalesce("component", "h").alias("cluster")
    named = kinds.join(labels.withColumnRenamed("node", "h"), "h", "left").select("h", "c", cluster, "first")
    heads = named.groupBy("cluster").agg(F.min("first").alias("head"), F.sum("c").alias("n"))
    named = table(named.join(heads, "cluster").select("h", "head", "n"), "paragraph-heads")
    own = found.join(named, "h").filter("n > 1").withColumn("gone", place != F.col("head"))
    marked = own.groupBy("k2", "k1").agg(F.collect_list(F.struct("start", "stop", "gone")).alias("parts"))
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *T._parse_datatype_string("n_paragraphs long, n_repeated long, n_removed long, kept_text string, kept_sha256 string").fields])
    return rows.join(marked, ["k2", "k1"], "left").select("doc_id", "text", "parts").mapInArrow(_remove, schema)
