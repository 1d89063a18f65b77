"""Near-duplicate documents: an LSH forest over MinHash signatures, links confirmed on the full shingle sets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walkgrid.llm.common import Batches, fresh, mix, raw_texts, shingle_sets, table, text_shingles, with_columns_in_arrow
from walkgrid.llm.graph import components

SHINGLE, PERCENT = 5, 75
#: Trees of the forest; values that the rows of a region share at least; values that order a tree. A pair of likeness 0.75
#: shares no region in any tree once in (1 - 0.75**3)**-24, a half million.
TREES, ROOT, DEPTH = 24, 3, 5
#: Rows before it in the sorted order that a row is first compared with.
NEAR = 4
#: Values of a signature; the first ``TREES * DEPTH`` order the trees. Candidates whose signatures agree in less of their values make
#: no cluster: at likeness 0.75 that is 5 deviations off. Sets that are less alike than about a half, which one common passage
#: makes of any number of documents, are 4 deviations below and form no chains.
VALUES, SKETCH = 256, 0.615
#: Shingles in the sets of a cluster that one task compares, about; so many shingles of the same sets are in all blocks of a larger
#: cluster.
BLOCK, PIVOTS = 1 << 19, 1 << 16
#: Bytes of text that are signed before they are handed on.
SLICE_BYTES = 2 << 20

_SEEDS = mix(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """``VALUES`` MinHash values of a set that is not empty, 32 bits each: a running minimum over pieces of the set."""
    out = np.full(len(_SEEDS), ~np.uint64(0))
    for at in range(0, len(shingles), 256):
        np.minimum(out, (shingles[None, at : at + 256] * _SEEDS[:, None]).min(1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that name a set of shingles."""
    a = mix(shingles + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)
    b = mix(shingles * np.uint64(0xD6E8FEB86659FD93) + np.uint64(len(shingles))).sum(dtype=np.uint64)
    return int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big")


def signed(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``n_shingles``, the key of the set, and its signature (null for an empty set)."""

    def make(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        size, node, sig = [], [], []
        for t in batch.column(text).cast(pa.binary()):  # one set at a time
            shingles = text_shingles(t.as_py() or b"", SHINGLE)
            size.append(len(shingles))
            node.append(set_key(shingles) if len(shingles) else None)
            sig.append(signature(shingles).astype("<u4").tobytes() if len(shingles) else None)
        return {"n_shingles": pa.array(size, pa.int64()), "node": pa.array(node, pa.binary()), "sig": pa.array(sig, pa.binary())}

    fields = [T.StructField("n_shingles", T.LongType()), T.StructField("node", T.BinaryType()), T.StructField("sig", T.BinaryType())]
    return with_columns_in_arrow(docs, make, fields, sized_by=text, slice_bytes=SLICE_BYTES)


def _orders(batches: Batches) -> Batches:
    """A row for each set and tree: ``region`` (the tree and its first ``ROOT`` values), ``deep`` (its next values), the set."""
    for batch in batches:
        if batch.num_rows:
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(-1, VALUES)[:, : TREES * DEPTH].astype(np.uint64).reshape(-1, TREES, DEPTH)
            region = np.zeros(sig.shape[:2], np.uint64) + np.arange(1, TREES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
            for i in range(ROOT):
                region = mix(region + sig[:, :, i])
            deep = (sig[:, :, ROOT] << np.uint64(31)) | (sig[:, :, ROOT + 1] >> np.uint64(1))
            of = pa.array(np.repeat(np.arange(len(sig)), TREES))
            yield pa.RecordBatch.from_arrays([pa.array(region.reshape(-1).view(np.int64)), pa.array(deep.reshape(-1).view(np.int64)), batch.column(0).take(of)], ["region", "deep", "node"])


def _neighbours(batches: Batches) -> Batches:
    """Of rows in sorted order: ``region, node, other`` for each row and the ``NEAR`` rows before it in its region, which share
    the longest prefixes with it. The first row of a region has a null ``other``."""
    region, last = None, []
    for batch in batches:
        out: tuple[list, list, list] = ([], [], [])
        for r, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if r != region:
                region, last = r, []
            for other in last or [None]:
                for o, v in zip(out, (r, n, other), strict=True):
                    o.append(v)
            last = [*last[1 - NEAR :], n]
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], ["region", "node", "other"])


def _alike(batches: Batches) -> Batches:
    """Candidate pairs whose signatures agree in enough values."""
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(batch.num_rows, -1) for c in ("sa", "sb"))
            yield batch.select(["a", "b"]).filter(pa.array((a == b).mean(1) >= SKETCH))


def block_links(sets: list[np.ndarray], label: list, seeks: list[bool]) -> list[tuple[int, int]]:
    """Links among the sets of a block that join different labels, as few as join them all: positions of two sets each.

    An inverted index of the sets gives the exact intersection of one set with all others at a time. Only sets that seek are
    compared with all others.
    """
    size = np.array([len(s) for s in sets])
    value, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), size)
    order = np.argsort(value, kind="stable")
    holder = doc[order]
    new = np.concatenate(([True], value[order][1:] != value[order][:-1]))
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(value)))
    term = np.empty(len(value), np.int64)
    term[order] = np.cumsum(new) - 1
    at = np.concatenate(([0], np.cumsum(size)))
    up = np.unique(label, return_inverse=True)[1].reshape(-1)  # label of the group that each text is in by now
    links: list[tuple[int, int]] = []
    for i in np.flatnonzero(seeks):
        if (up == up[0]).all():
            break
        own = term[at[i] : at[i + 1]]
        own = own[count[own] > 1]
        n = count[own]
        where = np.repeat(first[own] - np.cumsum(n) + n, n) + np.arange(n.sum())
        common = np.bincount(holder[where], minlength=len(sets))
        for j in np.flatnonzero((100 * common >= PERCENT * (size[i] + size - common)) & (up != up[i])):
            if up[j] != up[i]:
                links.append((int(i), int(j)))
                up[up == up[j]] = up[i]
    return links


def _blocks(batches: Batches) -> Batches:
    """Links of each block of rows that are sorted by cluster and block."""

    def done(rows: list[tuple]) -> pa.RecordBatch:
        found = block_links([r[3] for r in rows], [r[2] for r in rows], [r[4] for r in rows])
        nodes = [r[1] for r in rows]
        return pa.RecordBatch.from_arrays([pa.array([nodes[i] for i, _ in found], pa.binary()), pa.array([nodes[j] for _, j in found], pa.binary())], ["a", "b"])

    key, rows = None, []
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("cluster", "x", "y", "node", "label", "seeks")]
        for c, x, y, node, label, seeks, shingles in zip(*cols, shingle_sets(raw_texts(batch.column("text")), SHINGLE), strict=True):  # texts go, sets stay
            if (c, x, y) != key:
                if len(rows) > 1:
                    yield done(rows)
                key, rows = (c, x, y), []
            rows.append(((c, x, y), node, label.hex(), shingles, seeks))
    if len(rows) > 1:
        yield done(rows)


def _linked(blocks: DataFrame, texts: DataFrame) -> DataFrame:
    rows = blocks.join(texts, "node").select("cluster", "x", "y", "node", "label", "seeks", "text")
    return rows.repartition("cluster", "x", "y").sortWithinPartitions("cluster", "x", "y").mapInArrow(_blocks, "a binary, b binary")


def _labelled(nodes: DataFrame, node: str, labels: DataFrame, out: str) -> DataFrame:
    """``nodes`` with the component of one of its columns; a node without links is its own."""
    own = labels.select(F.col("node").alias(node), F.col("component").alias(out))
    return nodes.join(own, node, "left").withColumn(out, F.coalesce(out, node))


def candidates(sets: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of nodes of ``sets`` (``node, sig``) that are near each other in a region of a sorted order of the forest, and
    whose signatures agree enough."""
    width = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    orders = sets.mapInArrow(_orders, "region long, deep long, node binary")
    sort = ["region", "deep", "node"]
    met = orders.repartitionByRange(width, *sort).sortWithinPartitions(*sort).mapInArrow(_neighbours, "region long, node binary, other binary").filter("other is not null")
    met = table(met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), "near-met")
    sa, sb = (sets.select(F.col("node").alias(n), F.col("sig").alias(f"s{n}")) for n in "ab")
    agreeing = met.join(sa, "a").join(sb, "b").select("a", "b", "sa", "sb").mapInArrow(_alike, "a binary, b binary")
    return table(agreeing, "near-alike", met.count())


def links(sets: DataFrame, texts_of) -> DataFrame:
    """Component of every set that is linked with another: ``node, component``.

    ``sets`` has one row ``node, sig, n_shingles`` for each distinct set. ``texts_of(nodes)`` gives ``node, text`` for a table of nodes.
    """
    return linked_in_clusters(candidates(sets.select("node", "sig")), sets.select("node", "n_shingles"), texts_of)


def _across(groups: DataFrame, clusters: DataFrame) -> DataFrame:
    """``cluster, node, seeks`` of the groups that no one cluster holds, of equal groups one. The sets of a group's most frequent cluster
    are compared with each other there, so that only the others seek."""
    own = _labelled(groups, "node", clusters, "own")
    h = [F.bit_xor(F.xxhash64("node", F.lit(i))) for i in range(2)]
    split = own.groupBy("group").agg(F.count("*").alias("n"), h[0].alias("h0"), h[1].alias("h1"), F.min("own").alias("low"), F.max("own").alias("high"))
    once = split.filter("low != high").groupBy("n", "h0", "h1").agg(F.min("group").alias("group")).select("group")
    rows = own.join(once, "group")
    most = rows.groupBy("group", "own").agg(F.count("*").alias("c")).groupBy("group").agg(F.max(F.struct("c", "own")).alias("top"))
    return rows.join(most, "group").select(F.col("group").alias("cluster"), "node", (F.col("own") != F.col("top.own")).alias("seeks"))


def linked_in_clusters(alike: DataFrame, sets: DataFrame, texts_of, groups: DataFrame | None = None) -> DataFrame:
    """``node, component`` of every set that is linked with another of its cluster.

    Clusters are the components of the candidate pairs ``alike`` (``a, b``) and, if not within one of them, the ``groups`` (``group,
    node``; names unlike those of nodes), which may overlap; ``sets`` has ``node, n_shingles`` for each distinct set.
    Within a cluster all links are found on the full sets: in one task up to ``BLOCK`` shingles; larger clusters in two passes. The
    first deals their sets to blocks and adds the same sets of ``PIVOTS`` shingles to each, which joins what is widely linked. The
    second compares what is still outside the cluster's largest component with the whole cluster, block by block: its work grows with
    what is outside times the cluster. No pair is left out, and of the links only a spanning forest is written.
    """
    known = sets.count()
    clusters = table(components(alike, "near-clusters"), "near-clusters", known)
    nodes, more = clusters.select("node"), None
    if groups is not None:
        more = table(_across(groups, clusters), "near-across")
        more = None if more.isEmpty() else more
    clusters = clusters.select(F.col("component").alias("cluster"), "node", F.lit(True).alias("seeks"))
    if more is not None:
        clusters, nodes = clusters.unionByName(more), nodes.union(more.select("node")).distinct()
        known += more.count()
    texts = table(texts_of(nodes), "near-texts")
    members = table(clusters.join(sets.select("node", "n_shingles"), "node"), "near-members", known)
    sizes = members.groupBy("cluster").agg(F.sum("n_shingles").alias("n"))
    rows = members.join(sizes, "cluster").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("label", F.col("node"))
    h = F.xxhash64("node", F.lit(5))
    pivot = (F.col("blocks") > 1) & (F.pmod(h, F.greatest(F.lit(1), (F.col("n") / PIVOTS).cast("long"))) == 0)
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = rows.withColumn("x", F.explode(F.when(pivot, every).otherwise(F.array(F.pmod(F.shiftright(h, 20), "blocks").cast("int")))))
    done = table(_linked(dealt.select("cluster", "x", F.lit(0).alias("y"), "node", "label", "seeks"), texts), "near-links", known)
    labels = table(components(done, "near-components"), "near-labels", known)

    large = _labelled(rows.filter("blocks > 1").select("cluster", "node", "n", "n_shingles"), "node", labels, "label")
    counts = large.groupBy("cluster", "label").agg(F.sum("n_shingles").alias("c"))
    most = counts.groupBy("cluster").agg(F.max(F.struct("c", "label")).alias("top")).select("cluster", F.col("top.c").alias("c"), F.col("top.label").alias("top"))
    left = table(large.join(most, "cluster").filter("c < n"), "near-left", known)
    if not left.isEmpty():
        out = F.ceil((F.col("n") - F.col("c")) / BLOCK).cast("int")
        all_blocks = F.ceil(F.col("n") / BLOCK).cast("int")
        own = lambda k: F.pmod(F.xxhash64("node", F.lit(9)), k).cast("int")
        seekers = left.filter("label != top").select("cluster", own(out).alias("x"), F.explode(F.sequence(F.lit(0), all_blocks - 1)).alias("y"), "node", "label", F.lit(True).alias("seeks"))
        whole = left.select("cluster", F.explode(F.sequence(F.lit(0), out - 1)).alias("x"), own(all_blocks).alias("y"), "node", "label", F.lit(False).alias("seeks"))
        both = seekers.unionByName(whole).groupBy("cluster", "x", "y", "node", "label").agg(F.max("seeks").alias("seeks"))
        labels = table(components(table(_linked(both, texts), "near-links", known).unionByName(done), "near-components"), "near-labels", known)
    return labels


def _text_key(doc_id: str, text: str) -> Column:
    return F.struct(F.col(doc_id).cast("string").alias("i"), F.xxhash64(F.col(text)).alias("h"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``, with ``key`` (id and
    hash of the text) and ``empty`` (no words).

    A document's set is its distinct shingles of five words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased), or its whole sequence
    if it has fewer words; two documents are linked if ``100 * intersection >= 75 * union``. ``component_id`` is the smallest
    id reachable over links, ``kept`` marks that document. Equal sets are one node of the graph, so copies are never paired.

    Null or empty text gives an empty set, linked with nothing: kept, its own component. A null id counts as the smallest of a
    group only if all are null. Repeated rows (same id, same text) get the same answer. An empty table gives no rows.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = table(signed(base.withColumn("key", _text_key("doc_id", "text")), "text").drop("text"), "near-signed")
    sets = rows.filter("node is not null").groupBy("node").agg(F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"), F.min("key").alias("key"), F.min("doc_id").alias("doc_id"))
    sets = table(sets, "near-sets")
    keyed = base.withColumn("key", _text_key("doc_id", "text")).select("key", "text")

    def texts_of(nodes: DataFrame) -> DataFrame:
        wanted = sets.join(nodes, "node", "left_semi").select("node", "key")
        return keyed.join(wanted, "key").select("node", "text").dropDuplicates(["node"])

    labels = links(sets.select("node", "sig", "n_shingles"), texts_of)
    least = _labelled(sets.select("node", "doc_id"), "node", labels, "comp")
    smallest = least.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    of_set = table(least.select("node", "comp").join(smallest, "comp").select("node", "component_id"), "near-of-set", sets.count())
    out = rows.select("doc_id", "n_shingles", "node", "key").join(of_set, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"), "key", F.col("node").isNull().alias("empty"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the smallest id. Documents without words all stay. Of rows that
    repeat both the kept id and its text one stays."""
    found = near_duplicates(docs, doc_id, text)
    key = fresh(docs, "key")
    gone = found.filter("not kept").select(F.col("key").alias(key)).distinct()
    rows = docs.withColumn(key, _text_key(doc_id, text)).join(gone, key, "left_anti")
    words = F.col(text).isNotNull() & F.col(text).rlike("[^\\x20\\x09-\\x0D]")
    return rows.filter(words).dropDuplicates([key]).unionByName(rows.filter(~words)).drop(key)
