"""I-Match fingerprints with randomised lexicon subsets, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walkgrid.llm.common import table


#: The band of inverse document frequency: terms in one of 50 to one of 500 documents. It has at most 500 times as many terms as
#: a document has distinct terms on average, whatever the number of documents.
MOST, LEAST = 50, 500
#: Disjoint random subsets of the lexicon, each with a hash of its own in the fingerprint.
SUBSETS = 64
#: Terms of a lexicon that is broadcast at most; a larger one is joined by shuffle.
BROADCAST_TERMS = 2_000_000
NONE = "0000"


def terms(text: Column) -> Column:
    """Distinct terms: runs of letters and digits, lower-cased."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), "[^\\p{L}\\p{N}]+")), "")


def lexicon(docs: DataFrame, text: str = "text") -> DataFrame:
    """``term`` (64-bit hash) of the terms inside the band, counted over all documents. Fewer than two documents never make a term."""
    n = docs.count()
    counts = docs.select(F.explode(terms(F.col(text))).alias("w")).groupBy(F.xxhash64("w").alias("term")).agg(F.count("*").alias("n"))
    return table(counts.filter((F.col("n") >= max(2.0, n / LEAST)) & (F.col("n") <= max(3.0, n / MOST))).select("term"), "lexicon")


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``k1, k2``: 128 bits that rows equal in id and text share."""
    out = docs.withColumn("text", F.coalesce(F.col(text), F.lit(""))).withColumn("k1", F.xxhash64("text"))
    return out.withColumn("k2", F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("\0")), "k1", F.lit(7)))


def successors(rows: DataFrame, doc_id: str) -> DataFrame:
    """``k1, k2, id`` of each distinct row with ``p1, p2`` of the row before it in (id, ``k1``) order and ``p_chars``; the
    first follows the last. Ranges of the order are sorted each by itself; only the first row of each range crosses over."""
    order = ["id", "k1", "k2"]
    light = rows.select(F.col(doc_id).alias("id"), "k1", "k2", F.length("text").alias("chars")).distinct()
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The range of a row must not be found out anew by each reader, hence the table.
    light = table(light.repartitionByRange(width, *order).withColumn("range", F.spark_partition_id()), "order")
    last = light.groupBy("range").agg(F.max(F.struct(F.col("id").isNotNull().alias("known"), *order, "chars")).alias("end"))
    ends = last.select("range", F.lag("end").over(Window.orderBy("range")).alias("end"), F.max("range").over(Window.partitionBy(F.lit(0))).alias("top"))
    # One row per range: bounded by the number of partitions.
    wrap = last.join(ends.groupBy().agg(F.max("top").alias("range")), "range").select(F.col("end").alias("wrap"))
    ends = ends.join(F.broadcast(wrap), F.lit(True)).select("range", F.coalesce("end", "wrap").alias("end"))
    before = F.lag(F.struct("k1", "k2", "chars")).over(Window.partitionBy("range").orderBy(*order))
    out = light.withColumn("before", before).join(ends, "range")
    pick = lambda name: F.coalesce(F.col("before")[name], F.col("end")[name])
    return out.select("k1", "k2", "id", pick("k1").alias("p1"), pick("k2").alias("p2"), pick("chars").alias("p_chars"))


def _fingerprints(versions: DataFrame, words: DataFrame) -> DataFrame:
    """``k1, k2, slots0, slots1``: of the in-band terms of each version, dealt to the subsets, one hash per subset over its sorted
    distinct terms. Rows without such a term have none. Grouped by the keys the input is already partitioned by."""
    rows = versions.select("k1", "k2", F.posexplode(F.array(terms(F.col("text")), terms(F.col("edited")))).alias("v", "terms"))
    rows = rows.select("k1", "k2", "v", F.explode("terms").alias("w")).select("k1", "k2", "v", F.xxhash64("w").alias("term"))
    known = rows.join(F.broadcast(words) if words.count() <= BROADCAST_TERMS else words, "term")
    slot = F.pmod(F.xxhash64("term", F.lit(13)), F.lit(SUBSETS)).cast("int")
    sets = known.groupBy("k1", "k2", "v", slot.alias("slot")).agg(F.array_sort(F.collect_set("term")).alias("terms"))
    one = F.lower(F.lpad(F.hex(F.pmod(F.xxhash64("terms"), F.lit(65535)) + 1), 4, "0"))
    return sets.select("k1", "k2", "v", F.struct("slot", one.alias("hash")).alias("s")).groupBy("k1", "k2").agg(
        *(F.map_from_entries(F.collect_list(F.when(F.col("v") == i, F.col("s")))).alias(f"slots{i}") for i in (0, 1))
    )


def _text_of(slots: Column, text: Column) -> Column:
    """The hashes of all subsets in order. A text with no term in the band is told by a hash of all its terms instead."""
    own = F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda i: F.coalesce(F.element_at(slots, i), F.lit(NONE)))
    every = F.lower(F.lpad(F.hex(F.pmod(F.xxhash64(F.array_sort(terms(text))), F.lit(65535)) + 1), 4, "0"))
    rare = F.when(F.size(terms(text)) > 0, F.concat(every, F.lit(NONE * (SUBSETS - 1)))).otherwise(F.lit(NONE * SUBSETS))
    return F.when(F.coalesce(F.size(slots), F.lit(0)) > 0, F.array_join(own, "")).otherwise(rare)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that either fingerprint has terms in; 1 if neither has any."""
    cut = F.sequence(F.lit(1), F.lit(4 * SUBSETS - 3), F.lit(4))
    some = F.filter(cut, lambda i: (F.substring(a, i, F.lit(4)) != NONE) | (F.substring(b, i, F.lit(4)) != NONE))
    same = F.filter(some, lambda i: F.substring(a, i, F.lit(4)) == F.substring(b, i, F.lit(4)))
    return F.when(a == b, F.lit(1.0)).otherwise(F.size(same) / F.size(some))


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text is the text with its last quarter (rounded down, code points) replaced by as much of the start of the next
    document; documents follow each other by id, then by hash of the text, nulls first, and the first follows the last. Null
    text counts as empty; an empty text has an empty fingerprint, like any text without letters or digits. Rows equal in id
    and text are one document and get the same answer each; a single document follows itself. An empty table gives no rows.

    Each text is shuffled once, by its key, and a quarter of it once more, to its predecessor; all grouping stays on that key.
    """
    keyed = _keyed(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "doc_id", "text")
    follow = table(successors(keyed, "doc_id"), "successors")
    words = lexicon(docs, text)
    rows = keyed.select("k1", "k2", "text")  # the same columns on both sides of what follows, so one shuffle serves both
    start = rows.join(follow, ["k1", "k2"]).select("p1", "p2", F.left("text", F.floor(F.col("p_chars") / 4).cast("int")).alias("start"))
    start = start.dropDuplicates(["p1", "p2"]).select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "start")
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = rows.join(start, ["k1", "k2"]).withColumn("edited", F.concat(F.left("text", n - quarter), F.left("start", quarter)))
    prints = _fingerprints(edited, words)
    found = edited.join(prints, ["k1", "k2"], "left").select(
        "k1",
        "k2",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        _text_of(F.col("slots0"), F.col("text")).alias("fingerprint"),
        _text_of(F.col("slots1"), F.col("edited")).alias("edited_fingerprint"),
    )
    found = table(found, "fingerprints")
    nexts = found.select("k1", "k2", "fingerprint").dropDuplicates(["k1", "k2"]).join(follow, ["k1", "k2"]).select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.col("fingerprint").alias("_next"))
    return found.join(nexts, ["k1", "k2"]).join(follow.select("k1", "k2", "id"), ["k1", "k2"]).select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"),
    )
