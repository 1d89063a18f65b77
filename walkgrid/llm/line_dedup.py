"""Line dedup by site-relative frequency: a line on a large share of one host's pages is boilerplate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkgrid.llm.common import fresh, table

#: Boilerplate lines of all hosts that are broadcast at most, 12 bytes each; more are joined by host and one of so many salts.
LINES, SALTS = 200_000, 64


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def _line_key(line: Column) -> Column:
    """Lines are compared by hash; the length makes an accidental match rarer still."""
    return F.struct(F.xxhash64(line).alias("h"), F.length(line).alias("n"))


def boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.1, min_pages: int = 5) -> DataFrame:
    """Per host the lines that stand on more than ``ratio`` of its pages and on ``min_pages`` at least: one row
    ``host, pages, lines`` with an array of line keys, which has at most (mean distinct lines of a page) / ratio entries.

    Counts are sums that combine before the shuffle, keyed by host and line together, so a host with a third of all rows is
    no hot key.
    """
    one = F.coalesce(F.col(host), F.lit("\0"))
    totals = pages.groupBy(one.alias("host")).agg(F.count("*").alias("pages"))
    counts = (
        pages.select(one.alias("host"), F.explode(F.array_distinct(F.transform(_lines(text), lambda x: F.when(F.trim(x) != "", _line_key(x))))).alias("line"))
        .filter("line is not null")
        .groupBy("host", "line")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_pages)
    )
    return (
        counts.join(totals, "host")
        .filter(F.col("n") > ratio * F.col("pages"))
        .groupBy("host")
        .agg(F.first("pages").alias("pages"), F.array_sort(F.collect_list("line")).alias("lines"))
    )


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.1, min_pages: int = 5) -> DataFrame:
    """``pages`` with ``kept_text`` (the text without its boilerplate lines), ``n_lines`` and ``n_dropped``.

    Lines end at ``\\n``; blank lines are never boilerplate and stay. Null text counts as a page of the host without lines
    and keeps a null ``kept_text``. Pages without a host form one site. A repeated row counts as often as it stands there.
    Lines of any length are compared by hash and length. Columns named as an output are replaced, all others stay. Empty tables
    give no rows.

    The lines found are a written table. Up to LINES of them are broadcast, so that a page is judged where it lies; more are joined
    by host and salt: pages are dealt to SALTS parts by their text, the lines of a host go to each, so that a hot host is no single
    task's work. Either way every page stays.
    """
    found, on = fresh(pages, "found"), [fresh(pages, "host_key"), fresh(pages, "salt")]
    lines = table(boilerplate(pages, host, text, ratio, min_pages).select(F.col("host").alias(on[0]), F.col("lines").alias(found)), "line-boilerplate")
    rows = pages.withColumn(on[0], F.coalesce(F.col(host), F.lit("\0")))
    if (lines.agg(F.sum(F.size(found))).first()[0] or 0) <= LINES:
        joined = rows.join(F.broadcast(lines), on[0], "left")
    else:
        salted = lines.withColumn(on[1], F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn(on[1], F.pmod(F.xxhash64(text), F.lit(SALTS)).cast("int")).join(salted, on, "left")
    clean = F.filter(_lines(text), lambda x: ~F.coalesce(F.array_contains(F.col(found), _line_key(x)), F.lit(False)))
    rest = [c for c in pages.columns if c not in ("n_lines", "kept_text", "n_dropped")]
    has, kept = F.col(text).isNotNull(), fresh(pages, "kept")
    n_lines = F.when(has, F.size(_lines(text))).otherwise(0).cast("long")
    return joined.withColumn(kept, clean).select(
        *rest,
        F.when(has, F.array_join(kept, "\n")).alias("kept_text"),
        n_lines.alias("n_lines"),
        F.when(has, n_lines - F.size(kept)).otherwise(0).cast("long").alias("n_dropped"),
    )
