"""Roll-ups of the score table: coarse cells, municipalities, city-wide figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walkgrid.constants import CATEGORIES, CATEGORY_LABELS, SCORE_COLUMNS, UNKNOWN_MUNICIPALITY
from walkgrid.functions.grid import DEFAULT_GRID, HexGrid, cell_id
from walkgrid.functions.text import label, match_key
from walkgrid.operators.amenities import with_parent
from walkgrid.session import materialize

VALUE_COLUMNS = ("livability", *SCORE_COLUMNS)


def _weighted_sums() -> list[Column]:
    return [
        F.sum("n_addresses").alias("addresses"),
        *[F.sum(F.col(v) * F.col("n_addresses")).alias(v) for v in VALUE_COLUMNS],
    ]


def address_weighted(scores: DataFrame, *group: str) -> DataFrame:
    """Per group: addresses, and the address-weighted mean of every value column."""
    sums = scores.dropna(subset=list(group)).groupBy(*group).agg(*_weighted_sums())
    return sums.select(*group, "addresses", *[F.try_divide(F.col(v), F.col("addresses")).alias(v) for v in VALUE_COLUMNS])


def _most_frequent(value: str, n: str) -> Column:
    """Of counted values the most frequent: ties go to the smallest, nulls do not count."""
    return F.min(F.when(F.col(value).isNotNull(), F.struct((-F.col(n)).alias("minus_n"), F.col(value).alias("v"))))["v"]


def dominant(df: DataFrame, group: list[str], value: str, unknown: str = UNKNOWN_MUNICIPALITY) -> DataFrame:
    """Most frequent ``value`` per group; ties go to the smallest, nulls do not count, no value gives ``unknown``.

    Counted per (group, value) first, so a crowded group is combined before it meets in one task.
    """
    counts = df.groupBy(*group, value).agg(F.count("*").alias("_n"))
    return counts.groupBy(*group).agg(F.coalesce(_most_frequent(value, "_n"), F.lit(unknown)).alias(value))


def hex_rollup(scores: DataFrame, res: int = 9, fine: int = 10, grid: HexGrid = DEFAULT_GRID) -> DataFrame:
    """Fine cells up to cells of ``res``: weighted means, most frequent municipality (counting cells), outline.

    The means and the mode share one aggregate per (coarse cell, municipality) and one per coarse cell.
    """
    coarse = [*grid.keys, "pq", "pr"]
    parts = (
        with_parent(scores.dropna(subset=["q", "r"]), fine, res, grid=grid)
        .groupBy(*coarse, "municipality")
        .agg(F.count("*").alias("_n"), *_weighted_sums())
    )
    sums = [F.sum(c).alias(c) for c in ("addresses", *VALUE_COLUMNS)]
    whole = grid.attach(parts.groupBy(*coarse).agg(_most_frequent("municipality", "_n").alias("municipality"), *sums))
    return whole.select(
        *grid.keys,
        cell_id(res, F.col("pq"), F.col("pr"), *map(F.col, grid.keys)).alias("cell"),
        F.col("pq").alias("q"),
        F.col("pr").alias("r"),
        "addresses",
        *[F.try_divide(F.col(v), F.col("addresses")).alias(v) for v in VALUE_COLUMNS],
        F.coalesce("municipality", F.lit(UNKNOWN_MUNICIPALITY)).alias("municipality"),
        grid.outline(F.col("pq"), F.col("pr"), res).alias("outline"),
    )


def municipality_table(scores: DataFrame) -> DataFrame:
    """Address-weighted means per known municipality, best first."""
    known = scores.filter(F.col("municipality") != UNKNOWN_MUNICIPALITY)
    return address_weighted(known, "municipality").orderBy(F.desc("livability"), "municipality")


def with_rank(table: DataFrame, value: str = "livability", tie: str = "municipality") -> DataFrame:
    """Distinct ranks 1..n by falling ``value`` (missing last), then ``tie``; a column ``rank`` is replaced.

    The table is dealt to tasks by ranges of both columns, sorted within each and written; a row's rank is its place in its range
    plus the rows of all ranges before, one running sum over as many numbers as there are ranges. So no task orders the whole
    table, even if all values are equal; rows equal in both columns are ranked in any order.
    """
    ranges = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = table.select(F.struct(*table.columns).alias("row")).select("row", *[F.col(f"row.{c}").alias(f"_{c}") for c in dict.fromkeys((value, tie))])
    order = [F.desc_nulls_last(f"_{value}"), F.asc_nulls_last(f"_{tie}"), F.asc(F.xxhash64("row"))]
    placed = at.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("row", F.monotonically_increasing_id().alias("at"))
    placed = materialize(placed, "ranked")  # the number is the range's and, below, the place in it
    split = placed.withColumns({"range": F.shiftright("at", 33), "place": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = split.groupBy("range").agg(F.count("*").alias("n"))
    before = counts.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))  # a row a range
    kept = [F.col(f"row.{c}").alias(c) for c in table.columns if c != "rank"]
    return split.join(F.broadcast(before), "range").select((F.col("before") + F.col("place") + 1).alias("rank"), *kept)


def municipality_ranking(table: DataFrame) -> DataFrame:
    """Report rows: rank, name, caseless key, addresses with separators, livability to 1 and scores to 0 decimals."""
    return with_rank(table).select(
        "rank",
        "municipality",
        match_key(F.col("municipality")).alias("municipality_key"),
        F.format_number("addresses", 0).alias("addresses"),
        F.round("livability", 1).alias("livability"),
        *[F.round(s, 0).alias(s) for s in SCORE_COLUMNS],
    )


def global_stats(scores: DataFrame, amenities: DataFrame) -> DataFrame:
    """One row: addresses, amenities, known municipalities, mean livability over cells (not weighted)."""
    known = F.when(F.col("municipality") != UNKNOWN_MUNICIPALITY, F.col("municipality"))
    cells = scores.agg(
        F.sum("n_addresses").alias("addresses"),
        F.avg("livability").alias("mean_livability"),
        F.countDistinct(known).alias("municipalities"),
    )
    total = amenities.agg(F.count("*").alias("amenities"))
    return cells.unionByName(total, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("addresses", "amenities", "municipalities", "mean_livability")]
    )


def category_share(amenities: DataFrame) -> DataFrame:
    """Count and percentage of each category, most frequent first; absent categories show 0."""
    counts = amenities.agg(*[F.count_if(F.col("category") == c).alias(c) for c in CATEGORIES])
    total = F.greatest(sum(F.col(c) for c in CATEGORIES), F.lit(1))
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(c).alias("category"), F.col(c).alias("count"))
            for i, c in enumerate(CATEGORIES)
        ]
    )
    return (
        counts.select(total.alias("total"), F.explode(rows).alias("x"))
        .select(
            "x.category",
            label(F.col("x.category"), CATEGORY_LABELS).alias("label"),
            "x.count",
            F.round(F.col("x.count") * 100 / F.col("total"), 1).alias("share"),
            "x.position",
        )
        .orderBy(F.desc("count"), "position")
        .drop("position")
    )


def map_center(hexes: DataFrame, res: int = 9, grid: HexGrid = DEFAULT_GRID) -> DataFrame:
    """Mean of the cell centres: where the map opens."""
    lng, lat = grid.center(F.col("q"), F.col("r"), res)
    return hexes.agg(F.avg(lat).alias("lat"), F.avg(lng).alias("lng"))
