"""Cells, scores and profiles: from distances per address to a livability value per cell."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walkgrid.constants import CATEGORIES, SCORE_COLUMNS
from walkgrid.functions.grid import DEFAULT_GRID, HexGrid
from walkgrid.functions.score import blend, distance_score, present
from walkgrid.operators.polygons import tag_cells


def with_cell(df: DataFrame, res: int = 10, grid: HexGrid = DEFAULT_GRID) -> DataFrame:
    """Add the cell (q, r) of each position."""
    q, r = grid.axial(F.col("lng"), F.col("lat"), res)
    return grid.detach(grid.attach(df).withColumns({"q": q, "r": r}))


def cell_scores(distances: DataFrame, grid: HexGrid = DEFAULT_GRID) -> DataFrame:
    """Per cell (q, r; of its region, if the grid has regions): address count and the mean of each category score (not the score of the mean distance)."""
    scored = distances.filter(F.col("q").isNotNull()).select(
        *grid.keys, "q", "r", *[distance_score(F.col(f"dist_{c}")).alias(f"score_{c}") for c in CATEGORIES]
    )
    return scored.groupBy(*grid.keys, "q", "r").agg(
        F.count("*").alias("n_addresses"), *[F.avg(s).alias(s) for s in SCORE_COLUMNS]
    )


def livability(
    distances: DataFrame,
    boundaries: DataFrame,
    weights: Mapping[str, float] | None = None,
    grid: HexGrid = DEFAULT_GRID,
) -> DataFrame:
    """Per cell: address count, category scores, municipality and the weighted blend."""
    overall = blend(weights)  # checks the weights before any job
    return tag_cells(cell_scores(distances, grid), boundaries, grid=grid).withColumn("livability", overall)


def _long(df: DataFrame, prefix: str) -> DataFrame:
    """One row per category and input row: (category, value), without a shuffle."""
    return df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("category"), present(F.col(f"{prefix}_{c}")).alias("value"))
                    for c in CATEGORIES
                ]
            )
        ).alias("x")
    ).select("x.*")


def bucketed_median(counts: DataFrame, group: str, value: str, n: str) -> DataFrame:
    """Exact median per group from a (group, value, n) histogram: mean of the two middle values."""
    ordered = Window.partitionBy(group).orderBy(value)
    ranked = counts.withColumns(
        {"_upto": F.sum(n).over(ordered), "_all": F.sum(n).over(Window.partitionBy(group))}
    )
    before = F.col("_upto") - F.col(n)

    def holds(rank: Column) -> Column:
        return (before < rank) & (rank <= F.col("_upto"))

    low, high = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    return ranked.groupBy(group).agg(
        (
            (F.max(F.when(holds(low), F.col(value))) + F.max(F.when(holds(high), F.col(value)))) / 2
        ).alias("median")
    )


def distance_profile(distances: DataFrame) -> DataFrame:
    """Per category: addresses with a distance, placed addresses, and the median distance to the centimetre.

    Distances are counted per centimetre first, so the ordered step sees at most a histogram of the search radius
    (100 bins per metre) however many addresses there are.
    """
    placed = distances.filter(present(F.col("lat")).isNotNull() & present(F.col("lng")).isNotNull())
    bins = (
        _long(placed, "dist")
        .withColumn("cm", F.floor(F.col("value") * 100 + 0.5))
        .groupBy("category", "cm")
        .agg(F.count("*").alias("n"))
    )
    totals = bins.groupBy("category").agg(
        F.coalesce(F.sum(F.when(F.col("cm").isNotNull(), F.col("n"))), F.lit(0)).alias("resolved"),
        F.sum("n").alias("total"),
    )
    medians = bucketed_median(bins.filter(F.col("cm").isNotNull()), "category", "cm", "n")
    return totals.join(medians, "category", "left").select(
        "category", "resolved", "total", (F.col("median") / 100).alias("median_m")
    )


#: Size of the quantile sketches; their error is RANK_ERROR of the rows in rank, with 99 % confidence.
SKETCH_K, RANK_ERROR = 1000, 0.004


def shard_profiles(df: DataFrame, shard: Column, prefix: str = "dist", placed: Column | None = None) -> DataFrame:
    """Mergeable profiles: per shard and category the rows (those ``placed``), those with a value, those above 0, their sum, and a
    quantile sketch of the values. Some kilobytes a row, whatever the size of the shard; one pass, combined before the shuffle."""
    rows = df if placed is None else df.filter(placed)
    values = [F.struct(F.lit(c).alias("category"), present(F.col(f"{prefix}_{c}")).alias("value")) for c in CATEGORIES]
    long = rows.select(shard.alias("shard"), F.explode(F.array(*values)).alias("x")).select("shard", "x.*")
    return long.groupBy("shard", "category").agg(
        F.count("*").alias("total"),
        F.count("value").alias("resolved"),
        F.count_if(F.col("value") > 0).alias("above"),
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("value_sum"),
        F.kll_sketch_agg_double("value", SKETCH_K).alias("sketch"),
    )


def merged_profile(profiles: DataFrame) -> DataFrame:
    """Per category, of the shards' profiles without a look at their rows: total, resolved, above 0, mean, and the median to within
    RANK_ERROR in rank (null without values)."""
    whole = profiles.groupBy("category").agg(
        *[F.sum(c).alias(c) for c in ("total", "resolved", "above", "value_sum")], F.kll_merge_agg_double("sketch", SKETCH_K).alias("sketch")
    )
    median = F.when(F.col("resolved") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)))
    return whole.select("category", "resolved", "total", "above", F.try_divide("value_sum", F.col("resolved")).alias("mean"), median.alias("median"))


def score_profile(scores: DataFrame) -> DataFrame:
    """Per category: cells with a score above 0, all cells, mean score."""
    return (
        _long(scores, "score")
        .groupBy("category")
        .agg(
            F.count_if(F.col("value") > 0).alias("cells_scored"),
            F.count("*").alias("cells"),
            F.avg("value").alias("mean_score"),
        )
    )


def score_metadata(scores: DataFrame) -> DataFrame:
    """One row about a score table: cells, municipalities, mean livability to two decimals (missing ignored)."""
    return scores.agg(
        F.count("*").alias("num_cells"),
        F.countDistinct("municipality").alias("num_municipalities"),
        F.round(F.avg(present(F.col("livability"))), 2).alias("mean_livability"),
    )
