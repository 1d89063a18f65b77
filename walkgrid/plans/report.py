"""Report datasets: map features and boundary features as GeoJSON lines, and their join to the ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkgrid.constants import SCORE_COLUMNS
from walkgrid.functions.geo import round_rings
from walkgrid.functions.score import score_color
from walkgrid.functions.text import match_key


def _feature(rings: Column, properties: Column) -> Column:
    return F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.lit("Polygon").alias("type"), round_rings(rings).alias("coordinates")).alias("geometry"),
            properties.alias("properties"),
        )
    )


def hex_features(hexes: DataFrame) -> DataFrame:
    """One GeoJSON feature per coarse cell: closed outline to 6 decimals, scores to 1, and the fill colour."""
    ring = F.col("outline")
    closed = F.array(F.concat(ring, F.slice(ring, 1, 1)))
    properties = F.struct(
        "municipality",
        F.col("addresses").cast("long").alias("addresses"),
        *[F.round(v, 1).alias(v) for v in ("livability", *SCORE_COLUMNS)],
        score_color(F.col("livability")).alias("fill"),
    )
    return hexes.select("cell", _feature(closed, properties).alias("feature"))


def boundary_features(municipalities: DataFrame) -> DataFrame:
    """One GeoJSON feature per boundary under its caseless key; all rings in one polygon (even-odd)."""
    return municipalities.select(
        "municipality",
        match_key(F.col("municipality")).alias("municipality_key"),
        _feature(F.col("rings"), F.struct("municipality")).alias("feature"),
    )


def ranked_boundaries(ranking: DataFrame, features: DataFrame) -> DataFrame:
    """Ranking rows with the boundary feature of the same caseless name; null where there is none."""
    shapes = features.select("municipality_key", "feature")
    return ranking.join(shapes, "municipality_key", "left").select(*ranking.columns, "feature")


def write_features(features: DataFrame, path: str) -> None:
    """Newline-delimited GeoJSON, written by all tasks."""
    features.select(F.col("feature").alias("value")).write.text(path)
