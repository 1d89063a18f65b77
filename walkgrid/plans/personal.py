"""Personal score on top of livability: travel time to a user's own places."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkgrid.functions.geo import haversine
from walkgrid.functions.grid import DEFAULT_GRID, HexGrid
from walkgrid.functions.score import distance_score

# Metres per minute by mode, over straight-line distance.
SPEED = {"walking": 80.0, "biking": 250.0, "transit": 300.0, "driving": 500.0}

# (minutes, score): 15 minutes or less 100, 30 minutes 50, more 0.
TIME_KNOTS = ((15.0, 100.0), (30.0, 50.0))


@dataclass(frozen=True)
class Anchor:
    name: str
    lat: float
    lng: float
    weight: float
    mode: str

    def minutes(self, lng: Column, lat: Column) -> Column:
        if self.mode not in SPEED:
            raise ValueError(f"unknown mode {self.mode!r}; expected one of {sorted(SPEED)}")
        return haversine(lng, lat, F.lit(self.lng), F.lit(self.lat)) / SPEED[self.mode]


def travel_times(cells: DataFrame, anchors: Sequence[Anchor], res: int = 10, grid: HexGrid = DEFAULT_GRID) -> DataFrame:
    """Cells plus ``minutes_<anchor>`` each. Anchors are call arguments, so they are columns and need no join."""
    lng, lat = grid.center(F.col("q"), F.col("r"), res)
    return cells.withColumns({f"minutes_{a.name}": a.minutes(lng, lat) for a in anchors})


def personal_scores(scores: DataFrame, anchors: Sequence[Anchor], grid: HexGrid = DEFAULT_GRID) -> DataFrame:
    """Livability plus the weighted anchor scores of every cell."""
    timed = travel_times(scores, anchors, grid=grid)
    total = F.col("livability")
    for a in anchors:
        total = total + distance_score(F.col(f"minutes_{a.name}"), TIME_KNOTS) * float(a.weight)
    return timed.withColumn("personal_score", total)


def top_cells(personal: DataFrame, anchors: Sequence[Anchor], n: int = 10) -> DataFrame:
    """The ``n`` best cells with what makes up their score."""
    parts = [F.format_string("livability %.1f", "livability")]
    parts += [F.format_string(f"{a.name} %.1f min {a.mode}", f"minutes_{a.name}") for a in anchors]
    return (
        personal.orderBy(F.desc("personal_score"), "q", "r").limit(n).withColumn("why", F.concat_ws("; ", *parts))
    )
