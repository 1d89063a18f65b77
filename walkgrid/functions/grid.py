"""Planar hexagon grid: cells as axial (q, r) integers, everything a Column expression.

Positions become metres on a local equirectangular plane around a reference point, then axial hexagon coordinates by
cube rounding. A cell id is the text ``res:q:r``. The reference point is a parameter (``HexGrid``), or a column that differs by
region (``RegionGrid``): a plane is meant for one region (a city, a province), not for a continent.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkgrid.constants import EDGE_M
from walkgrid.functions.geo import M_PER_DEG

SQRT3 = math.sqrt(3.0)


def half_up(x: Column) -> Column:
    return F.floor(x + 0.5)


def cube_round(qf: Column, rf: Column) -> tuple[Column, Column]:
    """Nearest hexagon of fractional axial coordinates."""
    sf = -qf - rf
    q, r, s = half_up(qf), half_up(rf), half_up(sf)
    dq, dr, ds = F.abs(q - qf), F.abs(r - rf), F.abs(s - sf)
    q_off = (dq > dr) & (dq > ds)
    r_off = ~q_off & (dr > ds)
    return (
        F.when(q_off, -r - s).otherwise(q).cast("int"),
        F.when(r_off, -q - s).otherwise(r).cast("int"),
    )


def hex_distance(q1: Column, r1: Column, q2: Column, r2: Column) -> Column:
    dq, dr = q2 - q1, r2 - r1
    return F.greatest(F.abs(dq), F.abs(dr), F.abs(dq + dr))


def cell_id(res: int, q: Column, r: Column, region: Column | None = None) -> Column:
    """``res:q:r``, with ``region/`` before it where cells of several regions stand side by side."""
    own = F.concat(F.lit(f"{res}:"), q.cast("string"), F.lit(":"), r.cast("string"))
    return own if region is None else F.concat(region, F.lit("/"), own)


def cell_q(cell: Column) -> Column:
    return F.split(cell, ":")[1].cast("int")


def cell_r(cell: Column) -> Column:
    return F.split(cell, ":")[2].cast("int")


def disk_offsets(max_k: int) -> Column:
    """Array literal of (k, dq, dr) for all cells within ``max_k`` steps; its size depends on ``max_k`` alone."""
    return F.expr(
        f"""flatten(transform(sequence(-{max_k}, {max_k}), dq ->
              transform(sequence(greatest(-{max_k}, -dq - {max_k}), least({max_k}, -dq + {max_k})), dr ->
                named_struct('k', greatest(abs(dq), abs(dr), abs(dq + dr)), 'dq', dq, 'dr', dr))))"""
    )


def around_cells(cells: DataFrame, q: str, r: str, low: int, high: int, names: tuple[str, str]) -> DataFrame:
    """``cells`` once for each cell ``low`` to ``high`` steps away: ``k`` and the cell as ``names``. Two plain generators, which
    cost far less than one array of all offsets per row."""
    out = cells.withColumn("_dq", F.explode(F.sequence(F.lit(-high), F.lit(high))))
    out = out.withColumn("_dr", F.explode(F.sequence(F.greatest(F.lit(-high), -F.col("_dq") - high), F.least(F.lit(high), -F.col("_dq") + high))))
    out = out.withColumn("k", F.greatest(F.abs("_dq"), F.abs("_dr"), F.abs(F.col("_dq") + F.col("_dr")))).filter(F.col("k") >= low)
    return out.withColumns({names[0]: F.col(q) + F.col("_dq"), names[1]: F.col(r) + F.col("_dr")}).drop("_dq", "_dr")


def ring_offsets(k: Column) -> Column:
    """Array of (dq, dr) for the cells exactly ``k`` steps away (``k`` may differ per row)."""
    # six sides of k steps each; side i starts at k times direction i and walks along direction i + 2
    side = lambda sq, sr, wq, wr: F.transform(
        F.sequence(F.lit(0), k - 1),
        lambda t: F.struct((k * sq + t * wq).alias("dq"), (k * sr + t * wr).alias("dr")),
    )
    around = F.concat(
        side(1, 0, -1, 1), side(0, 1, -1, 0), side(-1, 1, 0, -1),
        side(-1, 0, 1, -1), side(0, -1, 1, 0), side(1, -1, 0, 1),
    )
    centre = F.array(F.struct(F.lit(0).alias("dq"), F.lit(0).alias("dr")))
    return F.when(k == 0, centre).otherwise(around)


@dataclass(frozen=True)
class HexGrid:
    lat0: float = 45.5
    lng0: float = -73.6

    #: Columns that tell apart cells of equal (q, r).
    keys = ()

    @property
    def m_per_deg_lng(self) -> float:
        return M_PER_DEG * math.cos(math.radians(self.lat0))

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` with what the methods need beside positions and cells."""
        return df

    def detach(self, df: DataFrame) -> DataFrame:
        return df

    def fractional(self, lng: Column, lat: Column, edge: float) -> tuple[Column, Column]:
        x = (lng - self.lng0) * self.m_per_deg_lng
        y = (lat - self.lat0) * M_PER_DEG
        return (x * (SQRT3 / 3) - y / 3) / edge, (y * (2.0 / 3)) / edge

    def axial(self, lng: Column, lat: Column, res: int) -> tuple[Column, Column]:
        """(q, r) of the cell holding a position; null where the position is."""
        return cube_round(*self.fractional(lng, lat, EDGE_M[res]))

    def center(self, q: Column, r: Column, res: int) -> tuple[Column, Column]:
        """(lng, lat) of a cell's centre."""
        edge = EDGE_M[res]
        lng = (q + r / 2) * (SQRT3 * edge) / self.m_per_deg_lng + self.lng0
        lat = r * (1.5 * edge) / M_PER_DEG + self.lat0
        return lng, lat

    def parent(self, q: Column, r: Column, res: int, coarse: int) -> tuple[Column, Column]:
        """Cell of resolution ``coarse`` that holds the centre, so every child has exactly one parent."""
        return self.axial(*self.center(q, r, res), coarse)

    def outline(self, q: Column, r: Column, res: int) -> Column:
        """The six corners, counter-clockwise, as an array of (lng, lat)."""
        lng, lat = self.center(q, r, res)
        edge = EDGE_M[res]
        corners = []
        for i in range(6):
            angle = math.radians(60 * i - 30)
            corners.append(
                F.struct(
                    (lng + edge * math.cos(angle) / self.m_per_deg_lng).alias("lng"),
                    (lat + edge * math.sin(angle) / M_PER_DEG).alias("lat"),
                )
            )
        return F.array(*corners)

    def segment_cells(self, q1: Column, r1: Column, q2: Column, r2: Column) -> Column:
        """Array of (q, r) on the straight run of cells from one cell to another, both included."""
        steps = hex_distance(q1, r1, q2, r2)

        def at(t: Column) -> Column:
            share = t / F.greatest(steps, F.lit(1))
            q, r = cube_round(q1 + (q2 - q1) * share, r1 + (r2 - r1) * share)
            return F.struct(q.alias("q"), r.alias("r"))

        return F.transform(F.sequence(F.lit(0), steps), at)


class RegionGrid(HexGrid):
    """A plane for each row of ``regions`` (``region``, ``lat0``, ``lng0``; one row a region): rows with a ``region`` get its
    reference point as columns by an equi-join, and cells are told apart by region. Rows of no known region have no cell."""

    keys = ("region",)
    _names = ("_grid_lat0", "_grid_lng0")

    def __init__(self, regions: DataFrame) -> None:
        object.__setattr__(self, "regions", regions.select("region", F.col("lat0").alias(self._names[0]), F.col("lng0").alias(self._names[1])))
        object.__setattr__(self, "lat0", F.col(self._names[0]))
        object.__setattr__(self, "lng0", F.col(self._names[1]))

    @property
    def m_per_deg_lng(self) -> Column:
        return F.cos(F.radians(self.lat0)) * M_PER_DEG

    def attach(self, df: DataFrame) -> DataFrame:
        return df.join(self.regions, "region", "left")

    def detach(self, df: DataFrame) -> DataFrame:
        return df.drop(*self._names)


DEFAULT_GRID = HexGrid()
