"""Polygon operators: a point inside each polygon, and which polygon holds a cell centre."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from walkgrid.constants import UNKNOWN_MUNICIPALITY
from walkgrid.functions.geo import crossing_lng, polygon_edges, straddles
from walkgrid.functions.grid import DEFAULT_GRID, HexGrid
from walkgrid.operators.cover import Cell, base_cells
from walkgrid.session import materialize

#: Base cells of the index: the largest polygon spans about so many a side. Edges that a fine cell carries about, at most so many
#: halvings of a base cell to get there. They only decide how many rows the index has, never the result.
BASE_CELLS, CELL_EDGES, MAX_TIMES = 8, 16, 7


def with_representative_point(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Add ``lng``, ``lat`` of a point inside the polygon: the middle of the widest inside span of one scan line.

    The scan line runs halfway between the vertex latitudes next above and next below mid-height, so it meets no
    vertex. If it falls into the gap between the parts of a polygon, the first ring's own scan line is taken;
    degenerate polygons (no height) give their first vertex. Row-local: no shuffle.
    """
    kept = df.columns
    first = F.get(F.get(F.col(rings), F.lit(0)), F.lit(0))

    def lats(ring: Column) -> Column:
        return F.transform(ring, lambda p: p["lat"])

    def scan_line(values: str, out: str) -> dict[str, Column]:
        mid = (F.array_min(values) + F.array_max(values)) / 2
        return {
            out: (F.array_min(F.filter(values, lambda v: v > mid)) + F.array_max(F.filter(values, lambda v: v <= mid))) / 2
        }

    return (
        df.withColumns({
            "_all": F.flatten(F.transform(rings, lats)),
            "_one": lats(F.get(F.col(rings), F.lit(0))),
            "_edges": polygon_edges(F.col(rings)),
        })
        .withColumns({**scan_line("_all", "_scan_all"), **scan_line("_one", "_scan_one")})
        .withColumn(
            "_scan",
            F.when(F.exists("_edges", lambda e: straddles(e, F.col("_scan_all"))), F.col("_scan_all")).otherwise(
                F.col("_scan_one")
            ),
        )
        .withColumn("_crossed", F.filter("_edges", lambda e: straddles(e, F.col("_scan"))))
        .withColumn("_hits", F.array_sort(F.transform("_crossed", lambda e: crossing_lng(e, F.col("_scan")))))
        .withColumn(
            "_spans",
            F.when(
                F.size("_hits") >= 2,
                F.transform(
                    F.sequence(F.lit(0), F.floor(F.size("_hits") / 2).cast("int") - 1),
                    lambda i: F.struct(
                        (F.get("_hits", i * 2) - F.get("_hits", i * 2 + 1)).alias("minus_width"),
                        ((F.get("_hits", i * 2) + F.get("_hits", i * 2 + 1)) / 2).alias("lng"),
                    ),
                ),
            ),
        )
        .withColumn("_widest", F.array_min("_spans"))
        .withColumn(
            "_point",
            # a generator, so that later filters on the point do not drag the whole computation along
            F.explode(
                F.array(
                    F.struct(
                        F.coalesce(F.col("_widest.lng"), first["lng"]).alias("lng"),
                        F.when(F.col("_widest").isNotNull(), F.col("_scan")).otherwise(first["lat"]).alias("lat"),
                    )
                )
            ),
        )
        .select(*[F.col(c) for c in kept if c not in ("lng", "lat")], "_point.lng", "_point.lat")
    )


_EDGES = "array<struct<x1: double, y1: double, x2: double, y2: double>>"


def _edge_rows(edges: np.ndarray) -> list[dict[str, float]]:
    return [dict(zip(("x1", "y1", "x2", "y2"), e, strict=True)) for e in edges.tolist()]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _side(polygons: DataFrame) -> float | None:
    """Side of the base cells, a power of two: the one number that the driver learns of the polygons."""
    flat = F.flatten("rings")
    extent = lambda c: F.array_max(F.transform(flat, lambda p: p[c])) - F.array_min(F.transform(flat, lambda p: p[c]))
    largest = polygons.agg(F.max(F.greatest(extent("lng"), extent("lat")))).first()[0]
    return 2.0 ** math.ceil(math.log2(max(largest / BASE_CELLS, 1e-6))) if largest is not None else None


def _cover(polygons: DataFrame, name: str, side: float) -> tuple[DataFrame, DataFrame]:
    """Index of the polygons in two tables, one row a cell.

    ``bx, by, times, inner``: of each base cell the halvings that lead to its fine cells, as many as its edges ask for, and the least
    name of the polygons that hold all of it. ``times, fx, fy, inner, leaves``: of each fine cell the least name of the polygons that
    hold all of it but not of its base cell, and the polygons whose border it meets, with the edges that touch it (``cover``).
    A polygon has at most some ``BASE_CELLS ** 2`` base cells, a base cell at most ``4 ** MAX_TIMES`` fine ones, whatever the extent of
    the polygon; only cells on its border carry edges, each edge only the cells that it touches.
    """
    cell = T.StructType.fromDDL(f"bx long, by long, name string, n long, odd boolean, turns array<double>, edges {_EDGES}")
    leaf = f"struct<name: string, odd: boolean, turns: array<double>, edges: {_EDGES}>"
    part = T.StructType.fromDDL(f"times int, fx long, fy long, name string, leaf {leaf}")
    cell_batch, part_batch = to_arrow_schema(cell), to_arrow_schema(part)

    def base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, rings in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = base_cells(rings.as_py() or [], side)
                rows = [(c.x, c.y, label, len(c.edges) + len(c.turns), c.odd, c.turns.tolist(), _edge_rows(c.edges)) for c in found]
                yield _batch(rows, cell_batch)

    named = polygons.select(F.col(name).cast("string").alias("name"), "rings").filter("name is not null")
    cells = materialize(named.mapInArrow(base, cell), "polygon-cells")
    times = F.ceil(F.log2(F.greatest(F.sum("n") / CELL_EDGES, F.lit(1.0)))).cast("int")
    whole = F.min(F.when(F.col("n") == 0, F.col("name")))
    bases = materialize(cells.groupBy("bx", "by").agg(F.least(times, F.lit(MAX_TIMES)).alias("times"), whole.alias("inner")), "polygon-base")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                edges = np.array([[e["x1"], e["y1"], e["x2"], e["y2"]] for e in row["edges"]], float).reshape(-1, 4)
                out = []
                for c in Cell(side, row["bx"], row["by"], edges, row["odd"], np.array(row["turns"], float)).split(row["times"]):
                    if c.whole():
                        k = round(c.side * 2.0 ** row["times"] / side)
                        out += [(row["times"], c.x * k + i, c.y * k + j, row["name"], None) for i in range(k) for j in range(k)]
                    else:
                        leaf = {"name": row["name"], "odd": c.odd, "turns": c.turns.tolist(), "edges": _edge_rows(c.edges)}
                        out.append((row["times"], c.x, c.y, None, leaf))
                yield _batch(out, part_batch)

    border = cells.filter("n > 0").join(bases.select("bx", "by", "times"), ["bx", "by"]).select("bx", "by", "name", "odd", "turns", "edges", "times")
    fine = border.mapInArrow(split, part).groupBy("times", "fx", "fy").agg(F.min("name").alias("inner"), F.collect_list("leaf").alias("leaves"))
    # Written, so that a join is planned by the measured size of the index: generated rows do not show in Spark's estimates.
    return bases, materialize(fine, "polygon-fine")


def with_containing_polygon(points: DataFrame, polygons: DataFrame, name: str) -> DataFrame:
    """``points`` (``lng``, ``lat``) plus ``name`` of the polygon (``rings``) holding each, else null; a column ``name`` is replaced.

    Each point is looked up in a quadtree cover of the polygons: two left joins to tables with one row a cell, so no row is
    repeated, nothing is grouped, and Spark broadcasts the index or sorts (and splits hot cells) by its measured size. Only in a
    cell on a border edges are tested, those that touch it. An odd number of edges to the east means inside; the half-open test
    puts a point on a shared border in exactly one of the two polygons. Should polygons overlap, the alphabetically first name
    wins. Points without a position and polygons without a name or an edge match nothing.
    """
    kept = [c for c in points.columns if c != name]
    side = _side(polygons)
    if side is None:
        return points.select(*kept, F.lit(None).cast("string").alias(name))
    bases, fine = _cover(polygons, name, side)
    at = lambda of, times: F.floor(F.col(of) / F.lit(side) * F.pow(F.lit(2.0), times)).cast("long")
    zero = F.lit(0.0)
    # Inner columns cannot clash: the row travels as one struct.
    rows = points.select(F.struct(*points.columns).alias("row"), F.col("lng").alias("lng"), F.col("lat").alias("lat"), at("lng", zero).alias("bx"), at("lat", zero).alias("by"))
    rows = rows.join(bases.withColumnRenamed("inner", "inner_base"), ["bx", "by"], "left")
    rows = rows.withColumns({"fx": at("lng", F.col("times")), "fy": at("lat", F.col("times"))})
    rows = rows.join(fine, ["times", "fx", "fy"], "left")

    def inside(leaf: Column) -> Column:
        east = F.filter(leaf["edges"], lambda e: straddles(e, F.col("lat")) & (F.col("lng") < crossing_lng(e, F.col("lat"))))
        turned = F.filter(leaf["turns"], lambda t: t <= F.col("lat"))
        return (F.size(east) + F.size(turned) + leaf["odd"].cast("int")) % 2 == 1

    border = F.array_min(F.transform(F.filter("leaves", inside), lambda leaf: leaf["name"]))
    return rows.select(*[F.col("row")[c].alias(c) for c in kept], F.least("inner_base", "inner", border).alias(name))


def tag_cells(
    cells: DataFrame, boundaries: DataFrame, res: int = 10, grid: HexGrid = DEFAULT_GRID,
    unknown: str = UNKNOWN_MUNICIPALITY,
) -> DataFrame:
    """``cells`` (one row per q, r; and region) plus ``municipality``: the boundary holding the cell's centre, else ``unknown``."""
    lng, lat = grid.center(F.col("q"), F.col("r"), res)
    centers = grid.detach(grid.attach(cells).withColumns({"lng": lng, "lat": lat}))
    tagged = with_containing_polygon(centers, boundaries, "municipality").drop("lng", "lat")
    return tagged.withColumn("municipality", F.coalesce("municipality", F.lit(unknown)))


def tag_rows(
    df: DataFrame, boundaries: DataFrame, res: int = 10, grid: HexGrid = DEFAULT_GRID,
    unknown: str = UNKNOWN_MUNICIPALITY,
) -> DataFrame:
    """Any rows with (q, r) plus ``municipality``; the lookup runs once per distinct cell. No cell: ``unknown``."""
    cell = [*grid.keys, "q", "r"]
    tagged = tag_cells(df.select(*cell).dropna().distinct(), boundaries, res, grid, unknown)
    return df.join(tagged, cell, "left").withColumn("municipality", F.coalesce("municipality", F.lit(unknown)))
