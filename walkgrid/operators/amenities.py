"""Point-of-interest elements, traced lines, and the union of all amenity sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from walkgrid.constants import POI_TAGS
from walkgrid.functions.grid import DEFAULT_GRID, HexGrid, cell_id
from walkgrid.operators.polygons import with_representative_point

AMENITY_COLUMNS = ("category", "cell_r10", "lat", "lng")


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    for name in names:
        if name not in df.columns:
            raise ValueError(f"expected column {name!r}; available: {df.columns}")
    return df


#: (tag key, accepted value, category), in the order in which a key outranks the next.
_ACCEPTED = [
    (key, value, category)
    for key in dict.fromkeys(k for groups in POI_TAGS.values() for k in groups)
    for category, groups in POI_TAGS.items()
    for value in groups.get(key, ())
]


def accepted_class(tags: Column) -> Column:
    """The value of the first tag key, in rank order, that has an accepted one; else null."""
    found = [F.try_element_at(tags, F.lit(key)) for key in dict.fromkeys(k for k, _, _ in _ACCEPTED)]
    allowed = [[v for k, v, _ in _ACCEPTED if k == key] for key in dict.fromkeys(k for k, _, _ in _ACCEPTED)]
    return F.coalesce(*[F.when(value.isin(*values), value) for value, values in zip(found, allowed, strict=True)])


def category_of(fclass: Column) -> Column:
    """Scored category of a class, null if it has none."""
    by_class = F.create_map(*[F.lit(x) for _, value, category in _ACCEPTED for x in (value, category)])
    return F.try_element_at(by_class, fclass)


def in_bbox(lng: Column, lat: Column, bbox: tuple[float, float, float, float]) -> Column:
    """Plain comparisons, so the filter reaches the Parquet scan."""
    min_lng, min_lat, max_lng, max_lat = bbox
    return lng.between(min_lng, max_lng) & lat.between(min_lat, max_lat)


def poi_points(elements: DataFrame, bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Elements (type, id, lon, lat, center, tags, position) as classified points, one per (type, id); of those inside
    ``bbox`` only, if one is given, which is filtered before anything is shuffled.

    Own coordinates count if both are there, else the centre's. The first element in source order wins; that is a
    minimum that is sorted and combined before the shuffle, so a much-copied element does not pile up.
    """
    own = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    points = elements.select(
        F.col("type").alias("osm_type"),
        F.col("id").alias("osm_id"),
        F.try_element_at("tags", F.lit("name")).alias("name"),
        accepted_class(F.col("tags")).alias("fclass"),
        F.when(own, F.col("lon")).otherwise(F.col("center.lon")).alias("lng"),
        F.when(own, F.col("lat")).otherwise(F.col("center.lat")).alias("lat"),
        "position",
    ).dropna(subset=["fclass", "lng", "lat"])
    if bbox is not None:
        points = points.filter(in_bbox(F.col("lng"), F.col("lat"), bbox))
    return (
        points.groupBy("osm_type", "osm_id")
        .agg(F.min(F.struct("position", "name", "fclass", "lng", "lat")).alias("x"))
        .select("osm_type", "osm_id", "x.name", "x.fclass", "x.lng", "x.lat")
    )


def categorized_pois(pois: DataFrame, grid: HexGrid = DEFAULT_GRID) -> DataFrame:
    """POIs of a scored category with their fine cell; ``name`` is null where the source has none."""
    require_columns(pois, "fclass")
    if "name" not in pois.columns:
        pois = pois.withColumn("name", F.lit(None).cast("string"))
    tagged = pois.withColumn("category", category_of(F.col("fclass"))).filter(F.col("category").isNotNull())
    return indexed(tagged, grid).select("lng", "lat", "cell_r10", "name", "category")


def indexed(df: DataFrame, grid: HexGrid = DEFAULT_GRID, res: int = 10) -> DataFrame:
    """Add ``cell_r<res>`` of (lng, lat)."""
    q, r = grid.axial(F.col("lng"), F.col("lat"), res)
    return grid.detach(grid.attach(df).withColumn(f"cell_r{res}", cell_id(res, q, r, *map(F.col, grid.keys))))


def with_parent(
    df: DataFrame, res: int, coarse: int, names: tuple[str, str] = ("pq", "pr"), grid: HexGrid = DEFAULT_GRID
) -> DataFrame:
    """Add the coarse cell of each fine cell (q, r).

    The pair comes out of a generator: later filters and projections then refer to it instead of repeating the
    nested arithmetic, which would grow with every level.
    """
    pq, pr = grid.parent(F.col("q"), F.col("r"), res, coarse)
    pair = F.explode(F.array(F.struct(pq.alias(names[0]), pr.alias(names[1])))).alias("_parent")
    return grid.attach(df).select(*df.columns, pair).select(*df.columns, f"_parent.{names[0]}", f"_parent.{names[1]}")


def indexed_addresses(addresses: DataFrame, grid: HexGrid = DEFAULT_GRID) -> DataFrame:
    """Add the analysis cell and its shard cell; rows without a position (so without a cell) are dropped."""
    q, r = grid.axial(F.col("lng"), F.col("lat"), 10)
    placed = grid.detach(grid.attach(addresses.dropna(subset=["lng", "lat"])).withColumns({"q": q, "r": r}))
    sharded = with_parent(placed, 10, 6, grid=grid)
    key = [F.col(k) for k in grid.keys]
    return sharded.withColumns(
        {"cell_r10": cell_id(10, F.col("q"), F.col("r"), *key), "cell_r6": cell_id(6, F.col("pq"), F.col("pr"), *key)}
    ).drop("q", "r", "pq", "pr")


def indexed_parks(parks: DataFrame, grid: HexGrid = DEFAULT_GRID) -> DataFrame:
    """Park polygons with a point inside and its cell."""
    return indexed(with_representative_point(parks), grid)


def traced_lines(lines: DataFrame, id_col: str, parts: str = "parts", grid: HexGrid = DEFAULT_GRID) -> DataFrame:
    """One row per (line id, cell) along each part of each line; rows without a cell are dropped.

    A line is cut into its segments first, so a long line spreads over tasks after the shuffle of the final distinct,
    which also merges the parts of a line that comes in several rows.
    """
    line = F.col("_line")
    n = F.size(line)
    pairs = F.transform(
        F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))),
        lambda i: F.struct(F.get(line, i).alias("a"), F.get(line, F.least(i + 1, n - 1)).alias("b")),
    )
    segments = lines.select(id_col, F.explode(parts).alias("_line")).select(id_col, F.explode(pairs).alias("s"))
    q1, r1 = grid.axial(F.col("s.a.lng"), F.col("s.a.lat"), 10)
    q2, r2 = grid.axial(F.col("s.b.lng"), F.col("s.b.lat"), 10)
    cells = segments.select(id_col, q1.alias("q1"), r1.alias("r1"), q2.alias("q2"), r2.alias("r2")).dropna(
        subset=["q1", "r1", "q2", "r2"]
    )
    walk = grid.segment_cells(F.col("q1"), F.col("r1"), F.col("q2"), F.col("r2"))
    return cells.select(id_col, F.explode(walk).alias("c")).select(id_col, "c.q", "c.r").distinct()


def line_cells(traced: DataFrame, grid: HexGrid = DEFAULT_GRID) -> DataFrame:
    """Distinct cells of all lines with their centres."""
    cells = traced.select("q", "r").dropna().distinct()
    lng, lat = grid.center(F.col("q"), F.col("r"), 10)
    return cells.select(cell_id(10, F.col("q"), F.col("r")).alias("cell_r10"), lat.alias("lat"), lng.alias("lng"))


def amenity_frame(points: DataFrame, category: str | None = None) -> DataFrame:
    """Cell-indexed points in amenity shape; a given category overrides the points' own."""
    if category is not None:
        points = points.withColumn("category", F.lit(category))
    return points.select(*AMENITY_COLUMNS)


def amenities_union(pois: DataFrame, stops: DataFrame, parks: DataFrame, traced: DataFrame, grid: HexGrid = DEFAULT_GRID) -> DataFrame:
    """All amenity points of the six categories: categorised POIs, indexed stops and parks, centres of traced cells."""
    return (
        amenity_frame(pois)
        .unionByName(amenity_frame(stops, "transit"))
        .unionByName(amenity_frame(parks, "park"))
        .unionByName(amenity_frame(line_cells(traced, grid), "bike"))
        .dropna(subset=list(AMENITY_COLUMNS))
    )


def municipalities(boundaries: DataFrame) -> DataFrame:
    """Boundary polygons as (municipality, type, rings)."""
    require_columns(boundaries, "NOM", "TYPE")
    return boundaries.select(F.col("NOM").alias("municipality"), F.col("TYPE").alias("type"), "rings")
