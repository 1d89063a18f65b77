"""Readers for landed files: GeoJSON features, stop lists, POI elements, and any columnar or text table.

Feature and element readers know their schema; the stop list and ``read_data`` without a schema look at their input first.
Newline-delimited files split over tasks, and so does a file that is one JSON document (``multiline=True``): it is cut into byte
ranges of ``split`` bytes at object borders (``documents``). With ``split=None`` Spark reads it whole, in one task, from any file
system.
"""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from walkgrid.constants import ADDRESS_COLUMNS
from walkgrid.functions.geo import to_wgs84
from walkgrid.operators.amenities import require_columns
from walkgrid.sources import documents

ADDRESS_PROPERTIES = ", ".join(f"{name} {kind}" for name, kind in ADDRESS_COLUMNS.items())
BIKE_PATH_PROPERTIES = "ID_CYCL long"
BOUNDARY_PROPERTIES = "NOM string, TYPE string"

ELEMENT_SCHEMA = (
    "type string, id long, lon double, lat double, center struct<lon: double, lat: double>, tags map<string,string>"
)

#: What Spark's readers are told, by format; other names of a format.
_OPTIONS = {"csv": {"header": "true"}, "json": {}, "parquet": {}}
_ALIASES = {"pq": "parquet"}


def _properties(properties: str) -> T.StructType:
    schema = T.StructType([])
    for field in T.StructType.fromDDL(properties) if properties else []:
        schema.add(field)
    return schema


def _parsed(text: Column, depth: int) -> Column:
    return F.from_json(text, "array<" * depth + "double" + ">" * depth)


def _point_struct(p: Column, srid: int | None) -> Column:
    lng, lat = to_wgs84(F.get(p, F.lit(0)), F.get(p, F.lit(1)), srid)
    return F.struct(lng.alias("lng"), lat.alias("lat"))


def read_features(
    spark: SparkSession,
    path: str,
    geometry: str,
    properties: str = "",
    srid: int | None = None,
    multiline: bool = False,
    split: int | None = documents.RANGE,
) -> DataFrame:
    """GeoJSON features as rows: the properties, then the geometry in WGS84.

    ``geometry`` is ``point`` (columns lng, lat), ``line`` (``parts``: array of vertex arrays) or ``polygon``
    (``rings``: array of vertex arrays, parts and holes alike). Multi-part geometries keep all their parts; features
    of another type get nulls. With ``multiline`` the file is one FeatureCollection, else one feature per line.
    """
    feature = T.StructType(
        [
            T.StructField("properties", _properties(properties)),
            T.StructField("geometry", T.StructType.fromDDL("type string, coordinates string")),
        ]
    )
    if multiline and split:
        rows = documents.read_array(spark, path, "features", split).select(F.from_json("value", feature).alias("f")).select("f.*")
    elif multiline:
        document = T.StructType([T.StructField("features", T.ArrayType(feature))])
        rows = spark.read.schema(document).option("multiLine", True).json(path)
        rows = rows.select(F.explode("features").alias("f")).select("f.*")
    else:
        rows = spark.read.schema(feature).json(path)
    kind, text = F.col("geometry.type"), F.col("geometry.coordinates")

    def lines(coordinates: Column) -> Column:
        return F.transform(coordinates, lambda line: F.transform(line, lambda p: _point_struct(p, srid)))

    if geometry == "point":
        xy = F.when(kind == "Point", _parsed(text, 1))
        lng, lat = to_wgs84(F.get(xy, F.lit(0)), F.get(xy, F.lit(1)), srid)
        shape = {"lng": lng, "lat": lat}
    elif geometry == "line":
        many = F.when(kind == "LineString", F.array(_parsed(text, 2))).when(kind == "MultiLineString", _parsed(text, 3))
        shape = {"parts": lines(many)}
    elif geometry == "polygon":
        many = F.when(kind == "Polygon", _parsed(text, 3)).when(kind == "MultiPolygon", F.flatten(_parsed(text, 4)))
        shape = {"rings": lines(many)}
    else:
        raise ValueError(f"unknown geometry {geometry!r}; expected 'point', 'line' or 'polygon'")
    names = _properties(properties).names
    return rows.select(*[F.col(f"properties.{n}").alias(n) for n in names], *[c.alias(n) for n, c in shape.items()])


def read_stops(spark: SparkSession, path: str, columns: tuple[str, ...] = ("stop_id", "stop_lat", "stop_lon")) -> DataFrame:
    """Stop list with a header line, in whatever column order; ids stay text."""
    kinds = {"stop_lat": "double", "stop_lon": "double"}
    raw = spark.read.option("header", True).csv(path)
    require_columns(raw, "stop_id", "stop_lat", "stop_lon")
    return raw.select(
        *[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in columns],
        F.col("stop_lon").cast("double").alias("lng"),
        F.col("stop_lat").cast("double").alias("lat"),
    )


def read_elements(spark: SparkSession, path: str, multiline: bool = False, split: int | None = documents.RANGE) -> DataFrame:
    """POI elements, one per line or (``multiline``) one document with ``elements``; ``position`` is source order: by file
    name, then by place in the file, whatever order Spark reads files in."""
    if not multiline:
        rows = spark.read.schema(ELEMENT_SCHEMA).json(path)
        at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"))
        return rows.withColumn("position", at)
    if split:
        lines = documents.read_array(spark, path, "elements", split)
        return parse_elements(lines.select("value", F.struct("file", F.col("position").alias("block"), F.lit(0).cast("long").alias("pos")).alias("position")), "value", "position")
    document = T.StructType([T.StructField("elements", T.ArrayType(T.StructType.fromDDL(ELEMENT_SCHEMA)))])
    rows = spark.read.schema(document).option("multiLine", True).json(path)
    return rows.select(F.input_file_name().alias("file"), F.posexplode("elements").alias("pos", "e")).select(
        "e.*", F.struct("file", F.lit(0).cast("long").alias("block"), F.col("pos").cast("long").alias("pos")).alias("position")
    )


def parse_elements(lines: DataFrame, text: str, position: str) -> DataFrame:
    """POI elements from a column of JSON texts, one element each."""
    element = F.from_json(text, T.StructType.fromDDL(ELEMENT_SCHEMA)).alias("e")
    return lines.select(element, F.col(position).alias("position")).select("e.*", "position")


def read_data(spark: SparkSession, path: str, format: str | None = None, schema: T.StructType | str | None = None) -> DataFrame:
    """A Parquet, CSV (first line: names) or JSON table; without ``format`` the path's ending tells which.

    Without ``schema`` CSV and JSON are scanned once more to infer it.
    """
    ending = PurePosixPath(path).suffix.removeprefix(".").lower() if format is None else format
    kind = _ALIASES.get(ending, ending)
    if kind not in _OPTIONS:
        raise ValueError(f"{path}: unsupported format {ending!r}, not one of {', '.join(_OPTIONS)}")
    reader = spark.read.options(**_OPTIONS[kind])
    if schema is not None:
        return reader.schema(schema).format(kind).load(path)
    return reader.option("inferSchema", True).format(kind).load(path)
