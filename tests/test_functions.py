import math

import pytest
from pyspark.sql import functions as F

from walkgrid.constants import CATEGORIES, DEFAULT_WEIGHTS
from walkgrid.functions.geo import haversine, to_wgs84
from walkgrid.functions.grid import DEFAULT_GRID as GRID
from walkgrid.functions.grid import hex_distance, ring_offsets
from walkgrid.functions.projection import system
from walkgrid.functions.score import blend, check_weights, custom_blend, distance_score, score_color
from walkgrid.functions.text import label, match_key
from walkgrid.operators.amenities import line_cells, traced_lines, with_parent
from walkgrid.operators.scores import with_cell


def values(df):
    return [tuple(r) for r in df.collect()]


def test_score_curve(spark):
    df = spark.createDataFrame(
        [(i, d) for i, d in enumerate([0.0, 100.0, 500.0, 750.0, 1000.0, 1500.0, float("nan"), None])], "i int, d double"
    )
    got = [s for _, s in sorted(values(df.select("i", distance_score(F.col("d")))))]
    assert got == pytest.approx([100, 100, 50, 35, 20, 0, 0, 0])


def metres(spark, lng1, lat1, lng2, lat2):
    df = spark.createDataFrame([(lng1, lat1, lng2, lat2)], "a double, b double, c double, d double")
    return df.select(haversine(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).first()[0]


def test_haversine_known_arcs(spark):
    assert metres(spark, 0.0, 0.0, 0.0, 0.0) == 0.0
    assert metres(spark, 0.0, 0.0, 1.0, 0.0) == pytest.approx(111_319, rel=1e-3)
    # pure north-south and pure east-west steps tell swapped arguments apart
    assert metres(spark, -73.6, 45.5, -73.6, 45.501) == pytest.approx(111.32, abs=0.01)
    assert metres(spark, -73.6, 45.5, -73.599, 45.5) == pytest.approx(111.32 * math.cos(math.radians(45.5)), abs=0.01)


def test_haversine_of_missing_position_is_missing(spark):
    assert metres(spark, None, None, 0.0, 0.0) is None


def test_mercator(spark):
    df = spark.createDataFrame([(-8_190_000.0, 5_690_000.0)], "x double, y double")
    lng, lat = df.select(*to_wgs84(F.col("x"), F.col("y"), 3857)).first()
    assert (lng, lat) == (pytest.approx(-73.572, abs=1e-3), pytest.approx(45.433, abs=1e-3))
    with pytest.raises(ValueError):
        to_wgs84(F.col("x"), F.col("y"), 27700)


@pytest.mark.parametrize("srid", [2950, 32188, 26918, 32618, 32718, 32631])
def test_transverse_mercator_there_and_back(spark, srid):
    """All over a zone and three degrees beyond, with the published length of the meridian's half."""
    zone = system(srid)
    south = -1 if zone.northing else 1
    points = [(zone.meridian + d / 2, south * lat) for d in range(-9, 10) for lat in (0.0, 1e-7, 12.5, 45.0, 60.0, 83.9)]
    df = spark.createDataFrame(points, "lng double, lat double")
    x, y = zone.project(F.col("lng"), F.col("lat"))
    df = df.withColumn("x", x).withColumn("y", y)
    lng, lat = to_wgs84(F.col("x"), F.col("y"), srid)
    rows = df.select("*", lng.alias("lng2"), lat.alias("lat2")).collect()
    assert max(max(abs(r["lng"] - r["lng2"]), abs(r["lat"] - r["lat2"])) for r in rows) < 1e-10
    on_axis = [r for r in rows if r["lng"] == zone.meridian]
    assert all(r["x"] == pytest.approx(zone.easting, abs=1e-6) for r in on_axis)
    equator = next(r for r in on_axis if r["lat"] == 0)
    assert equator["y"] == pytest.approx(zone.northing, abs=1e-6)
    halfway = next(r for r in on_axis if abs(r["lat"]) == 45)
    assert abs(halfway["y"] - zone.northing) == pytest.approx(4_984_944.378 * zone.scale, abs=2e-3)  # the published arc to 45 degrees


def test_center_lies_in_its_cell_and_parent_is_unique(spark):
    cells = spark.range(-20, 20).select(F.col("id").cast("int").alias("q")).withColumn(
        "r", F.explode(F.sequence(F.lit(-20), F.lit(20)))
    )
    lng, lat = GRID.center(F.col("q"), F.col("r"), 10)
    back = GRID.axial(F.col("lng"), F.col("lat"), 10)
    df = cells.withColumns({"lng": lng, "lat": lat}).select("q", "r", back[0].alias("q2"), back[1].alias("r2"))
    assert df.filter("q <> q2 or r <> r2").count() == 0
    parents = with_parent(cells, 10, 9)
    assert parents.groupBy("q", "r").count().filter("count > 1").count() == 0
    # a coarse cell of this edge holds about seven fine ones
    assert parents.groupBy("pq", "pr").count().agg(F.max("count")).first()[0] in range(6, 9)


def test_rings_hold_exactly_their_distance(spark):
    ks = spark.range(0, 11).select(F.col("id").cast("int").alias("k"))
    cells = ks.select("k", F.explode(ring_offsets(F.col("k"))).alias("o")).select("k", "o.*")
    d = hex_distance(F.lit(0), F.lit(0), F.col("dq"), F.col("dr"))
    assert cells.filter(d != F.col("k")).count() == 0
    sizes = {r["k"]: r["count"] for r in cells.distinct().groupBy("k").count().collect()}
    assert sizes == {k: (6 * k or 1) for k in range(11)}


def test_line_trace_is_gapless_and_keeps_id(spark):
    lines = spark.sql(
        "select 7 as id, array(array(named_struct('lng', -73.60d, 'lat', 45.50d), named_struct('lng', -73.55d, 'lat', 45.52d)),"
        " array(named_struct('lng', -73.6d, 'lat', 45.5d))) as parts union all select 8, array(array()) "
    )
    cells = values(traced_lines(lines, "id").select("id", "q", "r"))
    assert {c[0] for c in cells} == {7} and len(cells) == len(set(cells)) == 41
    near = lambda a, b: max(abs(a[1] - b[1]), abs(a[2] - b[2]), abs(a[1] - b[1] + a[2] - b[2])) == 1
    assert all(any(near(a, b) for b in cells) for a in cells)
    assert line_cells(traced_lines(lines, "id")).count() == 41


def test_cell_of_missing_position_is_missing(spark):
    df = spark.createDataFrame([(None, None), (-73.6, 45.5)], "lng double, lat double")
    assert sorted(values(with_cell(df).select("q", "r")), key=str) == [(0, 0), (None, None)]


def test_weights(spark):
    assert set(DEFAULT_WEIGHTS) == set(CATEGORIES) and sum(DEFAULT_WEIGHTS.values()) == pytest.approx(1)
    with pytest.raises(ValueError):
        check_weights({c: 0.0 for c in CATEGORIES})
    with pytest.raises(ValueError):
        check_weights({"cinema": 1.0})
    row = spark.range(1).select(*[F.lit(100.0 if c == "bike" else 0.0).alias(f"score_{c}") for c in CATEGORIES])
    assert row.select(blend()).first()[0] == pytest.approx(15)
    assert row.select(blend({"bike": 1.15})).first()[0] == pytest.approx(57.5)


def test_custom_blend_falls_back(spark):
    scores = {c: float(i) for i, c in enumerate(CATEGORIES)}
    row = spark.range(1).select(F.lit(42.0).alias("livability"), *[F.lit(v).alias(f"score_{c}") for c, v in scores.items()])
    pick = lambda *chosen, **kw: row.select(custom_blend(chosen, **kw)).first()[0]
    assert pick() == 42.0 and pick(*CATEGORIES) == 42.0
    assert pick("school") == 1.0
    assert pick("school", "bike") == pytest.approx(3.0)
    assert pick("school", weights={**DEFAULT_WEIGHTS, "school": 0.0}) == 42.0
    holes = row.withColumn("score_school", F.lit(float("nan")))
    assert holes.select(custom_blend(["school", "bike"])).first()[0] == 5.0
    assert holes.select(custom_blend(["school"])).first()[0] == 42.0


def test_colors(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 12.5), (2, 50.0), (3, 100.0), (4, 140.0), (5, -3.0), (6, None)], "i int, s double")
    got = [c for _, c in sorted(values(df.select("i", score_color(F.col("s")))))]
    assert got == [
        "rgb(215,25,28)", "rgb(234,100,63)", "rgb(255,255,191)", "rgb(26,150,65)", "rgb(26,150,65)",
        "rgb(215,25,28)", "rgb(215,25,28)",
    ]


def test_text(spark):
    df = spark.createDataFrame([("  ÉCOLE ", 1234567), ("Straße", 5), ("ﬁn", 0), (None, None)], "s string, n long")
    assert [r[0] for r in df.select(match_key(F.col("s"))).collect()] == ["école", "strasse", "fin", None]
    assert df.select(F.format_number("n", 0)).first()[0] == "1,234,567"
    names = spark.createDataFrame([("bike",), ("museum",)], "k string")
    assert [r[0] for r in names.select(label(F.col("k"), {"bike": "Bike paths"})).collect()] == ["Bike paths", "Museum"]
