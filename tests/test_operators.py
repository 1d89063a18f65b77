import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from walkgrid.constants import CATEGORIES, UNKNOWN_MUNICIPALITY
from walkgrid.functions.grid import DEFAULT_GRID as GRID
from walkgrid.operators import amenities as am
from walkgrid.operators import quality, rollup
from walkgrid.operators.polygons import tag_cells, tag_rows, with_containing_polygon, with_representative_point
from walkgrid.operators.scores import bucketed_median
from walkgrid.plans import ledger as lg
from walkgrid.plans.contracts import CONTRACTS, Contract


def ring(*xy):
    return [{"lng": float(x), "lat": float(y)} for x, y in xy]


POLYGONS = "name string, rings array<array<struct<lng: double, lat: double>>>"
SQUARE = ring((0, 0), (4, 0), (4, 4), (0, 4))
HOLE = ring((1, 1), (3, 1), (3, 3), (1, 3))


def test_representative_points_are_inside(spark):
    shapes = {
        "ell": [ring((0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2))],
        "hole": [SQUARE, HOLE],
        "closed": [ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))],
        "parts": [ring((0, 0), (1, 0), (1, 1), (0, 1)), ring((0, 9), (1, 9), (1, 10), (0, 10))],
        "flat": [ring((5, 5), (6, 5), (7, 5))],
    }
    df = with_representative_point(spark.createDataFrame(list(shapes.items()), POLYGONS))
    got = {r["name"]: (r["lng"], r["lat"]) for r in df.collect()}
    assert got["ell"] == (0.5, 1.5)
    assert got["hole"] == (0.5, 2.0)
    assert got["closed"] == (2.0, 2.0)
    assert got["parts"] == (0.5, 0.5)
    assert got["flat"] == (5.0, 5.0)


def test_containing_polygon_handles_holes_borders_and_outsiders(spark):
    polygons = spark.createDataFrame(
        [("b", [SQUARE, HOLE]), ("a", [ring((4, 0), (8, 0), (8, 4), (4, 4))]), ("z", [ring((4, 0), (8, 0), (8, 4), (4, 4))])],
        POLYGONS,
    )
    pts = {1: (0.5, 2.0), 2: (2.0, 2.0), 3: (4.0, 2.0), 4: (6.0, 3.99), 5: (9.0, 2.0), 6: (2.0, 0.0)}
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in pts.items()], "id int, lng double, lat double")
    got = {r["id"]: r["name"] for r in with_containing_polygon(df, polygons, "name").collect()}
    assert got == {1: "b", 2: None, 3: "a", 4: "a", 5: None, 6: "b"}


def test_tagging_inside_and_outside(spark):
    box = ring((-73.7, 45.4), (-73.5, 45.4), (-73.5, 45.6), (-73.7, 45.6))
    boundaries = spark.createDataFrame([("CityA", [box])], POLYGONS.replace("name", "municipality"))
    pts = spark.createDataFrame([(-73.6, 45.5), (-100.0, 40.0)], "lng double, lat double")
    q, r = GRID.axial(F.col("lng"), F.col("lat"), 10)
    cells = pts.select(q.alias("q"), r.alias("r"))
    got = {row["q"] == 0: row["municipality"] for row in tag_cells(cells, boundaries).collect()}
    assert got == {True: "CityA", False: UNKNOWN_MUNICIPALITY}
    again = cells.unionByName(cells).unionByName(spark.createDataFrame([(None, None)], "q int, r int"))
    counts = {row["municipality"]: row["count"] for row in tag_rows(again, boundaries).groupBy("municipality").count().collect()}
    assert counts == {"CityA": 2, UNKNOWN_MUNICIPALITY: 3}


def scored(spark, rows):
    """rows: (q, r, municipality, n_addresses, livability)"""
    df = spark.createDataFrame(rows, "q int, r int, municipality string, n_addresses long, livability double")
    return df.select("*", *[F.col("livability").alias(f"score_{c}") for c in CATEGORIES])


def test_weighted_mean_and_table(spark):
    out = rollup.address_weighted(scored(spark, [(0, 0, "A", 1, 100.0), (0, 1, "A", 3, 0.0)]), "municipality").first()
    assert out["addresses"] == 4 and out["livability"] == pytest.approx(25)
    table = rollup.municipality_table(
        scored(spark, [(0, 0, "A", 1, 80.0), (0, 1, "B", 1, 90.0), (1, 1, UNKNOWN_MUNICIPALITY, 1, 100.0), (2, 1, None, 1, 1.0)])
    )
    assert [r["municipality"] for r in table.collect()] == ["B", "A"]


def test_dominant_ties_nulls_and_empty(spark):
    df = spark.createDataFrame(
        [(1, "A"), (1, "A"), (1, "B"), (2, "B"), (2, "A"), (3, None), (4, None), (4, None), (4, "C")], "g int, m string"
    )
    got = {r["g"]: r["m"] for r in rollup.dominant(df, ["g"], "m").collect()}
    assert got == {1: "A", 2: "A", 3: UNKNOWN_MUNICIPALITY, 4: "C"}


def test_rollup_merges_children_of_one_parent(spark):
    out = rollup.hex_rollup(scored(spark, [(0, 0, "A", 1, 50.0), (1, 0, "A", 1, 50.0)])).collect()
    assert len(out) == 1 and out[0]["municipality"] == "A" and len(out[0]["outline"]) == 6 and out[0]["addresses"] == 2


def test_ranks_are_distinct_in_ties_and_across_slices(spark):
    table = spark.createDataFrame(
        [("c", 50.0), ("a", 50.0), ("b", 50.004), ("d", 99.0), ("e", 0.0), ("f", None)], "municipality string, livability double"
    )
    got = [r["municipality"] for r in rollup.with_rank(table).orderBy("rank").collect()]
    assert got == ["d", "b", "a", "c", "e", "f"]
    assert sorted(r["rank"] for r in rollup.with_rank(table).collect()) == [1, 2, 3, 4, 5, 6]


def test_category_share_shows_absent_categories(spark):
    df = spark.createDataFrame([("park",), ("park",), ("bike",), ("museum",)], "category string")
    got = [(r["category"], r["count"], r["share"]) for r in rollup.category_share(df).collect()]
    assert got[:2] == [("park", 2, 66.7), ("bike", 1, 33.3)] and len(got) == 6
    empty = rollup.category_share(df.filter("false")).collect()
    assert {r["share"] for r in empty} == {0.0}


@pytest.mark.parametrize("sample", [[5], [1, 2], [3, 3, 9], [1, 1, 1, 8], [4, 1, 9, 9, 2, 7]])
def test_median_from_histogram(spark, sample):
    import statistics

    counts = spark.createDataFrame([("g", v) for v in sample], "g string, v long").groupBy("g", "v").agg(F.count("*").alias("n"))
    assert bucketed_median(counts, "g", "v", "n").first()["median"] == statistics.median(sample)


def test_poi_elements(spark):
    schema = (
        "type string, id long, lon double, lat double, center struct<lon: double, lat: double>, tags map<string,string>, position int"
    )
    rows = [
        ("node", 1, -73.5, 45.5, None, {"shop": "supermarket", "name": "A"}, 0),
        ("node", 1, -73.5, 45.5, None, {"shop": "supermarket", "name": "B"}, 1),
        ("node", 2, -73.6, 45.6, None, {"amenity": "bench"}, 2),
        ("way", 3, None, None, None, {"amenity": "school"}, 3),
        ("way", 4, None, None, (-73.7, 45.7), {"amenity": "school", "shop": "hats"}, 4),
        ("way", 5, -73.7, None, (-73.8, 45.8), {"amenity": "clinic", "shop": "bakery"}, 5),
        ("way", 6, -73.7, 45.1, None, None, 6),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r["osm_id"]: r for r in am.poi_points(df).collect()}
    assert sorted(got) == [1, 4, 5]
    assert got[1]["name"] == "A" and got[4]["fclass"] == "school" and (got[4]["lng"], got[4]["lat"]) == (-73.7, 45.7)
    assert got[5]["fclass"] == "bakery" and got[5]["lng"] == -73.8  # shop before amenity; half a coordinate is none
    assert am.poi_points(df.filter("false")).count() == 0
    kept = am.categorized_pois(am.poi_points(df).drop("name"))
    assert {r["category"] for r in kept.collect()} == {"grocery", "school"} and "name" in kept.columns
    with pytest.raises(ValueError, match="fclass"):
        am.categorized_pois(df)


def test_amenity_frame_keeps_or_overrides_category(spark):
    df = am.indexed(spark.createDataFrame([("grocery", -73.6, 45.5)], "category string, lng double, lat double"))
    assert am.amenity_frame(df).first()["category"] == "grocery"
    assert am.amenity_frame(df, "transit").first()["category"] == "transit"
    assert am.amenity_frame(df).columns == ["category", "cell_r10", "lat", "lng"]


CONTRACT = Contract(
    schema={"cell": "str", "livability": "numeric"}, unique=("cell",), complete=("cell", "livability"),
    bounds={"livability": (0.0, 100.0)},
)


def verdicts(df, contract=CONTRACT, **kw):
    return {(r["shard"], r["check_name"]): r for r in quality.run_checks(df, contract, "gold/x", **kw).collect()}


def test_checks_pass_and_fail(spark):
    clean = spark.createDataFrame([("a", 10.0), ("b", 90.0)], "cell string, livability double")
    assert all(v["passed"] for v in verdicts(clean).values()) and len(verdicts(clean)) == 4
    high = verdicts(spark.createDataFrame([("a", 10.0), ("b", 150.0)], "cell string, livability double"))
    found = high[None, "value_range"]
    assert not found["passed"] and high[None, "schema_contract"]["passed"]
    assert json.loads(found["metadata"])["violations"] == {"livability": {"below": 0, "above": 1, "min": 10.0, "max": 150.0}}
    dirty = verdicts(spark.createDataFrame([("a", 1.0), ("a", 1.0), (None, float("nan")), (None, 2.0)], "cell string, livability double"))
    unique = dirty[None, "row_uniqueness"]
    assert json.loads(unique["metadata"])["duplicate_rows"] == 2 and unique["severity"] == "ERROR"
    complete = dirty[None, "field_completeness"]
    assert complete["severity"] == "WARN" and json.loads(complete["metadata"])["failing_columns"] == ["cell", "livability"]
    assert json.loads(complete["metadata"])["null_ratios"] == {"cell": 0.5, "livability": 0.25}


def test_checks_of_empty_text_and_missing_columns(spark):
    empty = verdicts(spark.createDataFrame([], "cell string, livability double"))
    assert not empty[None, "field_completeness"]["passed"] and empty[None, "row_uniqueness"]["passed"]
    text = verdicts(spark.createDataFrame([("a", "7"), ("b", "many"), ("c", "-1")], "cell string, livability string"))
    assert not text[None, "schema_contract"]["passed"]
    assert json.loads(text[None, "value_range"]["metadata"])["violations"]["livability"]["below"] == 1
    short = verdicts(spark.createDataFrame([("a",)], "cell string"))
    assert json.loads(short[None, "schema_contract"]["metadata"])["missing_columns"] == ["livability"]
    assert not short[None, "field_completeness"]["passed"]


def test_checks_by_shard_and_geometry_keys(spark):
    df = spark.createDataFrame([("a", 1.0, "s1"), ("a", 1.0, "s2"), ("b", 500.0, "s2")], "cell string, livability double, shard string")
    got = verdicts(df, shard="shard")
    assert got["s1", "value_range"]["passed"] and not got["s2", "value_range"]["passed"]
    assert got["s1", "row_uniqueness"]["passed"] and got["s2", "row_uniqueness"]["passed"]
    parks = spark.createDataFrame([("p", [SQUARE]), ("q", [SQUARE]), ("r", [SQUARE, HOLE])], POLYGONS)
    found = verdicts(parks, CONTRACTS["parks"])[None, "row_uniqueness"]
    assert json.loads(found["metadata"])["duplicate_rows"] == 1


def test_kinds(spark):
    fields = {f.name: f.dataType for f in spark.sql("select 1 as i, true as b, 'x' as s, array(named_struct('lng', 1d, 'lat', 2d)) as g, array(1) as a").schema}
    assert quality.kind_matches(fields["i"], "numeric") and quality.kind_matches(fields["b"], "numeric")
    assert quality.kind_matches(fields["s"], "str") and not quality.kind_matches(fields["i"], "str")
    assert quality.kind_matches(fields["g"], "geometry") and not quality.kind_matches(fields["a"], "geometry")
    with pytest.raises(ValueError):
        quality.kind_matches(fields["i"], "bogus")


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_contracts_are_coherent(name):
    contract = CONTRACTS[name]
    assert {*contract.unique, *contract.complete, *contract.bounds} <= set(contract.schema)


def test_incoherent_contract_is_refused():
    with pytest.raises(ValueError):
        Contract(schema={"a": "str"}, unique=("b",), complete=())
    with pytest.raises(TypeError):
        Contract(schema={"a": "str"}, unique=("a",))


def test_latest_verdicts_and_tally(spark):
    rows = [
        ("p", "c", "a", 1, False, "ERROR"), ("p", "c", "b", 2, True, "ERROR"), ("p", "c", "a", 3, True, "ERROR"),
        ("p", "w", None, 1, True, "WARN"), ("p", "w", None, 2, False, "WARN"), ("p", "e", None, 1, False, "ERROR"),
    ]
    history = spark.createDataFrame(rows, "asset string, check_name string, shard string, run_ts int, passed boolean, severity string")
    latest = quality.latest_verdicts(history)
    assert {(r["check_name"], r["shard"]): r["passed"] for r in latest.collect()} == {
        ("c", "a"): True, ("c", "b"): True, ("w", None): False, ("e", None): False,
    }
    assert quality.verdict_tally(latest).first()["summary"] == "2 ok | 1 warn | 1 fail"
    assert [r["check_name"] for r in quality.error_failures(latest).collect()] == ["e"]
    reused = quality.reused_verdicts(latest, spark.createDataFrame([("p", None)], "asset string, shard string"))
    assert {(r["check_name"], r["reused_snapshot"]) for r in reused.collect()} == {("w", True), ("e", True)}


T = [datetime(2026, 1, d) for d in range(1, 9)]


def test_stale_tables(spark):
    snaps = spark.createDataFrame([("fresh", T[6]), ("old", T[0]), ("old", T[1]), ("edge", T[2])], "asset string, ts timestamp")
    limits = spark.createDataFrame([(a, 5) for a in ("fresh", "old", "edge", "never")], "asset string, max_days int")
    got = {r["asset"]: (r["age_days"], r["stale"]) for r in lg.stale_tables(snaps, limits, F.lit(T[7])).collect()}
    assert got == {"fresh": (1, False), "old": (6, True), "edge": (5, False), "never": (None, True)}


def test_gate_reasons(spark):
    schema = lg.LEDGER_SCHEMA
    row = lambda asset, ts, version, code="1", inputs={"u": "7"}: (asset, None, ts, version, code, inputs, False, None)  # noqa: E731, B006
    ledger = spark.createDataFrame(
        [
            row("hit", T[0], "a", "0"), row("hit", T[1], "b"), row("code", T[0], "a", "0"), row("moved", T[0], "a", inputs={"u": "6"}),
            row("inputs", T[0], "a", inputs=None), row("version", T[0], None), row("orphan", T[0], "a"),
        ],
        schema,
    )
    names = ["hit", "code", "moved", "inputs", "version", "orphan", "new"]
    wanted = spark.createDataFrame([(n, None, "1") for n in names], "asset string, shard string, code_version string")
    ups = spark.createDataFrame([(n, "x" if n == "orphan" else "u") for n in names], "asset string, upstream string")
    versions = spark.createDataFrame([("u", "7")], "asset string, version string")
    got = {r["asset"]: r["miss_reason"] for r in lg.gate(wanted, ledger, ups, versions).collect()}
    assert got == {
        "hit": None, "code": lg.CODE_CHANGED, "moved": lg.UPSTREAM_MOVED, "inputs": lg.NO_INPUTS,
        "version": lg.NO_VERSION, "orphan": lg.UPSTREAM_MISSING, "new": lg.NO_PRIOR,
    }


def test_sharded_version_changes_with_any_shard(spark):
    def version(rows):
        return lg.current_versions(spark.createDataFrame(rows, "asset string, shard string, version string")).first()["version"]

    one = version([("x", "a", "1"), ("x", "b", "1")])
    assert one == version([("x", "b", "1"), ("x", "a", "1")])
    assert one != version([("x", "a", "1"), ("x", "b", "2")]) != version([("x", "a", "1")])
    assert version([("x", None, "9")]) == "9"


def test_reconcile(spark):
    one = spark.createDataFrame([("a",), ("b",)], "shard string")
    two = spark.createDataFrame([("b",), ("c",)], "shard string")
    assert {tuple(r) for r in lg.reconcile(one, two).collect()} == {("a", "drop"), ("b", "keep"), ("c", "add")}


def test_ranks_of_one_value_for_all_are_dealt_to_many_tasks(spark):
    rows = spark.range(5000).select(F.col("id"), F.lit(1.5).alias("v"), F.lit("x").alias("rank"), (F.col("id") % 2).alias("at"))
    rows = rows.unionByName(spark.createDataFrame([(9001, None, "x", 0), (9000, None, "x", 0), (9002, float("nan"), "x", 0)], "id long, v double, rank string, at long"))
    ranked = rollup.with_rank(rows.repartition(3), "v", "id")
    got = {r["id"]: r["rank"] for r in ranked.collect()}
    assert got == {9002: 1, **{i: i + 2 for i in range(5000)}, 9000: 5002, 9001: 5003}
    per_task = ranked.select(F.floor(F.col("rank") / 1).alias("n"), F.spark_partition_id().alias("p")).groupBy("p").count()
    assert per_task.agg(F.max("count")).first()[0] < 5000 / 3


def test_uniqueness_of_geometry_survives_colliding_hashes(spark, monkeypatch):
    """Duplicates by shard, missing geometry and a missing shard among them; the same figures if all keys share one hash."""
    rows = [("a", [SQUARE]), ("a", [SQUARE]), ("a", [HOLE]), ("b", [SQUARE]), ("b", None), ("b", None), (None, [HOLE]), (None, [HOLE]), (None, [HOLE]), ("c", [SQUARE])]
    df = spark.createDataFrame(rows, POLYGONS.replace("name", "shard"))
    contract = Contract(schema={"rings": "geometry"}, unique=("rings",), complete=("rings",))
    plan = quality.check_rows(df, contract)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_key" in plan and "hashpartitioning(rings" not in plan  # 8 bytes a row, not the geometry
    for collide in (False, True):
        if collide:
            monkeypatch.setattr(quality, "key_hash", lambda *columns: F.lit(7).cast("long"))
        by_shard = {r["shard"]: (r["total_rows"], r["duplicate_rows"], r["null_rings"]) for r in quality.check_rows(df, contract, "shard").collect()}
        assert by_shard == {"a": (3, 1, 0), "b": (3, 1, 2), None: (3, 2, 0), "c": (1, 0, 0)}
        whole = quality.check_rows(df, contract).first()
        assert (whole["total_rows"], whole["duplicate_rows"], whole["null_rings"]) == (10, 7, 2)
        assert tuple(quality.check_rows(df.limit(0), contract).select("total_rows", "duplicate_rows").first()) == (0, 0)
