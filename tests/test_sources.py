import json
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from walkgrid import fixtures as fx
from walkgrid.operators.amenities import poi_points
from walkgrid.plans.contracts import CONTRACTS
from walkgrid.plans.pipeline import Run, Settings, raw_table
from walkgrid.session import materialize, shared_dir
from walkgrid.sources import files
from walkgrid.sources.sql import SQL, configure, data, query
from walkgrid.sources.store import SnapshotStore, format_size, now_stamp, parse_stamp, preview, stamp_of


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "lake"))


def test_stamps(spark):
    stamp = now_stamp()
    assert re.fullmatch(r"\d{8}T\d{6}_\d{6}Z", stamp)
    df = spark.createDataFrame([("20260102T030405_060708Z",)], "s string")
    assert df.select(parse_stamp(F.col("s"))).first()[0] == datetime(2026, 1, 2, 3, 4, 5, 60708)
    assert df.select(stamp_of(F.concat(F.lit("x/stamp="), "s", F.lit("/part-0.parquet")))).first()[0] == "20260102T030405_060708Z"
    assert spark.range(1).select(format_size(F.lit(1024 * 1024))).first()[0] == "1.00 MB"


def test_preview_drops_geometry(spark):
    df = spark.sql("select 'x' as name, array(named_struct('lng', 1d, 'lat', 2d)) as geometry from range(9)")
    assert preview(df).columns == ["name"] and preview(df).count() == 5


def test_missing_snapshot(store):
    with pytest.raises(FileNotFoundError):
        store.read("bronze/nothing")
    assert store.latest_stamp("bronze/nothing") is None


def test_latest_wins_and_empty_advances(spark, store):
    first = store.write(spark.range(3), "bronze/t")
    assert store.read("bronze/t").count() == 3
    second = store.write(spark.range(0), "bronze/t")
    assert second > first and store.latest_stamp("bronze/t") == second
    assert store.read("bronze/t").count() == 0 and store.read("bronze/t").columns == ["id"]
    rows = {r["stamp"]: r["rows"] for r in store.snapshot_metadata("bronze/t").collect()}
    assert rows == {first: 3, second: 0}


def test_shards_come_and_go(spark, store):
    def table(*pairs):
        return spark.createDataFrame(list(pairs), "s string, v int")

    def read(**kw):
        return sorted(tuple(r) for r in store.read("silver/t", **kw).collect())

    store.write_sharded(table(("6:1:2", 1), ("6:1:2", 2), ("b", 3)), "silver/t", "s")
    assert read() == [("6:1:2", 1), ("6:1:2", 2), ("b", 3)] and read(shard="b") == [("b", 3)]
    store.write(table(("6:1:2", 1), ("b", 9)), "silver/t", "s", "b")  # keeps only the asked shard's rows
    assert read() == [("6:1:2", 1), ("6:1:2", 2), ("b", 9)] and read(shard="b") == [("b", 9)]
    store.drop_shards("silver/t", spark.createDataFrame([("b",)], "shard string"), "s")
    assert read() == [("6:1:2", 1), ("6:1:2", 2)]
    store.write_sharded(table(("c", 5)), "silver/t", "s")  # whole write: stale shards vanish
    assert read() == [("c", 5)]
    store.write_sharded(table(), "silver/t", "s")
    assert read() == []
    with pytest.raises(ValueError, match="available"):
        store.write_sharded(spark.range(1), "silver/t", "s")
    with pytest.raises(ValueError):
        store.write(table(("c", 5)), "silver/t", shard="c")


def test_one_shard_read_prunes_partitions(spark, store):
    df = spark.range(100).select((F.col("id") % 5).cast("string").alias("s"), "id")
    store.write_sharded(df, "silver/p", "s")
    plan = store.read("silver/p", "3")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*s#", plan)


def test_readers(spark, tmp_path):
    square = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    features = [
        ("Polygon", [square], "A"), ("MultiPolygon", [[square], [square, square]], "B"), ("Point", [1, 2], "C"),
    ]
    body = [
        {"type": "Feature", "properties": {"NOM": n, "TYPE": "x"}, "geometry": {"type": k, "coordinates": c}}
        for k, c, n in features
    ]
    doc = tmp_path / "doc.geojson"
    doc.write_text(json.dumps({"type": "FeatureCollection", "features": body}, indent=1))
    lines = tmp_path / "lines.geojson"
    lines.write_text("\n".join(json.dumps(f) for f in body))
    for path, multi in ((doc, True), (lines, False)):
        df = files.read_features(spark, str(path), "polygon", files.BOUNDARY_PROPERTIES, multiline=multi)
        got = {r["NOM"]: r["rings"] for r in df.collect()}
        assert len(got["A"]) == 1 and len(got["B"]) == 3 and got["C"] is None
        assert got["A"][0][2]["lng"] == 2.0
    point = files.read_features(spark, str(lines), "point", "NOM string").filter("lng is not null").first()
    assert tuple(point) == ("C", 1.0, 2.0)
    with pytest.raises(ValueError):
        files.read_features(spark, str(lines), "surface")

    paths = tmp_path / "paths.json"
    paths.write_text(
        '{"properties":{"ID_CYCL":1},"geometry":{"type":"LineString","coordinates":[[-8190000,5690000],[-8190001,5690000]]}}\n'
        '{"properties":{"ID_CYCL":2},"geometry":{"type":"MultiLineString","coordinates":[[[0,0],[1,1]],[[2,2],[3,3]]]}}'
    )
    df = files.read_features(spark, str(paths), "line", files.BIKE_PATH_PROPERTIES, srid=3857)
    got = {r["ID_CYCL"]: r["parts"] for r in df.collect()}
    assert got[1][0][0]["lng"] == pytest.approx(-73.572, abs=1e-3) and len(got[2]) == 2

    stops = tmp_path / "stops.txt"
    stops.write_text("stop_name,stop_lon,stop_id,stop_lat\nx,-73.6,007,45.5\n")
    assert tuple(files.read_stops(spark, str(stops)).select("stop_id", "lng", "lat").first()) == ("007", -73.6, 45.5)

    elements = [{"type": "node", "id": 1, "lon": -73.5, "lat": 45.5, "tags": {"shop": "bakery"}}] * 2
    (tmp_path / "e.json").write_text(json.dumps({"elements": elements}))
    (tmp_path / "n.json").write_text("\n".join(json.dumps(e) for e in elements))
    assert poi_points(files.read_elements(spark, str(tmp_path / "e.json"), multiline=True)).count() == 1
    assert poi_points(files.read_elements(spark, str(tmp_path / "n.json"))).count() == 1


def test_read_data_formats(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.pq"))
    assert files.read_data(spark, str(tmp_path / "t.pq")).count() == 3
    assert files.read_data(spark, str(tmp_path / "t.pq"), "parquet").count() == 3
    with pytest.raises(ValueError, match="xlsx"):
        files.read_data(spark, "t.xlsx")
    assert query(spark, SQL("select count(*) as n from $t", t=data(spark, str(tmp_path / "t.pq")))).first()["n"] == 3


def test_sql_fragments(spark):
    inner = SQL("select id, $word as word from $rows where id >= $low", rows=spark.range(5), low=2, word="it's {x}")
    out = query(spark, SQL("select word, count(*) as n, $no as nothing, $yes as yes from $inner group by word", inner=inner, no=None, yes=True))
    assert tuple(out.first()) == ("it's {x}", 3, None, True)
    assert query(spark, "select '$unbound' as x").first()["x"] == "$unbound"
    with pytest.raises(ValueError, match="bad"):
        SQL("select $bad", bad=[1])


def test_configure(spark):
    configure(spark, ["set walkgrid.test = 5"], s3_region="ca-central-1", s3_access_key="k")
    assert spark.conf.get("walkgrid.test") == "5"
    assert spark.conf.get("fs.s3a.endpoint.region") == "ca-central-1"
    assert spark.conf.get("fs.s3a.access.key", None) is None  # half a credential is none


def test_shared_folder_is_the_named_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    df = materialize(spark.range(4), "t")
    assert shared_dir(spark) in df.inputFiles()[0] and df.count() == 4


def _raw(sf_dir, only=lambda df: df):
    def addresses(spark):
        kinds = {"str": "string", "numeric": "long"}
        given = {"ID_UEV": F.col("id").cast("string"), "lng": F.col("lng"), "lat": F.col("lat")}
        schema = CONTRACTS["addresses"].schema
        df = only(fx.addresses(spark, sf_dir))
        return df.select(*[given.get(c, F.lit(None).cast(kinds[k])).alias(c) for c, k in schema.items()])

    return [
        raw_table("addresses", "units", addresses),
        raw_table("pois", "points of interest", lambda s: poi_points(fx.elements(s, sf_dir))),
        raw_table("transit_stops", "stops", lambda s: fx.stops(s, sf_dir).select(
            "stop_id", F.col("stop_lon").alias("lng"), F.col("stop_lat").alias("lat"))),
        raw_table("bike_paths", "paths", lambda s: fx.paths(s, sf_dir).select(F.col("path_id").alias("ID_CYCL"), "parts")),
        raw_table("parks", "parks", lambda s: fx.parks(s, sf_dir).select("rings")),
        raw_table("municipality_boundaries", "boundaries", lambda s: fx.boundaries(s, sf_dir)),
    ]


def test_raw_tables_are_fetched_again_only_when_too_old(spark, store):
    fetched = []
    table = raw_table("parks", "parks", lambda s: fetched.append(1) or s.createDataFrame([], "rings array<array<struct<lng: double, lat: double>>>"))
    for days in (0, 24, 26):
        run = Run(store, [table], now=datetime.now() + timedelta(days=days))
        run._whole(table)
        assert run.results["parks"] is (days == 24)
    assert len(fetched) == 2
    with pytest.raises(ValueError, match="maximum age"):
        raw_table("amenities", "x", lambda s: None)


def test_pipeline_rebuilds_what_moved_and_nothing_else(spark, store, sf_dir):
    first = Run(store, _raw(sf_dir)).run()
    assert not any(first.values())
    addresses, distances = "silver/cell_addresses", "silver/distances"
    n_scores = store.read("gold/livability_score").count()
    assert n_scores > 0

    again = Run(store, _raw(sf_dir))
    assert all(again.run().values())
    repeated = again.verdicts().filter("reused_snapshot")
    assert repeated.filter("asset = 'bronze/addresses' and check_name = 'field_completeness' and not passed").count() == 1
    assert again.verdicts().filter("asset = 'silver/distances'").select("shard").distinct().count() > 1

    before = {r["shard"]: r["stamp"] for r in store.shards(distances).collect()}
    moved, gone = sorted(before)[:2]
    old = store.read(addresses, moved)
    store.write(old, addresses, "cell_r6", moved)
    store.drop_shards(addresses, spark.createDataFrame([(gone,)], "shard string"), "cell_r6")
    third = Run(store, _raw(sf_dir), Settings(weights={"bike": 3.0}))
    fresh = [n for n, reused in third.run().items() if not reused]
    assert fresh == ["distances", "livability_score"]
    after = {r["shard"]: r["stamp"] for r in store.shards(distances).collect()}
    assert set(after) == set(before) - {gone}
    assert [s for s in after if after[s] != before[s]] == [moved]
    assert third.read("distances").filter(F.col("cell_r6") == moved).count() == old.count()
    assert third.read("livability_score").count() < n_scores
    profile = {r["category"]: r for r in third.distance_profile().collect()}  # from sketches: of the replaced shard the new one
    values = third.read("distances")
    for c in ("grocery", "bike"):
        found = [r[0] for r in values.select(f"dist_{c}").collect() if r[0] is not None]
        assert (profile[c]["resolved"], profile[c]["total"]) == (len(found), values.count())
        below, upto = (sum(f(v, profile[c]["median"]) for v in found) / len(found) for f in (lambda a, b: a < b, lambda a, b: a <= b))
        assert below - 0.005 <= 0.5 <= upto + 0.005
    assert all("/profiles/" in f or "/log/" in f for f in third.distance_profile().inputFiles())
    assert spark.read.text(f"{store.root}/reports/hexes").count() > 0


def test_a_crash_before_publishing_leaves_the_old_version(spark, store, monkeypatch):
    table = raw_table("parks", "parks", lambda s: s.createDataFrame([([[(float(len(made)), 0.0)]],)], "rings array<array<struct<lng: double, lat: double>>>"))
    made = [1]
    run = Run(store, [table], derived=[])
    run.run()
    old = store.latest_stamp("bronze/parks")
    made.append(2)
    later = Run(store, [table], derived=[], now=datetime.now() + timedelta(days=30))
    for step in ("publish", "staged"):  # after the checks, and before them
        with monkeypatch.context() as broken:
            broken.setattr(SnapshotStore, step, lambda *_: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                later.run()
        assert store.latest_stamp("bronze/parks") == old and store.read("bronze/parks").first()["rings"][0][0]["lng"] == 1.0
        assert later.verdicts().select("version").distinct().count() == 1 and later.ledger().count() == 1
    assert later.run() == {"parks": False}
    assert store.latest_stamp("bronze/parks") > old and store.read("bronze/parks").first()["rings"][0][0]["lng"] == 2.0
    meta = [json.loads(r["metadata"]) for r in later.ledger().orderBy("version").collect()]
    assert [m["rows"] for m in meta] == [1, 1] and meta[0]["verdicts"] == "3 ok | 0 warn | 0 fail" and list(meta[0]["columns"]) == ["rings"]
    assert {r["version"] for r in later.verdicts().collect()} == {old, store.latest_stamp("bronze/parks")}
    reports = spark.read.json(f"{store.root}/reports/quality")
    assert reports.select("run").distinct().count() == 2 and not later.failures().count()


def test_reads_open_one_version_of_the_log(spark, store):
    table = lambda *rows: spark.createDataFrame(rows, "s string, x int")
    store.write_sharded(table(("a", 1), ("b", 2), (None, 3)), "silver/t", "s")
    for i in range(6):
        store.write(table(("a", 10 + i)), "silver/t", "s", "a")
    assert store.registry("silver/t").count() == 4 and store.log("silver/t").count() == 28
    assert sorted((r["s"], r["x"]) for r in store.read("silver/t").collect() if r["s"]) == [("a", 15), ("b", 2)]
    assert [r["x"] for r in store.read("silver/t", "").collect()] == [3]
    sizes = store.snapshot_metadata("silver/t")
    assert sizes.count() == 7 and sizes.filter("bytes > 0").count() == 7
    assert json.loads(sizes.orderBy("stamp").first()["metadata"])["nulls"] == {"s": 1}
