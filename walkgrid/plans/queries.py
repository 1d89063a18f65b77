"""Registered queries: every operator over the given tables, as (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from walkgrid import fixtures as fx
from walkgrid.constants import CATEGORIES, DIST_COLUMNS, POI_BBOX, SCORE_COLUMNS
from walkgrid.functions.geo import M_PER_DEG, haversine, to_wgs84
from walkgrid.functions.grid import DEFAULT_GRID as GRID
from walkgrid.functions.grid import RegionGrid, around_cells, cell_id, hex_distance
from walkgrid.functions.projection import system
from walkgrid.functions.score import custom_blend, distance_score, score_color
from walkgrid.operators import amenities as am
from walkgrid.operators import quality, rollup
from walkgrid.operators import scores as sc
from walkgrid.operators.nearest import nearest
from walkgrid.operators.polygons import tag_cells, tag_rows, with_containing_polygon, with_representative_point
from walkgrid.plans import ledger as lg
from walkgrid.plans import report
from walkgrid.plans.contracts import CONTRACTS, Contract
from walkgrid.plans.personal import Anchor, personal_scores, top_cells
from walkgrid.plans.pipeline import Run, derived_tables, raw_table
from walkgrid.session import materialize, scratch_path
from walkgrid.sources import files
from walkgrid.sources.sql import SQL, configure, query
from walkgrid.sources.store import SnapshotStore, parse_stamp, stamp_of

CUSTOM_WEIGHTS = {"grocery": 0.5, "transit": 0.3, "park": 0.0, "bike": 0.1, "school": 0.05, "health": 0.3}
PROJECTED = (2950, 32618)
CHOSEN = ("grocery", "park", "bike")
ANCHORS = (
    Anchor("work", 45.505, -73.57, 0.5, "transit"),
    Anchor("gym", 45.47, -73.64, 0.25, "biking"),
)
DIRTY = Contract(
    schema={"k": "numeric", "ln": "numeric", "score": "numeric"},
    unique=("k", "ln"), complete=("k", "score"), bounds={"score": (0.0, 100.0)},
)


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def _cell(res: int = 10, q: str = "q", r: str = "r"):
    return cell_id(res, F.col(q), F.col(r))


def _address_cells(spark: SparkSession, sf: str) -> DataFrame:
    return sc.with_cell(fx.addresses(spark, sf)).select("q", "r").dropna().distinct()


def cell_index(spark, sf):
    return sc.with_cell(fx.addresses(spark, sf)).select("id", _cell().alias("cell"))


def cell_parent(spark, sf):
    cells = am.with_parent(_address_cells(spark, sf), 10, 9, ("q9", "r9"))
    cells = am.with_parent(cells, 10, 6, ("q6", "r6"))
    return cells.select(
        _cell().alias("cell"), _cell(9, "q9", "r9").alias("parent_r9"), _cell(6, "q6", "r6").alias("parent_r6")
    )


def cell_center(spark, sf):
    lng, lat = GRID.center(F.col("q"), F.col("r"), 10)
    return _address_cells(spark, sf).select(
        _cell().alias("cell"), F.round(lat, 6).alias("lat"), F.round(lng, 6).alias("lng")
    )


def cell_outline(spark, sf):
    corners = _address_cells(spark, sf).select(
        _cell().alias("cell"), F.posexplode(GRID.outline(F.col("q"), F.col("r"), 10)).alias("corner", "p")
    )
    return corners.select("cell", "corner", F.round("p.lng", 6).alias("lng"), F.round("p.lat", 6).alias("lat"))


def ring_cells(spark, sf):
    ring = around_cells(_address_cells(spark, sf).select("q", "r"), "q", "r", 0, 10, ("nq", "nr"))
    k = hex_distance(F.col("q"), F.col("r"), F.col("nq"), F.col("nr")).alias("k")
    sums = ring.select("q", "r", k, "nq", "nr").groupBy("q", "r", "k").agg(
        F.count("*").alias("n_cells"),
        F.sum(F.col("nq") * 1009 + F.col("nr")).alias("checksum"),
        F.sum(F.col("nq").cast("long") * F.col("nr")).alias("product_sum"),
    )
    return sums.select(_cell().alias("cell"), "k", "n_cells", "checksum", "product_sum")


def line_trace(spark, sf):
    traced = am.traced_lines(fx.paths(spark, sf), "path_id")
    return traced.select("path_id", _cell().alias("cell"))


def line_cells(spark, sf):
    cells = am.line_cells(am.traced_lines(fx.paths(spark, sf), "path_id"))
    return rounded(cells, 6, "lat", "lng")


def polygon_point(spark, sf):
    points = am.indexed(with_representative_point(fx.parks(spark, sf)))
    return rounded(points.select("park_id", "lng", "lat", F.col("cell_r10").alias("cell")), 6, "lng", "lat")


def mercator_to_wgs84(spark, sf):
    placed = fx.addresses(spark, sf).select(
        "id",
        (F.col("lng") * M_PER_DEG).alias("x"),
        (F.log(F.tan(F.radians(F.col("lat") / 2 + 45))) * 6378137.0).alias("y"),
    )
    lng, lat = to_wgs84(F.col("x"), F.col("y"), 3857)
    return placed.select("id", F.round(lng, 6).alias("lng"), F.round(lat, 6).alias("lat"))


def projected_to_wgs84(spark, sf):
    """Addresses as landed in two projected systems: even ids in a three-degree zone, odd ids in a UTM zone; and back."""
    found = []
    for parity, srid in enumerate(PROJECTED):
        placed = fx.addresses(spark, sf).filter(F.col("id") % 2 == parity)
        x, y = system(srid).project(F.col("lng"), F.col("lat"))
        landed = placed.select("id", F.lit(srid).alias("srid"), x.alias("x"), y.alias("y"))
        lng, lat = to_wgs84(F.col("x"), F.col("y"), srid)
        found.append(landed.select("id", "srid", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"), F.round(lng, 6).alias("lng"), F.round(lat, 6).alias("lat")))
    return found[0].unionByName(found[1])


def haversine_pairs(spark, sf):
    a = fx.addresses(spark, sf).select("id", F.col("lat").alias("lat1"), F.col("lng").alias("lng1"))
    b = fx.amenities(spark, sf).select(F.col("pid").alias("id"), F.col("lat").alias("lat2"), F.col("lng").alias("lng2"))
    metres = haversine(F.col("lng1"), F.col("lat1"), F.col("lng2"), F.col("lat2"))
    # every amenity once: addresses are met round by round, and both tables count from 1
    most = a.agg(F.max("id").alias("n"))  # one row
    home = (F.col("id") - 1) % F.col("n") + 1
    pairs = b.join(F.broadcast(most)).withColumn("home", home).join(a.withColumnRenamed("id", "home"), "home")
    return pairs.select("id", F.round(metres, 2).alias("metres"))


def _distances(spark, sf, mode="exact"):
    return nearest(fx.addresses(spark, sf), fx.amenities(spark, sf), mode=mode)


def nearest_exact(spark, sf):
    return rounded(_distances(spark, sf).select("id", *DIST_COLUMNS), 2, *DIST_COLUMNS)


def nearest_edges(spark, sf):
    """The same join on the other side of the world: even ids straddle the 180th meridian, odd ids lie around the pole."""

    def moved(df, key):
        odd = F.col(key) % 2 == 1
        east = F.col("lng") + 73.625 + 180
        lng = F.when(odd, (F.col("lng") + 73.70) * 2400 - 180).otherwise(F.when(east > 180, east - 360).otherwise(east))
        return df.withColumns({"lng": lng, "lat": F.when(odd, 90 - (F.col("lat") - 45.45)).otherwise(F.col("lat"))})

    found = nearest(moved(fx.addresses(spark, sf), "id"), moved(fx.amenities(spark, sf), "pid"))
    return rounded(found.select("id", *DIST_COLUMNS), 2, *DIST_COLUMNS)


def nearest_first_ring(spark, sf):
    return rounded(_distances(spark, sf, "first_ring").select("id", *DIST_COLUMNS), 2, *DIST_COLUMNS)


def distance_profile(spark, sf):
    return rounded(sc.distance_profile(_distances(spark, sf)), 3, "median_m")


def _rank_of(values: DataFrame, profile: DataFrame) -> DataFrame:
    """Exact share of values below and not above the profile's median, by category."""
    both = values.join(F.broadcast(profile.select("category", "median")), "category")
    return both.groupBy("category").agg(F.avg((F.col("value") < F.col("median")).cast("double")).alias("below"), F.avg((F.col("value") <= F.col("median")).cast("double")).alias("upto"))


def profile_after_move(spark, sf):
    """The profile of all shards after one shard's distances have changed, from the others' kept sketches and that shard's new one;
    its median's rank among all values is held against the stated error."""
    shard = F.pmod(F.col("id"), F.lit(27)).cast("string")
    distances = _distances(spark, sf).filter("lat is not null").withColumn("shard", shard)
    distances = materialize(distances, "profile-distances")
    moved = distances.filter("shard = '3'").withColumns({c: F.col(c) * 2 + 5 for c in DIST_COLUMNS})
    kept = materialize(sc.shard_profiles(distances, F.col("shard")), "profiles").filter("shard != '3'")
    profile = materialize(sc.merged_profile(kept.unionByName(sc.shard_profiles(moved, F.col("shard")))), "profile")
    now = distances.filter("shard != '3'").unionByName(moved)
    values = now.select(F.explode(F.array(*[F.struct(F.lit(c).alias("category"), F.col(f"dist_{c}").alias("value")) for c in CATEGORIES])).alias("x")).select("x.*").dropna()
    ranks = _rank_of(values, profile)
    near = (F.col("below") <= 0.5 + sc.RANK_ERROR) & (F.col("upto") >= 0.5 - sc.RANK_ERROR)
    return profile.join(ranks, "category").select("category", "resolved", "total", F.round("mean", 2).alias("mean_m"), near.alias("median_within_error"))


def distance_scores(spark, sf):
    scored = _distances(spark, sf).select(
        "id", *[distance_score(F.col(f"dist_{c}")).alias(f"score_{c}") for c in CATEGORIES]
    )
    return rounded(scored, 4, *SCORE_COLUMNS)


def _livability(spark, sf, weights=None):
    boundaries = am.municipalities(fx.boundaries(spark, sf))
    return sc.livability(sc.with_cell(_distances(spark, sf)), boundaries, weights)


def cell_scores(spark, sf):
    scores = sc.cell_scores(sc.with_cell(_distances(spark, sf)))
    return rounded(scores.select(_cell().alias("cell"), "n_addresses", *SCORE_COLUMNS), 4, *SCORE_COLUMNS)


def livability(spark, sf):
    out = _livability(spark, sf).select(_cell().alias("cell"), "n_addresses", "municipality", *SCORE_COLUMNS, "livability")
    return rounded(out, 4, *SCORE_COLUMNS, "livability")


def livability_custom_weights(spark, sf):
    out = _livability(spark, sf, CUSTOM_WEIGHTS).select(_cell().alias("cell"), "municipality", "livability")
    return rounded(out, 4, "livability")


def custom_blends(spark, sf):
    scores = _livability(spark, sf)
    return scores.select(_cell().alias("cell"), F.round(custom_blend(CHOSEN), 4).alias("blend"))


def score_colors(spark, sf):
    """Colours of the account balances as scores: values below 0, above 100 and in between."""
    customers = fx.table(spark, sf, "customer")
    return customers.select(
        F.col("c_custkey").alias("id"), score_color(F.col("c_acctbal") / 80.0).alias("color")
    )


def _region_addresses(spark, sf):
    return fx.in_regions(fx.addresses(spark, sf), "id", spark, sf)


def region_cells(spark, sf):
    """Two cities in one table: cells of equal numbers in both, told apart by region; parents, centres and a corner of the outline."""
    grid = RegionGrid(fx.regions(spark, sf))
    cells = sc.with_cell(_region_addresses(spark, sf), grid=grid).select("region", "q", "r").dropna().distinct()
    cells = grid.attach(am.with_parent(am.with_parent(cells, 10, 9, ("q9", "r9"), grid), 10, 6, ("q6", "r6"), grid))
    lng, lat = grid.center(F.col("q"), F.col("r"), 10)
    corner = F.get(grid.outline(F.col("q"), F.col("r"), 10), 2)
    ids = [cell_id(res, F.col(q), F.col(r), F.col("region")).alias(name) for res, q, r, name in ((10, "q", "r", "cell"), (9, "q9", "r9", "parent_r9"), (6, "q6", "r6", "parent_r6"))]
    places = {"lng": lng, "lat": lat, "corner_lng": corner["lng"], "corner_lat": corner["lat"]}
    return cells.select(*ids, *[F.round(c, 6).alias(n) for n, c in places.items()])


def _region_livability(spark, sf, mode="exact"):
    grid = RegionGrid(fx.regions(spark, sf))
    amenities = fx.in_regions(fx.amenities(spark, sf), "pid", spark, sf)
    distances = nearest(_region_addresses(spark, sf), amenities, mode=mode, grid=grid)
    return sc.livability(sc.with_cell(distances, grid=grid), am.municipalities(fx.region_boundaries(spark, sf)), grid=grid), grid


def region_livability(spark, sf):
    scores, _ = _region_livability(spark, sf)
    own = cell_id(10, F.col("q"), F.col("r"), F.col("region"))
    return rounded(scores.select("region", own.alias("cell"), "n_addresses", "municipality", *SCORE_COLUMNS, "livability"), 4, *SCORE_COLUMNS, "livability")


def region_rollup(spark, sf):
    scores, grid = _region_livability(spark, sf)
    hexes = rollup.hex_rollup(scores, grid=grid).drop("q", "r", "outline")
    return rounded(hexes, 4, *rollup.VALUE_COLUMNS)


def score_profile(spark, sf):
    return rounded(sc.score_profile(_livability(spark, sf)), 4, "mean_score")


def score_metadata(spark, sf):
    return sc.score_metadata(_livability(spark, sf))


def tag_municipality(spark, sf):
    tagged = tag_cells(_address_cells(spark, sf), am.municipalities(fx.boundaries(spark, sf)))
    return tagged.select(_cell().alias("cell"), "municipality")


def tag_zones(spark, sf):
    """Sites by city-sized boundaries and zones of up to 20 degrees at once."""
    boundaries = am.municipalities(fx.boundaries(spark, sf)).select(F.col("municipality").alias("name"), "rings")
    found = with_containing_polygon(fx.sites(spark, sf), boundaries.unionByName(fx.zones(spark, sf)), "name")
    return found.select("id", "name")


def address_municipality(spark, sf):
    """Every address with the municipality of its cell, those without a position too."""
    rows = sc.with_cell(fx.addresses(spark, sf))
    return tag_rows(rows, am.municipalities(fx.boundaries(spark, sf))).select("id", "municipality")


def hex_rollup(spark, sf):
    hexes = rollup.hex_rollup(_livability(spark, sf)).drop("q", "r", "outline")
    return rounded(hexes, 4, *rollup.VALUE_COLUMNS)


def dominant_municipality(spark, sf):
    """Most frequent nation name among the customers of each market segment."""
    customers = fx.table(spark, sf, "customer").join(
        fx.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return rollup.dominant(customers, ["c_mktsegment"], "n_name").select(
        F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("municipality")
    )


def municipality_table(spark, sf):
    return rounded(rollup.municipality_table(_livability(spark, sf)), 4, *rollup.VALUE_COLUMNS)


def _ranking(spark, sf):
    table = rollup.municipality_table(_livability(spark, sf))
    return rollup.municipality_ranking(materialize(table, "municipality-table"))


def municipality_ranking(spark, sf):
    return _ranking(spark, sf)


def customer_ranks(spark, sf):
    """All customers by balance, in whole thousands so that many are equal, and all of them once more by one value for all."""
    customers = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.floor(F.col("c_acctbal") / 1000).alias("thousands"), F.lit(0).alias("zero"))
    ranks = [rollup.with_rank(customers, value, "id").select("id", F.lit(value).alias("by"), "rank") for value in ("thousands", "zero")]
    return ranks[0].unionByName(ranks[1])


def ranked_boundaries(spark, sf):
    features = report.boundary_features(am.municipalities(fx.boundaries(spark, sf)))
    ranked = report.ranked_boundaries(_ranking(spark, sf), features)
    corner = F.from_json("feature", "geometry struct<coordinates: array<array<array<double>>>>")["geometry"]["coordinates"]
    return ranked.select(
        "rank", "municipality_key", corner[0][0][0].alias("first_lng"), corner[0][0][1].alias("first_lat"),
        F.size(corner[0]).cast("long").alias("n_vertices"),
    )


def global_stats(spark, sf):
    stats = rollup.global_stats(_livability(spark, sf), fx.amenities(spark, sf))
    return rounded(stats, 4, "mean_livability")


def category_share(spark, sf):
    return rollup.category_share(fx.amenities(spark, sf))


def map_center(spark, sf):
    parents = am.with_parent(_address_cells(spark, sf), 10, 9)
    hexes = parents.select(F.col("pq").alias("q"), F.col("pr").alias("r")).distinct()
    return rounded(rollup.map_center(hexes), 6, "lat", "lng")


def _poi_points(spark, sf, bbox=None):
    """Elements as JSON lines, parsed and classified."""
    return am.poi_points(files.parse_elements(_element_lines(spark, sf), "value", "position"), bbox)


def _stop_points(spark, sf):
    return fx.stops(spark, sf).select("stop_id", F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lng"))


def poi_elements(spark, sf):
    points = _poi_points(spark, sf).withColumn("category", am.category_of(F.col("fclass")))
    return rounded(points, 6, "lng", "lat")


def poi_bbox(spark, sf):
    """POIs of the southern half of the source box, which is cut out before anything is shuffled."""
    min_lng, min_lat, max_lng, _ = POI_BBOX
    points = _poi_points(spark, sf, (min_lng, min_lat, max_lng, 45.5))
    return points.groupBy("fclass").agg(F.count("*").alias("n"), F.round(F.max("lat"), 6).alias("max_lat"))


def amenities_union(spark, sf):
    union = am.amenities_union(
        am.categorized_pois(_poi_points(spark, sf)),
        am.indexed(_stop_points(spark, sf)),
        am.indexed_parks(fx.parks(spark, sf)),
        am.traced_lines(fx.paths(spark, sf), "path_id"),
    )
    return rounded(union, 6, "lat", "lng")


def boundary_types(spark, sf):
    return am.municipalities(fx.boundaries(spark, sf)).groupBy("type").agg(
        F.count("*").alias("n"), F.countDistinct("municipality").alias("n_names")
    )


def check_schema(spark, sf):
    """Findings of a contract that asks for a missing column and a wrong kind."""
    df = fx.dirty(spark, sf)
    findings = quality.schema_findings(df, {"k": "str", "score": "numeric", "absent": "numeric"})
    rows = df.agg(F.count("*").alias("total_rows"))
    return rows.select(
        "total_rows",
        F.lit(",".join(findings["missing_columns"])).alias("missing_columns"),
        F.lit(",".join(f"{c}={t}" for c, t in findings["wrong_type"].items())).alias("wrong_type"),
    )


def check_uniqueness(spark, sf):
    return quality.check_rows(fx.dirty(spark, sf), DIRTY).select("total_rows", "duplicate_rows")


def check_completeness(spark, sf):
    figures = quality.check_rows(fx.dirty(spark, sf), DIRTY)
    return figures.select(*[F.round(quality.null_ratio(c), 6).alias(f"ratio_{c}") for c in DIRTY.complete])


def check_range(spark, sf):
    return quality.check_rows(fx.dirty(spark, sf), DIRTY).select("below_score", "above_score", "min_score", "max_score")


def check_bundle_by_shard(spark, sf):
    shards = fx.dirty(spark, sf).withColumn("shard_key", F.col("k") % 27)
    verdicts = quality.run_checks(shards, DIRTY, "silver/dirty", "shard_key")
    duplicates = F.get_json_object("metadata", "$.duplicate_rows").cast("long")
    above = F.get_json_object("metadata", "$.violations.score.above").cast("long")
    ratio = F.round(F.get_json_object("metadata", "$.null_ratios.score").cast("double"), 6)
    return verdicts.select(
        "asset", "shard", "check_name", "passed", "severity",
        duplicates.alias("duplicate_rows"), above.alias("above"), ratio.alias("score_null_ratio"),
    )


def _latest_verdicts(spark, sf):
    return quality.latest_verdicts(fx.verdicts(spark, sf), ("run_ts", "event_id"))


def latest_verdicts(spark, sf):
    return _latest_verdicts(spark, sf)


def verdict_tally(spark, sf):
    return quality.verdict_tally(_latest_verdicts(spark, sf))


def error_failures(spark, sf):
    return quality.error_failures(_latest_verdicts(spark, sf)).select("asset", "check_name", "shard", "event_id")


def quality_report(spark, sf):
    """The report over the latest verdicts, written and read back."""
    path = scratch_path(spark, "report")
    quality.write_quality_report(_latest_verdicts(spark, sf), path, "r1")
    back = spark.read.schema("run string, asset string, check_name string, shard long, event_id long, passed boolean, alert boolean, summary string").json(path)
    return back


def _small_run(spark, sf) -> Run:
    """Stops and boundaries, raw and indexed, brought up to date twice against a fresh store."""
    stops = raw_table("transit_stops", "stops", lambda s: _stop_points(s, sf))
    shapes = raw_table("municipality_boundaries", "boundaries", lambda s: fx.boundaries(s, sf))
    derived = [t for t in derived_tables() if t.name in ("cell_transit_stops", "municipalities")]
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    Run(store, [stops, shapes], derived=derived).run()
    again = Run(store, [stops, shapes], derived=derived)
    again.run()
    return again


def run_ledger(spark, sf):
    """What the ledger holds of a run and of the next one, which reuses all."""
    ledger = _small_run(spark, sf).ledger()
    found = F.from_json("metadata", "rows long, verdicts string, preview array<map<string, string>>, columns map<string, string>")
    rows = ledger.withColumn("m", found).withColumn("version_first", F.min("version").over(Window.partitionBy("asset")))
    return rows.select(
        "asset", "hit", (F.col("version") == F.col("version_first")).alias("same_version"), F.map_keys("input_versions").alias("inputs"),
        F.col("m.rows").alias("rows"), F.size("m.preview").alias("previewed"), F.col("m.verdicts").alias("verdicts"),
    ).withColumn("inputs", F.array_join("inputs", ","))


def run_report(spark, sf):
    """The verdicts of the second run, all repeated from the first."""
    return _small_run(spark, sf).report().select("asset", "check_name", "passed", "severity", "reused_snapshot")


def snapshot_preview(spark, sf):
    """The first rows that the log keeps of a snapshot, without geometry, with the snapshot's stamp taken back from its path."""
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    stamp = store.write(fx.boundaries(spark, sf).coalesce(1).sortWithinPartitions("NOM"), "bronze/municipality_boundaries")
    kept = store.snapshot_metadata("bronze/municipality_boundaries")
    rows = kept.select("stamp", "rows", F.explode(F.from_json("metadata", "preview array<struct<NOM: string, TYPE: string, rings: string>>")["preview"]).alias("p"))
    back = stamp_of(F.concat(F.lit("x/stamp="), "stamp", F.lit("/part")))
    in_time = parse_stamp(back) > F.lit("2020-01-01").cast("timestamp")
    return rows.select("p.NOM", "p.TYPE", F.col("p.rings").isNull().alias("no_rings"), "rows", (back == stamp).alias("stamp_read"), in_time.alias("in_time"))


def plain_pois(spark, sf):
    """POIs of a source without names, as a snapshot of a plain table and one with geometry read by the same reader."""
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    store.write(_poi_points(spark, sf).drop("name"), "bronze/pois")
    store.write(fx.parks(spark, sf), "bronze/parks")
    pois = am.categorized_pois(store.read("bronze/pois"))
    parks = store.read("bronze/parks").select("park_id", F.size(F.get("rings", F.lit(0))).alias("vertices"))
    counts = pois.groupBy("category").agg(F.count("*").alias("n"), F.count("name").alias("named"))
    return counts.unionByName(parks.agg(F.lit("park").alias("category"), F.count("*").alias("n"), F.sum("vertices").alias("named")))


def session_options(spark, sf):
    """A query under an option set as text, with a shard of the sharded inputs' order-free fingerprint beside it."""
    configure(spark, ["set walkgrid.least = 45.5"])
    points = SQL("select category, count(*) as n from $amenities where lat >= $least group by category", amenities=fx.amenities(spark, sf), least=float(spark.conf.get("walkgrid.least")))
    return query(spark, points)


def sharded_versions(spark, sf):
    """One version of a sharded upstream, whatever the order of its shards: equal for equal histories, another if one shard moves."""
    last = lg.latest_runs(fx.ledger(spark, sf)).select("asset", F.col("shard").cast("string").alias("shard"), F.col("version").cast("string").alias("version"))
    moved = last.withColumn("version", F.when((F.col("asset") == "T3") & (F.col("shard") == "3"), "moved").otherwise(F.col("version")))
    now = {n: lg.current_versions(df).withColumnRenamed("version", n) for n, df in (("a", last), ("b", last.orderBy(F.desc("version"))), ("c", moved))}
    both = now["a"].join(now["b"], "asset").join(now["c"], "asset")
    return both.select("asset", (F.col("a") == F.col("b")).alias("same_in_any_order"), (F.col("a") == F.col("c")).alias("same_after_move"), F.split("a", ":")[0].cast("long").alias("n_shards"))


def reused_verdicts(spark, sf):
    """Verdicts of the pairs with an even number of past checks count as reused."""
    pairs = fx.verdicts(spark, sf).groupBy("asset", "shard").count().filter(F.col("count") % 2 == 0)
    out = quality.reused_verdicts(_latest_verdicts(spark, sf), pairs)
    return out.select("asset", "check_name", "shard", "passed", "event_id", "reused_snapshot")


def stale_tables(spark, sf):
    history = fx.ledger(spark, sf)
    days = F.when(F.col("asset") < "T3", 25).otherwise(360).alias("max_days")
    limits = history.select("asset").distinct().select("asset", days)
    newest = history.groupBy("asset").agg(F.max("run_ts").alias("ts"))
    now = F.expr("timestamp_ntz'2001-08-26 00:00:00'")
    return lg.stale_tables(newest, limits, now)


def changed_shards(spark, sf):
    """Gate over all shards of the history. T<n> reads T<n+1>; T5 reads a table never made; T6 has never run."""
    history = fx.ledger(spark, sf)
    upstream = F.when(F.col("asset") == "T5", "T9").otherwise(
        F.concat(F.lit("T"), (F.substring("asset", 2, 1).cast("int") + 1).cast("string"))
    )
    past = history.select(
        "asset", "shard", "run_ts", "version", "code_version",
        F.create_map(upstream, F.col("input_version") % 2).alias("input_versions"),
    )
    pairs = history.select("asset", "shard").distinct()
    wanted = pairs.unionByName(pairs.select(F.lit("T6").alias("asset"), "shard").distinct())
    wanted = wanted.withColumn("code_version", F.lit("0.2.0"))
    upstreams = history.select("asset").distinct().select("asset", upstream.alias("upstream"))
    versions = history.groupBy("asset").agg((F.max("version") % 2).alias("version"))
    decided = lg.gate(wanted, past, upstreams, versions)
    return decided.select("asset", "shard", "version", "hit", "miss_reason")


def shard_reconcile(spark, sf):
    def shards(points):
        placed = points.select("lat", "lng").dropna()
        return am.indexed_addresses(placed).select(F.col("cell_r6").alias("shard")).distinct()

    return lg.reconcile(shards(fx.amenities(spark, sf)), shards(fx.addresses(spark, sf)))


def sql_fragment(spark, sf):
    points = SQL(
        "select category, lat, lng from $amenities where lat >= $south and category <> $skip",
        amenities=fx.amenities(spark, sf), south=45.5, skip="bi'ke",
    )
    fragment = SQL(
        "select category, count(*) as n, round(min(lng), 6) as min_lng, $nothing is null as no_value "
        "from $points group by category",
        points=points, nothing=None,
    )
    return query(spark, fragment)


def snapshot_roundtrip(spark, sf):
    """Two snapshots of one table; the read gives the later one."""
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    stops = _stop_points(spark, sf)
    store.write(stops.withColumn("version", F.lit(1)), "bronze/transit_stops")
    store.write(stops.withColumn("version", F.lit(2)), "bronze/transit_stops")
    return rounded(store.read("bronze/transit_stops"), 6, "lat", "lng")


def sharded_roundtrip(spark, sf):
    """A table by shard, then one shard replaced; the read takes each shard's latest."""
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    where = "silver/cell_addresses"
    placed = am.indexed_addresses(fx.addresses(spark, sf)).withColumn("version", F.lit(1))
    store.write_sharded(placed, where, "cell_r6")
    busiest = placed.groupBy("cell_r6").count().orderBy(F.desc("count"), "cell_r6").first()["cell_r6"]
    store.write(placed.withColumn("version", F.lit(2)), where, "cell_r6", busiest)
    return store.read(where).select("id", F.col("cell_r6").alias("shard"), "version")


def one_shard(spark, sf):
    """Reading one shard touches one directory."""
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    where = "silver/cell_addresses"
    placed = am.indexed_addresses(fx.addresses(spark, sf))
    store.write_sharded(placed, where, "cell_r6")
    busiest = placed.groupBy("cell_r6").count().orderBy(F.desc("count"), "cell_r6").first()["cell_r6"]
    return store.read(where, busiest).select("id", "cell_r10")


def snapshot_metadata(spark, sf):
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    store.write(_stop_points(spark, sf), "bronze/transit_stops")
    seen = store.snapshot_metadata("bronze/transit_stops")
    return seen.select("rows", (F.col("bytes") > 0).alias("has_bytes"), F.col("file_size").endswith(" MB").alias("in_mb"))


def read_formats(spark, sf):
    """One table written as Parquet, CSV and JSON and read back by extension."""
    stops = _stop_points(spark, sf)
    base = scratch_path(spark, "formats")
    stops.write.parquet(f"{base}.pq")
    stops.write.option("header", True).csv(f"{base}.csv")
    stops.write.json(f"{base}.json")
    parts = [
        files.read_data(spark, f"{base}.{ext}").select(
            F.lit(ext).alias("format"), "stop_id", F.col("lat").cast("double"), F.col("lng").cast("double")
        )
        for ext in ("pq", "csv", "json")
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return union.groupBy("format").agg(
        F.count("*").alias("n"), F.countDistinct("stop_id").alias("n_stops"),
        F.round(F.sum("lat"), 4).alias("sum_lat"), F.round(F.sum("lng"), 4).alias("sum_lng"),
    )


def _feature_lines(df: DataFrame, kind: str, coordinates, *properties: str) -> DataFrame:
    return df.select(
        F.to_json(
            F.struct(
                F.lit("Feature").alias("type"),
                F.struct(*properties).alias("properties"),
                F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry"),
            )
        ).alias("value")
    )


def _pairs(line):
    return F.transform(line, lambda p: F.array(p["lng"], p["lat"]))


def geojson_paths(spark, sf):
    path = scratch_path(spark, "geojson")
    paths = fx.paths(spark, sf).withColumnRenamed("path_id", "ID_CYCL")
    _feature_lines(paths, "LineString", _pairs(F.get("parts", F.lit(0))), "ID_CYCL").write.text(path)
    back = files.read_features(spark, path, "line", files.BIKE_PATH_PROPERTIES)
    vertices = back.select("ID_CYCL", F.posexplode(F.get("parts", F.lit(0))).alias("i", "p"))
    return vertices.select("ID_CYCL", "i", F.round("p.lng", 6).alias("lng"), F.round("p.lat", 6).alias("lat"))


def geojson_boundaries(spark, sf):
    path = scratch_path(spark, "geojson")
    rings = F.transform("rings", _pairs)
    _feature_lines(fx.boundaries(spark, sf), "Polygon", rings, "NOM", "TYPE").write.text(path)
    back = am.municipalities(files.read_features(spark, path, "polygon", files.BOUNDARY_PROPERTIES))
    vertices = back.select("municipality", "type", F.posexplode(F.get("rings", F.lit(0))).alias("i", "p"))
    return vertices.select(
        "municipality", "type", "i", F.round("p.lng", 6).alias("lng"), F.round("p.lat", 6).alias("lat")
    )


def geojson_addresses(spark, sf):
    """Wide address features; the unplaced ones have no geometry and lose their cell, so they drop out."""
    path = scratch_path(spark, "geojson")
    wide = fx.addresses(spark, sf).select(
        F.col("id").cast("string").alias("ID_UEV"), F.col("nk").cast("string").alias("MUNICIPALITE"),
        (F.col("id") % 7).alias("NOMBRE_LOGEMENT"), "lng", "lat",
    )
    point = F.when(F.col("lng").isNotNull(), F.array("lng", "lat"))
    _feature_lines(wide, "Point", point, "ID_UEV", "MUNICIPALITE", "NOMBRE_LOGEMENT").write.text(path)
    back = files.read_features(spark, path, "point", files.ADDRESS_PROPERTIES)
    return am.indexed_addresses(back).select("ID_UEV", "MUNICIPALITE", "NOMBRE_LOGEMENT", "NOM_RUE", "cell_r10")


def _one_document(items: DataFrame, order: str, array: str, path: str) -> None:
    """``value`` texts as one landed file ``{"<array>": [...]}``. One file is one task to write, sorted on disk; not to read."""
    lines = items.select(F.lit(1).alias("part"), F.col(order).alias("at"), "value")
    ends = items.sparkSession.range(2).select((F.col("id") * 2).cast("int").alias("part"), F.lit(None).cast(lines.schema["at"].dataType).alias("at"), F.when(F.col("id") == 0, f'{{"kind": "]}}", "{array}": [{{"type": null}}').otherwise("]}").alias("value"))
    text = F.when(F.col("part") == 1, F.concat(F.lit(","), "value")).otherwise(F.col("value")).alias("value")
    lines.unionByName(ends).coalesce(1).sortWithinPartitions("part", "at").select(text).write.text(path)


def feature_collection(spark, sf):
    """Parks as one GeoJSON document, read in ranges of 8 KB."""
    path = scratch_path(spark, "features")
    parks = fx.parks(spark, sf)
    _one_document(_feature_lines(parks, "Polygon", F.transform("rings", _pairs), "park_id").select("value", F.get_json_object("value", "$.properties.park_id").cast("long").alias("at")), "at", "features", path)
    back = files.read_features(spark, path, "polygon", "park_id long", multiline=True, split=8 << 10).filter("park_id is not null")
    vertices = back.select("park_id", F.posexplode(F.get("rings", F.lit(0))).alias("i", "p"))
    return vertices.select("park_id", "i", F.round("p.lng", 6).alias("lng"), F.round("p.lat", 6).alias("lat"))


def _element_lines(spark, sf):
    return fx.elements(spark, sf).select(F.to_json(F.struct("type", "id", "lon", "lat", "center", "tags")).alias("value"), "position")


def elements_document(spark, sf):
    """POI elements as one document, read in ranges of 64 KB; the first of a repeated element wins by its place in the document."""
    path = scratch_path(spark, "elements")
    _one_document(_element_lines(spark, sf), "position", "elements", path)
    points = am.poi_points(files.read_elements(spark, path, multiline=True, split=64 << 10))
    return rounded(points.withColumn("category", am.category_of(F.col("fclass"))), 6, "lng", "lat")


def elements_files(spark, sf):
    """POI elements line by line in files of unequal size; the first wins by file name and place, however Spark deals the files."""
    path = scratch_path(spark, "elements")
    lines = _element_lines(spark, sf)
    part = F.when(F.col("position.copy") == 1, 2).when(F.col("position.p_partkey") % 10 != 0, 1).otherwise(0).alias("part")
    lines.select(part, "position", "value").repartitionByRange(3, "part").sortWithinPartitions("part", "position").select("value").write.text(path)
    points = am.poi_points(files.read_elements(spark, path))
    return rounded(points.withColumn("category", am.category_of(F.col("fclass"))), 6, "lng", "lat")


def stops_csv(spark, sf):
    path = scratch_path(spark, "stops")
    fx.stops(spark, sf).write.option("header", True).csv(path)
    stops = am.indexed(files.read_stops(spark, path))
    return rounded(stops.select("stop_id", "lng", "lat", "cell_r10"), 6, "lng", "lat")


def feature_json(spark, sf):
    """Map features, parsed back for comparison: one row per vertex of the closed outline."""
    features = report.hex_features(rollup.hex_rollup(_livability(spark, sf)))
    parsed = F.from_json(
        "feature",
        "type string, geometry struct<type: string, coordinates: array<array<array<double>>>>, "
        "properties struct<municipality: string, addresses: long, livability: double, score_bike: double, fill: string>",
    )
    rows = features.select("cell", parsed.alias("f"))
    return rows.select(
        "cell", F.col("f.type").alias("type"), F.col("f.geometry.type").alias("geometry_type"),
        "f.properties.municipality", "f.properties.addresses", "f.properties.livability", "f.properties.score_bike",
        "f.properties.fill", F.posexplode(F.col("f.geometry.coordinates")[0]).alias("i", "p"),
    ).select("*", F.col("p")[0].alias("lng"), F.col("p")[1].alias("lat")).drop("p")


def personal_top(spark, sf):
    best = top_cells(personal_scores(_livability(spark, sf), ANCHORS), ANCHORS)
    return best.select(_cell().alias("cell"), F.round("personal_score", 4).alias("personal_score"), "why")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        cell_index, cell_parent, cell_center, cell_outline, ring_cells, line_trace, line_cells, polygon_point,
        mercator_to_wgs84, projected_to_wgs84, haversine_pairs, nearest_exact, nearest_edges, nearest_first_ring, distance_profile, profile_after_move, distance_scores,
        cell_scores, livability, livability_custom_weights, region_cells, region_livability, region_rollup, custom_blends, score_colors, score_profile, score_metadata,
        tag_municipality, tag_zones, address_municipality, hex_rollup, dominant_municipality, municipality_table, municipality_ranking, customer_ranks,
        ranked_boundaries, global_stats, category_share, map_center, poi_elements, poi_bbox, amenities_union,
        boundary_types, check_schema, check_uniqueness, check_completeness, check_range, check_bundle_by_shard,
        latest_verdicts, verdict_tally, error_failures, quality_report, run_ledger, run_report, snapshot_preview, plain_pois,
        session_options, sharded_versions, reused_verdicts, stale_tables, changed_shards,
        shard_reconcile, sql_fragment, snapshot_roundtrip, sharded_roundtrip, one_shard, snapshot_metadata,
        read_formats, geojson_paths, geojson_boundaries, geojson_addresses, feature_collection, elements_document,
        elements_files, stops_csv, feature_json, personal_top,
    )
}
