"""Location tables derived from the given business tables, which hold no coordinates.

Positions are integer arithmetic on keys, so every view grows with its source table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lat(key: str) -> Column:
    return F.expr(f"45.45e0 + (({key} * 15485863) % 9973) / 9973e0 * 0.10e0")


def _lng(key: str) -> Column:
    return F.expr(f"-73.70e0 + (({key} * 32452843) % 9967) / 9967e0 * 0.15e0")


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 97th address has no position."""
    placed = F.col("c_custkey") % 97 != 96
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("nk"),
        F.when(placed, F.expr("45.45e0 + ((c_custkey * 7919) % 10007) / 10007e0 * 0.10e0")).alias("lat"),
        F.when(placed, F.expr("-73.70e0 + ((c_custkey * 104729) % 10009) / 10009e0 * 0.15e0")).alias("lng"),
    )


def amenities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat six-category amenity points."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pid"),
        F.expr(
            """case p_partkey % 6 when 0 then 'grocery' when 1 then 'school' when 2 then 'health'
               when 3 then 'transit' when 4 then 'park' else 'bike' end"""
        ).alias("category"),
        _lat("p_partkey").alias("lat"),
        _lng("p_partkey").alias("lng"),
    )


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """POI elements as the source nests them, with ``position`` in source order.

    Every 10th comes twice, some classes are foreign, every 41st has no coordinates, ways and relations carry a centre.
    """
    placed = F.col("p_partkey") % 41 != 0
    node = F.col("p_partkey") % 3 == 0
    value = F.expr(
        """case p_partkey % 16 when 0 then 'supermarket' when 1 then 'convenience' when 2 then 'greengrocer'
           when 3 then 'bakery' when 4 then 'butcher' when 5 then 'school' when 6 then 'college'
           when 7 then 'university' when 8 then 'kindergarten' when 9 then 'clinic' when 10 then 'hospital'
           when 11 then 'pharmacy' when 12 then 'doctors' when 13 then 'dentist' when 14 then 'bench'
           else 'fuel' end"""
    )
    key = F.when(F.col("p_partkey") % 16 < 5, "shop").otherwise("amenity")
    own_lat, own_lng = F.when(placed, _lat("p_partkey")), F.when(placed, _lng("p_partkey"))
    copies = F.when(F.col("p_partkey") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        table(spark, sf_dir, "part")
        .withColumn("copy", F.explode(copies))
        .select(
            F.expr("case p_partkey % 3 when 0 then 'node' when 1 then 'way' else 'relation' end").alias("type"),
            F.col("p_partkey").alias("id"),
            F.when(node, own_lng).alias("lon"),
            F.when(node, own_lat).alias("lat"),
            F.when(~node & placed, F.struct(own_lng.alias("lon"), own_lat.alias("lat"))).alias("center"),
            F.create_map(
                key, value, F.lit("name"), F.concat("p_name", F.when(F.col("copy") == 1, " bis").otherwise(""))
            ).alias("tags"),
            F.struct("copy", "p_partkey").alias("position"),
        )
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("stop_id"),
        _lat("p_partkey").alias("stop_lat"),
        _lng("p_partkey").alias("stop_lon"),
    )


def _vertices(points: list[tuple[int, int]], lng: str, lat: str) -> Column:
    """Array of (lng, lat) structs; ``lng``/``lat`` are SQL texts over the key, ``{dx}`` and ``{dy}``."""
    return F.array(
        *[
            F.struct(F.expr(lng.format(dx=dx)).alias("lng"), F.expr(lat.format(dy=dy)).alias("lat"))
            for dx, dy in points
        ]
    )


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-vertex lines; some have zero length."""
    line = _vertices(
        [(i, i) for i in range(5)],
        "-73.69e0 + ((s_suppkey * 104729) % 991) / 991e0 * 0.13e0 + {dx} * ((s_suppkey * 17) % 7 - 3) * 0.0012e0",
        "45.46e0 + ((s_suppkey * 7919) % 997) / 997e0 * 0.08e0 + {dy} * ((s_suppkey * 31) % 7 - 3) * 0.0009e0",
    )
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("path_id"), F.array(line).alias("parts"))


def parks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-shaped polygons, for which the middle of the bounding box is no safe interior point."""
    ring = _vertices(
        [(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2)],
        "-73.69e0 + ((s_suppkey * 1409) % 991) / 991e0 * 0.13e0 + {dx} * 0.0005e0 * (1 + s_suppkey % 3)",
        "45.46e0 + ((s_suppkey * 613) % 997) / 997e0 * 0.08e0 + {dy} * 0.0005e0 * (1 + s_suppkey % 3)",
    )
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("park_id"), F.array(ring).alias("rings"))


def boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 sheared, gap-free tiles as landed (NOM, TYPE); part of the addresses lies outside all of them."""
    row = "cast(floor(n_nationkey / 5) as int) * 0.016e0"
    corners = [("0e0", "0e0"), ("0.022e0", "0e0"), ("0.022e0", "0.016e0"), ("0e0", "0.016e0")]
    ring = F.array(
        *[
            F.struct(
                F.expr(f"-73.68e0 + (n_nationkey % 5) * 0.022e0 + {dx} + 0.2e0 * ({row} + {dy})").alias("lng"),
                F.expr(f"45.46e0 + {row} + {dy}").alias("lat"),
            )
            for dx, dy in corners
        ]
    )
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("NOM"),
        F.expr("case when n_nationkey % 4 = 0 then 'ville' else 'arrondissement' end").alias("TYPE"),
        F.array(ring).alias("rings"),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L-shaped zones, the largest 20 degrees wide, which overlap one another and all boundaries."""
    corners = [(0, 0), (20, 0), (20, 8), (9, 8), (9, 20), (0, 20)]
    size = "(1e0 - r_regionkey * 0.15e0)"
    ring = _vertices(corners, "-90e0 + r_regionkey * 3.1e0 + {dx} * " + size, "33e0 + r_regionkey * 2.3e0 + {dy} * " + size)
    return table(spark, sf_dir, "region").select(F.concat(F.lit("zone "), "r_name").alias("name"), F.array(ring).alias("rings"))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of which two in three lie in the city and the others all over the zones and beyond."""
    near = F.col("p_partkey") % 3 != 0
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.when(near, _lng("p_partkey")).otherwise(F.expr("-92e0 + ((p_partkey * 104729) % 10009) / 10009e0 * 30e0")).alias("lng"),
        F.when(near, _lat("p_partkey")).otherwise(F.expr("31e0 + ((p_partkey * 7919) % 10007) / 10007e0 * 26e0")).alias("lat"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two regions with a reference point each, far apart in latitude, so that their planes differ in width too."""
    k = F.col("r_regionkey").cast("double")
    return table(spark, sf_dir, "region").filter("r_regionkey < 2").select(
        F.col("r_name").alias("region"), (k * 14.75 + 45.5).alias("lat0"), (k * 98.5 - 73.6).alias("lng0")
    )


def in_regions(df: DataFrame, key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of which those with an odd key are moved to the second region, with the name of their region."""
    names = table(spark, sf_dir, "region").filter("r_regionkey < 2").select(F.col("r_regionkey").alias("_side"), F.col("r_name").alias("region"))
    side = F.pmod(F.col(key), F.lit(2)).cast("int")
    moved = df.withColumn("_side", side.cast(names.schema["_side"].dataType))
    moved = moved.withColumns({"lat": F.col("lat") + side.cast("double") * 14.75, "lng": F.col("lng") + side.cast("double") * 98.5})
    return moved.join(names, "_side").drop("_side")


def region_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The boundaries in both regions."""
    both = boundaries(spark, sf_dir).withColumn("_side", F.explode(F.array(F.lit(0.0), F.lit(1.0))))
    point = lambda p: F.struct((p["lng"] + F.col("_side") * 98.5).alias("lng"), (p["lat"] + F.col("_side") * 14.75).alias("lat"))
    return both.withColumn("rings", F.transform("rings", lambda ring: F.transform(ring, point))).drop("_side")


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Check history; the newest per (asset, check_name, shard) is by (run_ts, event_id)."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("asset"),
        (F.col("user_id") % 10).alias("shard"),
        F.col("ts").alias("run_ts"),
        F.expr(
            """case event_id % 4 when 0 then 'schema_contract' when 1 then 'row_uniqueness'
               when 2 then 'field_completeness' else 'value_range' end"""
        ).alias("check_name"),
        (F.col("event_id") % 7 != 0).alias("passed"),
        F.when(F.col("event_id") % 4 == 2, "WARN").otherwise("ERROR").alias("severity"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materialisation history of six tables by shard."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("T"), (F.col("o_custkey") % 6).cast("string")).alias("asset"),
        (F.col("o_custkey") % 27).alias("shard"),
        F.col("o_orderdate").alias("run_ts"),
        F.col("o_orderkey").alias("version"),
        F.when(F.col("o_orderkey") % 5 == 0, "0.1.0").otherwise("0.2.0").alias("code_version"),
        (F.col("o_orderkey") % 50).alias("input_version"),
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicates, nulls and out-of-range values for the contract checks."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").alias("ln"),
        F.when(F.col("l_linenumber") != 7, F.expr("l_quantity * 2.5e0 - 5e0")).alias("score"),
    )
