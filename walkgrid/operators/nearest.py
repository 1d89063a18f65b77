"""Nearest amenity per address and category, exact, without ever pairing up whole groups.

Plan of both modes:

1. Addresses and amenities shrink to distinct positions (copies of one position cost nothing afterwards) and are
   written once to the shared folder, keyed by a coarse group (a grid bin or a hexagon).
2. Candidate pairs are pairs of *groups*, found by an equi-join on the group key. Each group carries its bounding box
   and row count, so a pair has a lower and an upper bound on the distance; pairs that cannot hold the nearest
   amenity are dropped.
3. A pair whose position product is above ``MAX_PRODUCT`` is split into quarters on both sides, bounded again and
   pruned again, until every pair is small. Crowded places thus descend, sparse places stop at the first level: a
   position is read once, and once more for each level at which its cell is crowded.
   Nothing is capped: splitting only ever replaces a pair by all of its parts.
4. The small pairs meet the positions by equi-join: the rows of a cell of addresses stand together, its own positions first,
   then those of the amenity cells it is paired with, as short arrays. Distances are taken array by array, so no row is made
   for a pair of positions; the minimum per position and category is one aggregate over a row a position. All levels share one
   shuffle and one pass, so the number of tasks does not grow with the levels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from walkgrid.constants import CATEGORIES, DIST_COLUMNS, EARTH_RADIUS_M, EDGE_M, MAX_RING
from walkgrid.functions.geo import arc_of
from walkgrid.functions.grid import DEFAULT_GRID, HexGrid, around_cells, ring_offsets
from walkgrid.session import materialize

# From anywhere in a cell to anywhere in its outermost ring.
RADIUS_M = (MAX_RING * math.sqrt(3) + 2) * EDGE_M[10]

# Most position pairs one pair of cells may produce before it is split.
MAX_PRODUCT = 16384

# Positions are binned as whole numbers of this many halvings of the unit sphere's radius, 6 nanometres on the ground. Splitting
# ends there: positions that share such a cube cannot be told apart by distance, and are compared one by one.
BITS = 50

# Most amenity positions in one array, and most pairs whose distances are taken at once.
PACK, BLOCK = 256, 1 << 16

# Rings probed for every cell before the far ones are probed for cells still lacking a category.
NEAR_RINGS = 2

AXES = "xyz"
A_GROUP, B_GROUP = ["ag1", "ag2", "ag3"], ["bg1", "bg2", "bg3"]
A_CELL, B_CELL = [*A_GROUP, "ax", "ay", "az"], [*B_GROUP, "bx", "by", "bz"]


def _whole(axis: str) -> Column:
    """A coordinate of the unit vector as a whole number, never negative."""
    return F.floor((F.col(f"u{axis}") + 1) * float(1 << BITS))


def _last_level(side: float) -> int:
    """Halvings after which a sub-cell is one step of the whole numbers."""
    return max(1, math.ceil(math.log2(side)) + BITS)


def _sub_cell(axis: str, side: float, level: int) -> Column:
    """Index of a position's sub-cell after ``level`` halvings; halving the index gives the level above."""
    return F.lit(0).cast("long") if level == 0 else F.shiftright(_whole(axis), max(0, _last_level(side) - level))


def _with_sub_cells(points: DataFrame, side: str, side_len: float, level: int) -> DataFrame:
    return points.withColumns({f"{side}{x}": _sub_cell(x, side_len, level) for x in AXES})


def _cells(points: DataFrame, side: str, side_len: float, level: int) -> DataFrame:
    """Bounding box and position count per sub-cell of one side (``a`` addresses, ``b`` amenities)."""
    group = A_GROUP if side == "a" else ["cat", *B_GROUP]
    return (
        _with_sub_cells(points, side, side_len, level)
        .groupBy(*group, *[f"{side}{x}" for x in AXES])
        .agg(
            F.count("*").alias(f"{side}_n"),
            *[f(f"u{x}").alias(f"{side}_{x}_{end}") for x in AXES for end, f in (("lo", F.min), ("hi", F.max))],
        )
    )


def _pruned(pairs: DataFrame, radius: float | None) -> DataFrame:
    """Keep the pairs that can hold an address's nearest amenity.

    Both bounds are squared chords between boxes of unit vectors, which no real pair undercuts (exceeds); they know no
    poles and no date line.
    """
    c = F.col

    def gap(x: str) -> Column:
        return F.greatest(c(f"a_{x}_lo") - c(f"b_{x}_hi"), c(f"b_{x}_lo") - c(f"a_{x}_hi"), F.lit(0.0))

    def span(x: str) -> Column:
        return F.greatest(c(f"a_{x}_hi") - c(f"b_{x}_lo"), c(f"b_{x}_hi") - c(f"a_{x}_lo"))

    square = lambda f: reduce(lambda p, q: p + q, [f(x) * f(x) for x in AXES])
    bounded = pairs.select(
        *A_CELL, "cat", *B_CELL, (c("a_n") * c("b_n")).alias("product"), square(gap).alias("lower"), square(span).alias("upper")
    )
    slack = 1.0 + 1e-9  # rounding of the bounds themselves
    if radius is not None:
        bounded = bounded.filter(c("lower") <= _chord(radius) ** 2 * slack)
    # one shuffle serves the window and sets the layout of the written pairs, in as many files as their size asks for
    bounded = bounded.repartition(*A_CELL)
    best = F.min("upper").over(Window.partitionBy(*A_CELL, "cat"))
    return (
        bounded.withColumn("best", best)
        .filter(c("lower") <= c("best") * slack + 1e-24)
        .drop("lower", "upper", "best")
    )


def _inside(points: DataFrame, deep: DataFrame, side: str, group: list[str], side_len: float, level: int) -> DataFrame:
    """The positions in cells of crowded pairs, written: only those are read again, one level down."""
    cell = [f"{side}{x}" for x in AXES]
    wanted = deep.select(*group, *cell).distinct()
    return materialize(_with_sub_cells(points, side, side_len, level).join(wanted, [*group, *cell], "left_semi").drop(*cell), f"nearest-deep-{side}")


def _split(deep: DataFrame, seekers: DataFrame, targets: DataFrame, side_len: float, level: int) -> DataFrame:
    """Replace pairs of cells of ``level`` by the pairs of their parts, one level down, of the positions in those cells."""

    def parts(points: DataFrame, side: str) -> DataFrame:
        up = (lambda x: F.lit(0).cast("long")) if level == 0 else (lambda x: F.shiftright(x, 1))
        return _cells(points, side, side_len, level + 1).withColumns({f"{side}p{x}": up(F.col(f"{side}{x}")) for x in AXES})

    renamed = deep.select(*A_GROUP, "cat", *B_GROUP, *[F.col(f"{side}{x}").alias(f"{side}p{x}") for side in "ab" for x in AXES])
    return renamed.join(parts(seekers, "a"), [*A_GROUP, *[f"ap{x}" for x in AXES]]).join(
        parts(targets, "b"), ["cat", *B_GROUP, *[f"bp{x}" for x in AXES]]
    )


def _least_chords(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least squared chord from each position of ``a`` to those of ``b`` (three rows each: the axes)."""
    least = np.full(a.shape[1], np.nan)
    step = max(1, BLOCK // a.shape[1])
    for at in range(0, b.shape[1], step):
        total = np.zeros(1)
        for mine, other in zip(a, b, strict=True):
            d = mine[None, :] - other[at : at + step, None]
            d *= d
            total = total + d
        least = np.fmin(least, np.fmin.reduce(total, axis=0))
    return least


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by level, cell and category, the cell's own positions first (category 0): least squared chords of each position."""
    names = ["lat", "lng", *CATEGORIES]
    cell, own, least = None, np.empty((5, 0)), {}

    def done() -> list[np.ndarray]:
        return [np.vstack((own[:2], *[least.get(i, np.full(own.shape[1], np.inf)) for i in range(1, len(CATEGORIES) + 1)]))] if least else []

    def batch_of(found: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.hstack(found) if found else np.empty((len(names), 0))
        chords = [pa.array(r, mask=np.isposinf(r)) for r in rows[2:]]  # infinite: nothing to meet
        return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1]), *chords], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ["level", *A_CELL, "cat"]])
        values = batch.column("some").flatten().to_numpy()
        ends = batch.column("some").offsets.to_numpy().astype(np.int64)
        first = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(0)))
        found = []
        for lo, hi in zip(first, np.append(first[1:], batch.num_rows), strict=True):
            *at, cat = keys[:, lo].tolist()
            if at != cell:
                found += done()
                cell, own, least = at, np.empty((5, 0)), {}
            some = values[ends[lo] - ends[0] : ends[hi] - ends[0]]
            if cat == 0:
                own = np.hstack((own, some.reshape(-1, 5).T))
            elif own.shape[1]:
                met = _least_chords(own[2:], np.ascontiguousarray(some.reshape(-1, 3).T))
                least[cat] = np.fmin(least[cat], met) if cat in least else met
        yield batch_of(found)
    yield batch_of(done())


def _meeting(seekers: DataFrame, targets: DataFrame, small: DataFrame, side_len: float, level: int) -> DataFrame:
    """One array of numbers a row, to meet by cell of ``level``: each position of the cells of addresses in ``small`` pairs (category 0:
    lat, lng and the three axes), and those of the cells they are paired with (the three axes, position by position)."""
    axes = [f"u{x}" for x in AXES]
    b_cell = ["cat", *B_CELL]
    b = _with_sub_cells(targets, "b", side_len, level).join(small.select(*b_cell).distinct(), b_cell, "left_semi")
    packed = b.groupBy(*b_cell).agg(F.collect_list(F.array(*axes)).alias("all"))  # of cells in small pairs: as bounded as these
    begins = F.sequence(F.lit(1), F.size("all"), F.lit(PACK))
    packed = packed.select(*b_cell, F.explode(F.transform(begins, lambda i: F.flatten(F.slice("all", i, PACK)))).alias("some"))
    met = small.select(*A_CELL, *b_cell).join(packed, b_cell).select(*A_CELL, "cat", "some")
    a = _with_sub_cells(seekers, "a", side_len, level).join(small.select(*A_CELL).distinct(), A_CELL, "left_semi")
    own = a.select(*A_CELL, F.lit(0).alias("cat"), F.array("lat", "lng", *axes).alias("some"))
    return own.unionByName(met).withColumn("level", F.lit(level))


def _met(meeting: list[DataFrame]) -> DataFrame:
    """(lat, lng, <category>...) least squared chords at each level, null without a pair: one shuffle and one pass for all levels."""
    rows = reduce(DataFrame.unionByName, meeting).repartition("level", *A_CELL).sortWithinPartitions("level", *A_CELL, "cat")
    return rows.mapInArrow(_by_cell, ", ".join(f"{c} double" for c in ("lat", "lng", *CATEGORIES)))


def _closest(
    seekers: DataFrame, targets: DataFrame, pairs: DataFrame, side_len: float, radius: float | None, max_product: int
) -> DataFrame:
    """(lat, lng, dist_<category>...) of the least distance per address position over its candidate groups."""
    meeting = []
    level = 0
    while True:
        small = F.col("product") <= max_product if level < _last_level(side_len) else F.lit(True)
        seen = Observation()  # counted while the pairs are written, so asking costs no job
        pairs = materialize(_pruned(pairs, radius).observe(seen, F.count_if(small).alias("small"), F.count_if(~small).alias("crowded")), "nearest-pairs")
        last = seen.get["crowded"] == 0
        if seen.get["small"] or (last and not meeting):
            meeting.append(_meeting(seekers, targets, pairs.filter(small), side_len, level))
        if last:
            break
        deep = pairs.filter(~small)
        seekers, targets = _inside(seekers, deep, "a", A_GROUP, side_len, level), _inside(targets, deep, "b", ["cat", *B_GROUP], side_len, level)
        pairs = _split(deep, seekers, targets, side_len, level)
        level += 1
    least = _met(meeting).groupBy("lat", "lng").agg(*[F.min(c).alias(c) for c in CATEGORIES])

    found = least.select("lat", "lng", *[arc_of(F.sqrt(c) / 2).alias(f"dist_{c}") for c in CATEGORIES])
    if radius is not None:
        found = found.select(
            "lat", "lng", *[F.when(F.col(d) <= radius, F.col(d)).alias(d) for d in DIST_COLUMNS]
        )
    return found


def _unit_vector(lng: Column, lat: Column) -> list[Column]:
    """A position on the unit sphere. The squared chord between two of them orders pairs exactly as the great-circle
    distance does, without trigonometry per pair (which is left to one ``asin`` per winner)."""
    lng, lat = F.radians(lng), F.radians(lat)
    return [
        (F.cos(lat) * F.cos(lng)).alias("ux"), (F.cos(lat) * F.sin(lng)).alias("uy"), F.sin(lat).alias("uz"),
    ]


def _chord(metres: float) -> float:
    """Length through the unit sphere of an arc on the ground."""
    return 2 * math.sin(min(metres / (2 * EARTH_RADIUS_M), math.pi / 2))


def _bin_pairs(seekers: DataFrame, targets: DataFrame, side_len: float) -> DataFrame:
    """Address bins against the amenity bins around them: cubes as wide as the radius, so 27 hold all that is in reach."""
    probes = _cells(seekers, "a", side_len, 0)
    for a, b in zip(A_GROUP, B_GROUP, strict=True):
        probes = probes.withColumn(b, F.explode(F.sequence(F.col(a) - 1, F.col(a) + 1)))
    return probes.join(_cells(targets, "b", side_len, 0), B_GROUP)


def _ring_pairs(seekers: DataFrame, targets: DataFrame, side_len: float, max_k: int) -> DataFrame:
    """Address hexagons against the amenity hexagons of their first non-empty ring, per category."""
    homes = _cells(seekers, "a", side_len, 0)
    shops = _cells(targets, "b", side_len, 0)
    shop_cells = shops.select("cat", *B_GROUP)

    def hits(cells: DataFrame, low: int, high: int) -> DataFrame:
        return (
            around_cells(cells, "ag1", "ag2", low, high, ("bg1", "bg2"))
            .withColumn("bg3", F.col("ag3"))
            .join(shop_cells, B_GROUP)
            .groupBy(*A_GROUP, "cat")
            .agg(F.min("k").alias("k"))
        )

    cells = homes.select(*A_GROUP)
    near = hits(cells, 0, min(NEAR_RINGS, max_k))
    if max_k > NEAR_RINGS:
        near = materialize(near, "nearest-rings")
        done = near.groupBy(*A_GROUP).count().filter(F.col("count") == len(CATEGORIES))
        far = hits(cells.join(done, A_GROUP, "left_anti"), NEAR_RINGS + 1, max_k)
        near = near.unionByName(far).groupBy(*A_GROUP, "cat").agg(F.min("k").alias("k"))
    rings = near.select(*A_GROUP, "cat", F.explode(ring_offsets(F.col("k"))).alias("o")).select(
        *A_GROUP, "cat", (F.col("ag1") + F.col("o.dq")).alias("bg1"), (F.col("ag2") + F.col("o.dr")).alias("bg2"),
        F.col("ag3").alias("bg3"),
    )
    return rings.join(shops, ["cat", *B_GROUP]).join(homes, A_GROUP)


def nearest(
    addresses: DataFrame,
    amenities: DataFrame,
    mode: str = "exact",
    radius: float = RADIUS_M,
    max_k: int = MAX_RING,
    id_col: str = "id",
    grid: HexGrid = DEFAULT_GRID,
    max_product: int = MAX_PRODUCT,
) -> DataFrame:
    """``addresses`` plus ``dist_<category>`` in metres to the nearest amenity of each category, null if none.

    ``mode="exact"``: the true nearest within ``radius``. ``mode="first_ring"``: the nearest inside the first
    non-empty hexagon ring of at most ``max_k`` rings (a closer one may sit in the next ring). Addresses need
    ``lat``/``lng`` and amenities ``category``/``lat``/``lng``; addresses without a position are kept with nulls.
    The default radius covers the outermost ring. Jobs run when this is called; reading the result runs the last join.
    """
    if mode not in ("exact", "first_ring"):
        raise ValueError(f"unknown mode {mode!r}; expected 'exact' or 'first_ring'")
    double = lambda name: F.col(name).cast("double").alias(name)
    own = [] if mode == "exact" else list(grid.keys)  # rings stay within their region
    a = addresses.select(*own, double("lat"), double("lng")).dropna().distinct()
    cat = F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), F.col("category")).cast("int")
    b = (
        amenities.filter(F.col("category").isin(*CATEGORIES))
        .select(*own, cat.alias("cat"), double("lat"), double("lng"))
        .dropna()
        .distinct()
    )
    if mode == "exact":
        side_len = _chord(radius) * 1.0001
        groups = [F.floor(F.col(f"u{x}") / side_len) for x in AXES]
    else:
        side_len = 2 * EDGE_M[10] / EARTH_RADIUS_M
        region = F.xxhash64(*own) if own else F.lit(0).cast("long")
        groups = [*(x.cast("long") for x in grid.axial(F.col("lng"), F.col("lat"), 10)), region]
        a, b = grid.attach(a), grid.attach(b)
    unit = _unit_vector(F.col("lng"), F.col("lat"))
    named = lambda side: [g.alias(f"{side}g{i}") for i, g in enumerate(groups, 1)]
    seekers = materialize(a.select("*", *unit).select("*", *named("a")), "nearest-addresses")
    targets = materialize(b.select("*", *unit).select("*", *named("b")), "nearest-amenities")
    if mode == "exact":
        pairs, limit = _bin_pairs(seekers, targets, side_len), radius
    else:
        pairs, limit = _ring_pairs(seekers, targets, side_len, max_k), None
    found = _closest(seekers, targets, pairs, side_len, limit, max_product)
    return _join_back(addresses, found, id_col)


def _join_back(addresses: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """Distances onto the full address table by position.

    Rows without a position never match; a salt from the id spreads them over the shuffle instead of piling them up
    on the null key. A crowded single position is split at run time by the adaptive skew join (left side).
    """
    placed = F.col("lat").isNotNull() & F.col("lng").isNotNull()
    salt = F.when(placed, F.lit(0)).otherwise(F.pmod(F.xxhash64(id_col), F.lit(4096)).cast("int") + 1)
    keyed = addresses.withColumn("_lat", F.col("lat").cast("double")).withColumn("_lng", F.col("lng").cast("double"))
    keyed = keyed.withColumn("_salt", salt)
    right = found.withColumnsRenamed({"lat": "_lat", "lng": "_lng"}).withColumn("_salt", F.lit(0))
    return keyed.join(right, ["_lat", "_lng", "_salt"], "left").drop("_lat", "_lng", "_salt")
