"""The pruned joins against all pairs, on even and on badly skewed points."""

import math
import random

import pytest

from walkgrid.constants import CATEGORIES, DIST_COLUMNS
from walkgrid.operators import nearest as module
from walkgrid.operators.nearest import nearest


def arc(a, b):
    lat1, lat2 = math.radians(a[0]), math.radians(b[0])
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6378137.0 * math.asin(math.sqrt(h))


def brute(addresses, amenities, radius):
    out = {}
    for i, lat, lng in addresses:
        best = {}
        for category, *p in amenities:
            if lat is not None and category in CATEGORIES:
                d = arc((lat, lng), p)
                if d <= radius:
                    best[category] = min(d, best.get(category, d))
        out[i] = best
    return out


def run(spark, addresses, amenities, **kw):
    a = spark.createDataFrame(addresses, "id long, lat double, lng double")
    b = spark.createDataFrame(amenities, "category string, lat double, lng double")
    return {r["id"]: {c: r[f"dist_{c}"] for c in CATEGORIES if r[f"dist_{c}"] is not None} for r in nearest(a, b, **kw).collect()}


def check(got, want):
    assert set(got) == set(want)
    for i in want:
        assert set(got[i]) == set(want[i])
        for c in want[i]:
            assert got[i][c] == pytest.approx(want[i][c], abs=1e-6)


def points(rng, n, lat, lng, spread):
    return [(lat + rng.uniform(-spread, spread), lng + rng.uniform(-spread, spread)) for _ in range(n)]


@pytest.mark.parametrize("center", [(45.5, -73.6), (-33.9, 151.2), (69.6, 18.9), (0.0, 0.0)])
def test_exact_on_even_points(spark, center):
    rng = random.Random(7)
    a = [(i, *p) for i, p in enumerate(points(rng, 60, *center, 0.02))] + [(1000, None, None)]
    b = [(CATEGORIES[i % 5], *p) for i, p in enumerate(points(rng, 120, *center, 0.02))]
    check(run(spark, a, b, radius=1000.0), brute(a, b, 1000.0))


def test_exact_on_skewed_points_splits_crowded_cells(spark):
    """A third of both sides in one tight cluster, a third on one position, the rest spread; tiny pair budget."""
    rng = random.Random(11)
    cluster = points(rng, 120, 45.5, -73.6, 0.0002)
    a = [(i, *p) for i, p in enumerate(cluster + [(45.501, -73.601)] * 120 + points(rng, 120, 45.5, -73.6, 0.015))]
    b = [("school", *p) for p in points(rng, 150, 45.5003, -73.6002, 0.0003)]
    b += [("bike", 45.5, -73.6)] * 150 + [("park", *p) for p in points(rng, 100, 45.5, -73.6, 0.015)]
    b += [("museum", 45.5, -73.6)]
    check(run(spark, a, b, max_product=16, radius=1000.0), brute(a, b, 1000.0))


def test_exact_radius_edge_and_empty_sides(spark):
    a = [(1, 45.5, -73.6)]
    step = 1 / 111319.49079327358
    got = run(spark, a, [("park", 45.5 + 999.9 * step, -73.6), ("bike", 45.5 + 1000.1 * step, -73.6)], radius=1000.0)
    assert set(got[1]) == {"park"}
    assert run(spark, a, []) == {1: {}}
    assert run(spark, [], [("park", 45.5, -73.6)]) == {}


def test_addresses_of_one_cell_get_their_own_minimum(spark):
    a = [(1, 45.5, -73.6), (2, 45.5002, -73.6), (3, 45.5, -73.6)]
    b = [("grocery", 45.5001, -73.6), ("grocery", 45.5004, -73.6)]
    for mode in ("exact", "first_ring"):
        got = run(spark, a, b, mode=mode)
        assert got[1]["grocery"] == pytest.approx(11.13, abs=0.01) == got[3]["grocery"]
        assert got[2]["grocery"] == pytest.approx(11.13, abs=0.01)
        assert set(got[1]) == {"grocery"}


def test_first_ring_prefers_the_nearer_ring(spark):
    """A neighbour cell's point may be nearer than the own cell's; the ring rule takes the own cell's."""
    a = [(1, 45.5, -73.6 + 0.0008)]  # near the eastern edge of cell 0:0
    b = [("park", 45.5, -73.6008), ("park", 45.5, -73.6 + 0.00095)]
    exact, ring = run(spark, a, b)[1]["park"], run(spark, a, b, mode="first_ring")[1]["park"]
    assert exact < 15 < 120 < ring


def test_first_ring_does_not_depend_on_the_pair_budget(spark):
    rng = random.Random(3)
    a = [(i, *p) for i, p in enumerate(points(rng, 80, 45.5, -73.6, 0.004))]
    b = [(CATEGORIES[i % 6], *p) for i, p in enumerate(points(rng, 200, 45.503, -73.6, 0.003))]
    check(run(spark, a, b, mode="first_ring", max_product=4), run(spark, a, b, mode="first_ring"))


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        run(spark, [(1, 45.5, -73.6)], [("park", 45.5, -73.6)], mode="fast")


def test_columns(spark):
    a = spark.createDataFrame([(1, 45.5, -73.6, "x")], "id long, lat double, lng double, note string")
    b = spark.createDataFrame([("park", 45.5, -73.6)], "category string, lat double, lng double")
    assert nearest(a, b).columns == ["id", "lat", "lng", "note", *DIST_COLUMNS]


def test_exact_across_the_date_line_and_at_the_pole(spark):
    a = [(1, 10.0, 179.9999), (2, 89.997, 10.0), (3, -90.0, 0.0)]
    b = [("park", 10.0, -179.9999), ("bike", 89.998, 160.0), ("school", -89.999, -77.0)]
    got = run(spark, a, b)
    check(got, brute(a, b, 1465.0))
    assert set(got[1]) == {"park"} and set(got[2]) == {"bike"} and set(got[3]) == {"school"}


def test_more_positions_than_the_budget_within_a_nanometre_end(spark):
    a = [(i, 45.5 + i * 1e-14, -73.6) for i in range(9)]
    b = [("park", 45.5, -73.6 - i * 2e-14) for i in range(9)]
    check(run(spark, a, b, max_product=2), brute(a, b, 1465.0))


@pytest.mark.parametrize("mode", ["exact", "first_ring"])
def test_no_row_is_made_for_a_pair_of_positions(spark, monkeypatch, mode):
    """What is aggregated is a row an address position and level, though 90,000 pairs of positions are in reach."""
    made = []
    met = module._met
    monkeypatch.setattr(module, "_met", lambda *args: made.append(met(*args)) or made[-1])
    rng = random.Random(5)
    a = [(i, *p) for i, p in enumerate(points(rng, 30, 45.5, -73.6, 0.0001))]
    b = [(CATEGORIES[i % 2], *p) for i, p in enumerate(points(rng, 3000, 45.5, -73.6, 0.0001))]
    got = run(spark, a, b, mode=mode, max_product=10**6)  # more positions in a cell than an array holds
    if mode == "exact":
        check(got, brute(a, b, 1465.0))
    assert all(set(g) == set(CATEGORIES[:2]) for g in got.values())
    assert sum(m.count() for m in made) == len(a)


def test_all_levels_meet_in_one_pass_of_few_tasks(spark, monkeypatch):
    """Several levels under 64 shuffle partitions: one shuffle, and as many tasks as the size of the rows asks for."""
    made = []
    met = module._met
    monkeypatch.setattr(module, "_met", lambda *args: made.append(met(*args)) or made[-1])
    rng = random.Random(13)
    a = [(i, *p) for i, p in enumerate(points(rng, 200, 45.5, -73.6, 0.004) + points(rng, 60, 45.5, -73.6, 0.0001))]
    b = [(CATEGORIES[i % 6], *p) for i, p in enumerate(points(rng, 300, 45.5, -73.6, 0.004) + points(rng, 60, 45.5, -73.6, 0.0001))]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        got = run(spark, a, b, max_product=16)
        tasks = sum(m.rdd.getNumPartitions() for m in made)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    check(got, brute(a, b, 1465.0))
    assert len(made) == 1 and tasks <= 8
