"""Radius cells round the globe, rows without coordinates, hot cells, odd rings."""

import math
import random

import pytest
from pyspark.sql import functions as F

from parcelle.operators import spatial

BOUNDS = (1 << 26, 0)


def km(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    s = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, s)))


def near(rng, lat, lon, reach):
    return max(-90.0, min(90.0, lat + rng.uniform(-reach, reach))), lon + rng.uniform(-reach, reach) / max(0.01, math.cos(math.radians(lat)))


@pytest.mark.parametrize("radius_m", [1600.0, 90_000.0, 3_000_000.0])
def test_radius_equals_all_pairs_anywhere(spark, radius_m):
    rng = random.Random(7)
    reach = radius_m / 111_000.0
    centres = [(10.0, 180.0), (-35.0, -180.0), (80.0, 15.0), (89.99, 0.0), (-89.999, 120.0), (0.0, 0.0), (74.9, 179.99), (48.85, 2.35)]
    points = [near(rng, *rng.choice(centres), reach) for _ in range(150)] + [(90.0, 12.0), (-90.0, -180.0), (10.0, 179.999)]
    places = [near(rng, *rng.choice(centres), reach) for _ in range(150)] + [(89.995, 170.0), (10.0, -179.999), (10.0, 180.0), (10.0, -180.0)]
    pts = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "id long, latitude double, longitude double")
    plc = spark.createDataFrame([(*p, "ab"[i % 2]) for i, p in enumerate(places)], "latitude double, longitude double, t string")
    d = [[km(p, q) * 1000 for q in places] for p in points]
    assert all(abs(x - radius_m) > 1e-3 for row in d for x in row)
    want = {i: (sum(x <= radius_m for x in row), sum(x <= radius_m and j % 2 == 0 for j, x in enumerate(row))) for i, row in enumerate(d)}
    assert any(n for n, _ in want.values())
    for bound in BOUNDS:
        got = spatial.count_within_radius(pts, plc, radius_m, type_col="t", types=["a"], max_broadcast_bytes=bound, cell_rows=9)
        assert {r.id: (r.nb_total, r.nb_a) for r in got.collect()} == want


def test_points_without_usable_coordinates(spark):
    nan = float("nan")
    rows = [(1, None, 2.0), (2, 48.0, None), (3, nan, 2.0), (4, 48.0, nan), (5, 95.0, 2.0), (6, 48.0, float("inf")), (7, 48.0, 2.0)]
    pts = spark.createDataFrame([(*r, "x") for r in rows], "id long, latitude double, longitude double, note string")
    plc = spark.createDataFrame([(48.0, 2.0), (None, 2.0), (nan, nan), (95.0, 2.0)], "latitude double, longitude double")
    ring = [(1.0, 47.0), (3.0, 47.0), (2.0, 49.0), (1.0, 47.0)]
    poly = spark.createDataFrame([(4, ring)], "id long, ring array<struct<lon:double,lat:double>>")
    for bound in BOUNDS:
        got = spatial.count_within_radius(pts, plc, 500.0, max_broadcast_bytes=bound, mean_km_col="km").collect()
        assert sorted((r.id, r.nb_total, r.km, r.note) for r in got) == [(i, 0, None, "x") for i in range(1, 7)] + [(7, 1, 0.0, "x")]
        got = spatial.locate_in_polygons(pts, poly, max_broadcast_bytes=bound).collect()
        assert sorted((r.id, r.quartier_id) for r in got) == [(i, None) for i in range(1, 7)] + [(7, 4)]
    empty = pts.where("false")
    for bound in BOUNDS:
        assert spatial.count_within_radius(empty, plc, 500.0, max_broadcast_bytes=bound).count() == 0
        assert {r.nb_total for r in spatial.count_within_radius(pts, plc.where("false"), 500.0, max_broadcast_bytes=bound).collect()} == {0}


def test_hot_cell_is_cut_into_pieces(spark):
    # a third of the points in one cell, a third without coordinates
    pts = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, 48.85).when(F.col("id") % 3 == 1, 40 + F.col("id") % 97 / 10.0).alias("latitude"),
                                   F.when(F.col("id") % 3 != 2, 2.35).alias("longitude"))
    plc = spark.range(60).select((40 + F.col("id") * 0.15).alias("latitude"), F.lit(2.35).alias("longitude"))
    p = pts.withColumns(spatial._point_cell("latitude", "longitude", 3000.0))
    side = spatial._place_cells(plc.select(F.col("latitude").alias("_plat"), F.col("longitude").alias("_plon")), 3000.0)
    a, b = spatial._split_hot_cells(p, side, "id", 1, 100)
    sizes = {tuple(r)[:3]: r["count"] for r in a.groupBy("_cx", "_cy", "_salt").count().collect()}
    hot = [n for (cx, _, _), n in sizes.items() if cx is not None]
    assert max(hot) < 200 and len([n for (cx, _, _), n in sizes.items() if cx is None]) > 1000
    assert a.count() == 6000 and b.count() < side.count() * 21      # only the hot cells' places are copied
    x, y = ({r.id: r.nb_total for r in spatial.count_within_radius(pts, plc, 3000.0, max_broadcast_bytes=bound, cell_rows=100).collect()}
            for bound in BOUNDS)
    assert x == y and len(x) == 6000 and x[0] > 0


def test_rings_of_any_shape(spark):
    rng = random.Random(3)
    rings = {1: [(0.0, 0.0), (3.0, 0.2), (1.2, 1.1), (2.9, 3.0), (0.1, 2.5)],             # not convex
             2: [(1.0, 1.0), (4.0, 1.0), (2.5, 4.0)], 3: [(-2.0, -1.0), (0.5, -1.5), (0.4, 0.6), (-1.8, 0.3)]}

    def inside(ring, x, y):
        hit = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                hit = not hit
        return hit

    pts = [(i, rng.uniform(-2, 4.5), rng.uniform(-2.5, 4.5)) for i in range(400)]
    want = {i: min((k for k, ring in rings.items() if inside(ring, x, y)), default=None) for i, y, x in pts}
    assert set(want.values()) == {None, 1, 2, 3}
    p = spark.createDataFrame(pts, "id long, latitude double, longitude double")
    q = spark.createDataFrame([(k, ring + ring[:1]) for k, ring in rings.items()], "id long, ring array<struct<lon:double,lat:double>>")
    for bound in BOUNDS:
        got = spatial.locate_in_polygons(p, q, max_broadcast_bytes=bound, cell_rows=5)
        assert {r.id: r.quartier_id for r in got.collect()} == want
