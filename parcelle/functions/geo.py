"""Geographic column expressions (G1, G2, polygon predicates).

Spark 4.1 has no distance / contains functions, so these are built from
built-in math and higher-order array functions; they stay inside whole-stage
code generation and never call Python.

Distances use a sphere of radius 6371 km.  The reference measured on the
WGS84 ellipsoid; the spherical figure differs by up to about 0.5 %.
Polygons are rings ``array<struct<lon:double, lat:double>>`` whose last
vertex repeats the first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EARTH_RADIUS_KM = 6371.0
METRES_PER_DEGREE = EARTH_RADIUS_KM * 1000.0 * math.pi / 180.0


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km (haversine, R = 6371 km)."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dl = F.radians(_c(lon2)) - F.radians(_c(lon1))
    s1, s2 = F.sin(dphi / 2), F.sin(dl / 2)
    a = s1 * s1 + F.cos(p1) * F.cos(p2) * (s2 * s2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def cosine_law_km(lat1, lon1, lat2, lon2) -> Column:
    """Spherical law of cosines, argument clamped to [-1, 1]."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    x = (F.cos(p1) * F.cos(p2) * F.cos(F.radians(_c(lon2)) - F.radians(_c(lon1)))
         + F.sin(p1) * F.sin(p2))
    return F.lit(EARTH_RADIUS_KM) * F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x)))


def _edges(ring: Column):
    """Index sequence over the ring's edges (0 .. n-2)."""
    return F.sequence(F.lit(0), F.size(ring) - 2)


def ring_crossings(ring: str | Column, lon: str | Column, lat: str | Column) -> Column:
    """Number of ring edges a ray from the point towards +lon crosses."""
    ring, x, y = _c(ring), _c(lon), _c(lat)

    def step(acc, i):
        a, b = F.get(ring, i), F.get(ring, i + 1)
        straddles = (a["lat"] > y) != (b["lat"] > y)
        x_at = (b["lon"] - a["lon"]) * (y - a["lat"]) / (b["lat"] - a["lat"]) + a["lon"]
        return acc + F.when(straddles & (x < x_at), 1).otherwise(0)

    return F.aggregate(_edges(ring), F.lit(0), step)


def on_ring(ring: str | Column, lon: str | Column, lat: str | Column) -> Column:
    """True when the point lies exactly on an edge of the ring."""
    ring, x, y = _c(ring), _c(lon), _c(lat)

    def on_edge(i):
        a, b = F.get(ring, i), F.get(ring, i + 1)
        cross = (b["lon"] - a["lon"]) * (y - a["lat"]) - (b["lat"] - a["lat"]) * (x - a["lon"])
        return ((cross == 0)
                & (x >= F.least(a["lon"], b["lon"])) & (x <= F.greatest(a["lon"], b["lon"]))
                & (y >= F.least(a["lat"], b["lat"])) & (y <= F.greatest(a["lat"], b["lat"])))

    return F.exists(_edges(ring), on_edge)


def ring_contains(ring: str | Column, lon: str | Column, lat: str | Column) -> Column:
    """G4 predicate: point strictly inside the ring (even-odd rule; a point on
    the boundary is not contained, as for ST_Contains)."""
    return ((ring_crossings(ring, lon, lat) % 2) == 1) & ~on_ring(ring, lon, lat)


def ring_distance_m(ring: str | Column, lon: str | Column, lat: str | Column) -> Column:
    """Distance in metres from a point to a polygon: 0 inside or on the
    boundary, else the least distance to an edge, measured on a flat
    projection centred on the point (metres per degree of the 6371 km sphere,
    longitude scaled by cos(latitude))."""
    ring, x, y = _c(ring), _c(lon), _c(lat)
    kx = F.cos(F.radians(y)) * METRES_PER_DEGREE
    ky = F.lit(METRES_PER_DEGREE)

    def seg(i):
        a, b = F.get(ring, i), F.get(ring, i + 1)
        ax, ay = (a["lon"] - x) * kx, (a["lat"] - y) * ky
        bx, by = (b["lon"] - x) * kx, (b["lat"] - y) * ky
        dx, dy = bx - ax, by - ay
        len2 = dx * dx + dy * dy
        t = F.when(len2 > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(ax * dx + ay * dy) / len2))) \
             .otherwise(F.lit(0.0))
        px, py = ax + t * dx, ay + t * dy
        return F.sqrt(px * px + py * py)

    nearest = F.array_min(F.transform(_edges(ring), seg))
    inside = ((ring_crossings(ring, x, y) % 2) == 1) | on_ring(ring, x, y)
    return F.when(inside, F.lit(0.0)).otherwise(nearest)


def ring_bbox(ring: str | Column) -> dict[str, Column]:
    ring = _c(ring)
    return {
        "min_lon": F.array_min(F.transform(ring, lambda p: p["lon"])),
        "max_lon": F.array_max(F.transform(ring, lambda p: p["lon"])),
        "min_lat": F.array_min(F.transform(ring, lambda p: p["lat"])),
        "max_lat": F.array_max(F.transform(ring, lambda p: p["lat"])),
    }


# SQL twins (DuckDB, 1-based lists) used by the oracles.
def sql_haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    s1 = f"sin((radians({lat2}) - radians({lat1})) / 2)"
    s2 = f"sin((radians({lon2}) - radians({lon1})) / 2)"
    return (f"({2 * EARTH_RADIUS_KM} * asin(sqrt(least(1.0, {s1} * {s1}"
            f" + cos(radians({lat1})) * cos(radians({lat2})) * ({s2} * {s2})))))")


def sql_cosine_law_km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"({EARTH_RADIUS_KM} * acos(greatest(-1.0, least(1.0, cos(radians({lat1})) * cos(radians({lat2}))"
            f" * cos(radians({lon2}) - radians({lon1})) + sin(radians({lat1})) * sin(radians({lat2}))))))")


def sql_crossings(ring: str, x: str, y: str) -> str:
    a, b = f"{ring}[i + 1]", f"{ring}[i + 2]"
    return (f"list_sum(list_transform(range(len({ring}) - 1), lambda i: CASE WHEN ({a}.lat > {y}) <> ({b}.lat > {y})"
            f" AND {x} < ({b}.lon - {a}.lon) * ({y} - {a}.lat) / ({b}.lat - {a}.lat) + {a}.lon THEN 1 ELSE 0 END))")


def sql_on_ring(ring: str, x: str, y: str) -> str:
    a, b = f"{ring}[i + 1]", f"{ring}[i + 2]"
    return (f"list_bool_or(list_transform(range(len({ring}) - 1), lambda i: "
            f"({b}.lon - {a}.lon) * ({y} - {a}.lat) - ({b}.lat - {a}.lat) * ({x} - {a}.lon) = 0"
            f" AND {x} >= least({a}.lon, {b}.lon) AND {x} <= greatest({a}.lon, {b}.lon)"
            f" AND {y} >= least({a}.lat, {b}.lat) AND {y} <= greatest({a}.lat, {b}.lat)))")


def sql_contains(ring: str, x: str, y: str) -> str:
    return f"({sql_crossings(ring, x, y)} % 2 = 1 AND NOT {sql_on_ring(ring, x, y)})"


def sql_ring_distance_m(ring: str, x: str, y: str) -> str:
    kx = f"(cos(radians({y})) * {METRES_PER_DEGREE!r})"
    ky = f"{METRES_PER_DEGREE!r}"
    a, b = f"{ring}[i + 1]", f"{ring}[i + 2]"
    ax, ay = f"(({a}.lon - {x}) * {kx})", f"(({a}.lat - {y}) * {ky})"
    bx, by = f"(({b}.lon - {x}) * {kx})", f"(({b}.lat - {y}) * {ky})"
    dx, dy = f"({bx} - {ax})", f"({by} - {ay})"
    len2 = f"({dx} * {dx} + {dy} * {dy})"
    t = f"(CASE WHEN {len2} > 0 THEN greatest(0.0, least(1.0, -({ax} * {dx} + {ay} * {dy}) / {len2})) ELSE 0.0 END)"
    px, py = f"({ax} + {t} * {dx})", f"({ay} + {t} * {dy})"
    nearest = f"list_min(list_transform(range(len({ring}) - 1), lambda i: sqrt({px} * {px} + {py} * {py})))"
    inside = f"({sql_crossings(ring, x, y)} % 2 = 1 OR {sql_on_ring(ring, x, y)})"
    return f"(CASE WHEN {inside} THEN 0.0 ELSE {nearest} END)"


# WGS84 ellipsoid.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
WGS84_B = (1 - WGS84_F) * WGS84_A
VINCENTY_ITERATIONS = 10


def _let(value: Column, body) -> Column:
    """Bind ``value`` once and use it in ``body`` (a one-element ``transform``),
    so that repeated sub-expressions are not copied into the plan."""
    return F.get(F.transform(F.array(value), body), 0)


def geodesic_km(lat1, lon1, lat2, lon2) -> Column:
    """Distance in km on the WGS84 ellipsoid (Vincenty's inverse formula with a
    fixed iteration count, as a higher-order ``aggregate``): the figure a
    geography distance gives, for callers that need better than the ~0.5 % of
    the spherical G1.  Coincident points give 0."""
    f = WGS84_F
    row = F.struct(
        F.atan((1 - f) * F.tan(F.radians(_c(lat1)))).alias("u1"),
        F.atan((1 - f) * F.tan(F.radians(_c(lat2)))).alias("u2"),
        (F.radians(_c(lon2)) - F.radians(_c(lon1))).alias("L"))

    def terms(r, lam, use):
        trig = F.struct(F.sin(r["u1"]).alias("su1"), F.cos(r["u1"]).alias("cu1"), F.sin(r["u2"]).alias("su2"),
                        F.cos(r["u2"]).alias("cu2"), F.sin(lam).alias("sl"), F.cos(lam).alias("cl"))

        def with_trig(t):
            a = t["cu2"] * t["sl"]
            b = t["cu1"] * t["su2"] - t["su1"] * t["cu2"] * t["cl"]
            sc = F.struct(F.sqrt(a * a + b * b).alias("sin_s"),
                          (t["su1"] * t["su2"] + t["cu1"] * t["cu2"] * t["cl"]).alias("cos_s"))

            def with_sigma(x):
                sin_a = F.when(x["sin_s"] == 0, F.lit(0.0)).otherwise(t["cu1"] * t["cu2"] * t["sl"] / x["sin_s"])
                return _let(F.struct(x["sin_s"].alias("sin_s"), x["cos_s"].alias("cos_s"),
                                     F.atan2(x["sin_s"], x["cos_s"]).alias("sigma"), sin_a.alias("sin_a"),
                                     (F.lit(1.0) - sin_a * sin_a).alias("cos2_a")),
                            lambda y: use(_let(F.struct(
                                y["sin_s"].alias("sin_s"), y["cos_s"].alias("cos_s"), y["sigma"].alias("sigma"),
                                y["sin_a"].alias("sin_a"), y["cos2_a"].alias("cos2_a"),
                                F.when(y["cos2_a"] == 0, F.lit(0.0))
                                 .otherwise(y["cos_s"] - 2 * t["su1"] * t["su2"] / y["cos2_a"]).alias("c2sm")),
                                lambda z: z)))
            return _let(sc, with_sigma)
        return _let(trig, with_trig)

    def step(r):
        def update(lam, _i):
            def new_lam(z):
                c = f / 16 * z["cos2_a"] * (4 + f * (4 - 3 * z["cos2_a"]))
                return r["L"] + (1 - c) * f * z["sin_a"] * (
                    z["sigma"] + c * z["sin_s"] * (z["c2sm"] + c * z["cos_s"] * (-1 + 2 * z["c2sm"] * z["c2sm"])))
            return terms(r, lam, new_lam)
        return F.aggregate(F.sequence(F.lit(1), F.lit(VINCENTY_ITERATIONS)), r["L"], update)

    def distance(r):
        def final(z):
            u_sq = z["cos2_a"] * ((WGS84_A ** 2 - WGS84_B ** 2) / WGS84_B ** 2)
            big_a = 1 + u_sq / 16384 * (4096 + u_sq * (-768 + u_sq * (320 - 175 * u_sq)))
            big_b = u_sq / 1024 * (256 + u_sq * (-128 + u_sq * (74 - 47 * u_sq)))
            c2 = z["c2sm"]
            d_sigma = big_b * z["sin_s"] * (c2 + big_b / 4 * (
                z["cos_s"] * (-1 + 2 * c2 * c2) - big_b / 6 * c2 * (-3 + 4 * z["sin_s"] * z["sin_s"]) * (-3 + 4 * c2 * c2)))
            return F.when(z["sin_s"] == 0, F.lit(0.0)).otherwise(WGS84_B * big_a * (z["sigma"] - d_sigma) / 1000.0)
        return _let(step(r), lambda lam: terms(r, lam, final))

    return _let(row, distance)
