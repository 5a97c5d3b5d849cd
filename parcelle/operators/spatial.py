"""Spatial joins on a grid (G3, G4, G5, J14, J15) without quadratic plans.

A correlated "count places within N metres" or "polygon containing point"
would plan as a nested-loop join.  Here both sides get grid-cell keys and meet
in an equi-join, then the exact predicate filters the candidates:

* radius: the globe is cut into latitude bands at least the radius high, each band
  into equal longitude cells, as many as keep a cell at least as wide as the radius
  reaches at the band's highest latitude (one cell where the circle holds a pole).
  A place is copied into its own cell and the neighbours of its longitude in three
  bands, counted round the globe, so places across +-180 degrees and near the poles
  are found; each point has exactly one cell;
* polygons: each polygon is copied into the cells its bounding box covers.

When the place / polygon side passes the broadcast size check it is grouped
into one candidate list per cell and broadcast; each point looks up its own
cell and filters the list with higher-order functions, so the (large) point
side is neither shuffled nor re-aggregated: a map-only stage.

Otherwise both sides are shuffled on (cell, salt).  The points of each cell are
counted first; a cell with more than ``cell_rows`` points is cut into pieces of about
that size by a hash of the point's id, and the places or polygons of that cell (no
other) are copied once a piece.  Points without usable coordinates match nothing and
are spread over ``NO_CELL_PIECES`` pieces by the same hash.  After the join, rows of one
point share (cell, salt), so the per-point aggregate reuses the join's hash
partitioning instead of shuffling again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.functions import geo as G
from parcelle.plans.sizing import DEFAULT_MAX_BROADCAST_BYTES, estimated_bytes, measured_side

#: Points of one cell that one task handles.
CELL_ROWS = 1_000_000
#: Pieces over which points without coordinates are spread.
NO_CELL_PIECES = 4096


def _fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
                   row_bytes: Column | None = None, max_rows: int = 2_000_000) -> bool:
    """Size check for the broadcast path.  The candidate sides here are made
    by ``explode`` (cells per place / per polygon), whose optimizer estimate
    does not grow with the number of generated rows, so they are measured: a
    bounded job over at most ``max_rows + 1`` rows that sums ``row_bytes``.
    Without ``row_bytes`` the optimizer's estimate decides."""
    if max_bytes <= 0:
        return False
    if row_bytes is None:
        size = estimated_bytes(df)
        return size is not None and size <= max_bytes
    m = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes).alias("b")).first()
    return m["n"] <= max_rows and (m["b"] or 0) <= max_bytes


def _usable(lat: str, lon: str) -> Column:
    """Both coordinates present and finite, the latitude within +-90 degrees."""
    return F.coalesce(F.col(lat).between(-90, 90) & (F.abs(F.col(lon)) < F.lit(math.inf)), F.lit(False))


def _reach_degrees(radius_m: float, abs_lat: Column) -> Column:
    """How far in longitude a circle around a point at ``abs_lat`` reaches; NULL where
    it holds a pole."""
    angle = radius_m / (G.EARTH_RADIUS_KM * 1000.0)
    if angle >= math.pi / 2:
        return F.lit(None).cast("double")
    s, c = F.lit(math.sin(angle)), F.cos(F.radians(abs_lat))
    return F.when((abs_lat < 90) & (c > s), F.degrees(F.asin(s / c)))


def _band_height(radius_m: float, margin: float = 1.02) -> float:
    return radius_m / G.METRES_PER_DEGREE * margin


def _cells_in_band(band: Column, radius_m: float, margin: float = 1.02) -> Column:
    """Number of longitude cells of a latitude band."""
    h = _band_height(radius_m, margin)
    top = F.greatest(F.abs(band * h), F.abs((band + 1) * h))
    return F.coalesce(F.greatest(F.lit(1).cast("long"), F.floor(360.0 / (_reach_degrees(radius_m, top) * margin))),
                      F.lit(1).cast("long"))


def _lon_cell(lon: Column, cells: Column) -> Column:
    return F.least(F.floor(F.pmod(lon + 180.0, F.lit(360.0)) * cells / 360.0), cells - 1)


def _point_cell(lat: str, lon: str, radius_m: float) -> dict[str, Column]:
    """The radius join's cell of a point, NULL without usable coordinates."""
    band = F.floor(F.col(lat) / _band_height(radius_m))
    ok = _usable(lat, lon)
    return {"_cx": F.when(ok, _lon_cell(F.col(lon), _cells_in_band(band, radius_m))), "_cy": F.when(ok, band)}


def _place_cells(places: DataFrame, radius_m: float) -> DataFrame:
    """One row per place (``_plat``, ``_plon``) and cell whose points it may be near."""
    band = F.floor(F.col("_plat") / _band_height(radius_m))
    c, n = F.col("_c0"), F.col("_n")
    return (places.withColumn("_cy", F.explode(F.sequence(band - 1, band + 1)))
                  .withColumn("_n", _cells_in_band(F.col("_cy"), radius_m))
                  .withColumn("_c0", _lon_cell(F.col("_plon"), n))
                  .withColumn("_cx", F.explode(F.array_distinct(F.array(F.pmod(c - 1, n), c, F.pmod(c + 1, n)))))
                  .drop("_n", "_c0"))


def _split_hot_cells(points: DataFrame, side: DataFrame, id_col: str, least: int,
                     cell_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a cell join with a ``_salt``: points by the hash of their id over as
    many pieces as their cell's count asks for (at least ``least``), the other side copied
    to every piece of its cell.  The table of hot cells is written once (one count over the
    points' cells); it has at most points / ``cell_rows`` rows and is broadcast behind a
    check of its rows."""
    hot = (points.where(F.col("_cx").isNotNull()).groupBy("_cx", "_cy").agg(F.count(F.lit(1)).alias("_k"))
                 .where(F.col("_k") > cell_rows).withColumn("_k", F.ceil(F.col("_k") / cell_rows)))
    hot, small = measured_side(hot, "hot-cells")
    if small:
        hot = F.broadcast(hot)
    pieces = F.greatest(F.lit(max(1, least)).cast("long"), F.coalesce(F.col("_k"), F.lit(1)))
    pieces_of_point = F.when(F.col("_cx").isNull(), F.lit(NO_CELL_PIECES).cast("long")).otherwise(pieces)
    p = (points.join(hot, ["_cx", "_cy"], "left")
               .withColumn("_salt", F.pmod(F.xxhash64(F.col(id_col)), pieces_of_point)).drop("_k"))
    q = (side.join(hot, ["_cx", "_cy"], "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1))).drop("_k"))
    return p.select(*points.columns, "_salt"), q.select(*side.columns, "_salt")


def _per_point(joined: DataFrame, point_cols: Sequence[str], id_col: str, aggs: list[Column]) -> DataFrame:
    payload = [F.any_value(c).alias(c) for c in point_cols if c != id_col]
    return (joined.groupBy("_cx", "_cy", "_salt", id_col).agg(*payload, *aggs)
                  .drop("_cx", "_cy", "_salt"))


def count_within_radius(points: DataFrame, places: DataFrame, radius_m: float, *, id_col: str = "id",
                        lat: str = "latitude", lon: str = "longitude", place_lat: str = "latitude",
                        place_lon: str = "longitude", type_col: str | None = None,
                        types: Sequence[str] = (), out_prefix: str = "nb_", salt_buckets: int = 1,
                        mean_km_col: str | None = None, cell_rows: int = CELL_ROWS,
                        max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """For every point, the number of places within ``radius_m``
    metres (haversine), in total and per listed type, in one join.
    Points without usable coordinates (missing, not finite, latitude beyond 90) or
    without places nearby get 0; such places count nowhere.  ``salt_buckets`` is the least
    number of pieces of a cell on the shuffled path.  With ``mean_km_col`` also the mean distance in km to those places (NULL if none)."""
    pcols = points.columns
    p = points.withColumns(_point_cell(lat, lon, radius_m))
    sel = [F.col(place_lat).alias("_plat"), F.col(place_lon).alias("_plon")]
    if type_col:
        sel.append(F.col(type_col).alias("_ptype"))
    q = _place_cells(places.where(_usable(place_lat, place_lon)).select(*sel), radius_m)
    width = F.lit(48) + (F.coalesce(F.octet_length("_ptype"), F.lit(0)) if type_col else 0)
    if _fits_broadcast(q, max_broadcast_bytes, row_bytes=width):
        # Small place side: one row per cell holding that cell's candidates,
        # broadcast; each point reads its own cell.  Map-only: the points are
        # never shuffled and no per-point aggregate is needed.
        fields = [F.col("_plat").alias("lat"), F.col("_plon").alias("lon")]
        if type_col:
            fields.append(F.col("_ptype").alias("t"))
        cells = q.groupBy("_cx", "_cy").agg(F.collect_list(F.struct(*fields)).alias("_cands"))
        j = p.join(F.broadcast(cells), ["_cx", "_cy"], "left")
        hits = F.filter(F.coalesce(F.col("_cands"), F.array().cast(cells.schema["_cands"].dataType)),
                        lambda c: G.haversine_km(F.col(lat), F.col(lon), c["lat"], c["lon"]) * 1000.0 <= radius_m)
        cols = {f"{out_prefix}total": F.size(hits).cast("long")}
        def of_type(t: str):
            return lambda c: c["t"] == F.lit(t)

        for t in types:
            cols[f"{out_prefix}{t}"] = F.size(F.filter(hits, of_type(t))).cast("long")
        if mean_km_col:
            d = F.transform(hits, lambda c: G.haversine_km(F.col(lat), F.col(lon), c["lat"], c["lon"]))
            cols[mean_km_col] = F.when(F.size(hits) > 0, F.aggregate(d, F.lit(0.0), lambda a, x: a + x) / F.size(hits))
        return j.withColumns(cols).drop("_cx", "_cy", "_cands")
    p, q = _split_hot_cells(p, q, id_col, salt_buckets, cell_rows)
    near = G.haversine_km(F.col(lat), F.col(lon), F.col("_plat"), F.col("_plon")) * 1000.0 <= radius_m
    cond = [p["_cx"] == q["_cx"], p["_cy"] == q["_cy"], p["_salt"] == q["_salt"], near]
    j = p.join(q, cond, "left").select(p["*"], q["_plat"], q["_plon"], *([q["_ptype"]] if type_col else []))
    aggs = [F.count("_plat").alias(f"{out_prefix}total")]
    for t in types:
        aggs.append(F.count_if(F.col("_ptype") == t).alias(f"{out_prefix}{t}"))
    if mean_km_col:
        km = F.when(F.col("_plat").isNotNull(), G.haversine_km(F.col(lat), F.col(lon), F.col("_plat"), F.col("_plon")))
        aggs.append(F.avg(km).alias(mean_km_col))
    return _per_point(j, pcols, id_col, aggs)


def polygon_cells(polygons: DataFrame, ring_col: str, cell_deg: float, pad_m: float = 0.0) -> DataFrame:
    """One row per (polygon, grid cell touched by its bounding box, widened by ``pad_m``
    metres: in longitude as far as that reaches at the box's highest latitude)."""
    bb = G.ring_bbox(ring_col)
    pad_lat, pad_lon = F.lit(0.0), F.lit(0.0)
    if pad_m > 0:
        pad_lat = F.lit(_band_height(pad_m))
        top = F.greatest(F.abs(bb["min_lat"] - pad_lat), F.abs(bb["max_lat"] + pad_lat))
        pad_lon = F.coalesce(_reach_degrees(pad_m, top) * 1.02, F.lit(180.0))
    cx = F.sequence(F.floor((bb["min_lon"] - pad_lon) / cell_deg), F.floor((bb["max_lon"] + pad_lon) / cell_deg))
    cy = F.sequence(F.floor((bb["min_lat"] - pad_lat) / cell_deg), F.floor((bb["max_lat"] + pad_lat) / cell_deg))
    return (polygons.withColumn("_cx", F.explode(cx)).withColumn("_cy", F.explode(cy)))


def locate_in_polygons(points: DataFrame, polygons: DataFrame, *, id_col: str = "id", lat: str = "latitude",
                       lon: str = "longitude", poly_id: str = "id", ring_col: str = "ring",
                       out_col: str = "quartier_id", cell_deg: float = 0.1, salt_buckets: int = 1,
                       cell_rows: int = CELL_ROWS, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Attach the least id of the polygons strictly containing each
    point (NULL when none, or without usable coordinates).  Rings are flat: one across
    +-180 degrees is given as two.  ``salt_buckets`` as in ``count_within_radius``."""
    pcols = points.columns
    ok = _usable(lat, lon)
    p = points.withColumns({"_cx": F.when(ok, F.floor(F.col(lon) / cell_deg)),
                            "_cy": F.when(ok, F.floor(F.col(lat) / cell_deg))})
    q = polygon_cells(polygons.select(F.col(poly_id).alias("_qid"), F.col(ring_col).alias("_ring")),
                      "_ring", cell_deg)
    if _fits_broadcast(q, max_broadcast_bytes, row_bytes=F.size("_ring") * 16 + 32):
        # Small polygon side: per-cell candidate lists, broadcast, map-only probe.
        cells = q.groupBy("_cx", "_cy").agg(F.collect_list(F.struct(F.col("_qid").alias("id"),
                                                                     F.col("_ring").alias("ring"))).alias("_cands"))
        j = p.join(F.broadcast(cells), ["_cx", "_cy"], "left")
        inside = F.filter(F.coalesce(F.col("_cands"), F.array().cast(cells.schema["_cands"].dataType)),
                          lambda c: G.ring_contains(c["ring"], F.col(lon), F.col(lat)))
        return j.withColumn(out_col, F.array_min(F.transform(inside, lambda c: c["id"]))) \
                .drop("_cx", "_cy", "_cands")
    p, q = _split_hot_cells(p, q, id_col, salt_buckets, cell_rows)
    cond = [p["_cx"] == q["_cx"], p["_cy"] == q["_cy"], p["_salt"] == q["_salt"],
            G.ring_contains(q["_ring"], p[lon], p[lat])]
    j = p.join(q, cond, "left").select(p["*"], q["_qid"])
    return _per_point(j, pcols, id_col, [F.min("_qid").alias(out_col)])


def count_near_polygons(polygons: DataFrame, places: DataFrame, radius_m: float, *, poly_id: str = "id",
                        ring_col: str = "ring", place_lat: str = "latitude", place_lon: str = "longitude",
                        type_col: str = "type_poi", types: Sequence[str] = (), out_prefix: str = "nb_",
                        cell_deg: float = 0.1) -> DataFrame:
    """G3 on areas: per polygon, places whose distance to the polygon (0 when
    inside) is at most ``radius_m``; one count column per type.  Polygons
    with no place nearby are returned with 0."""
    q = polygon_cells(polygons.select(F.col(poly_id).alias("_qid"), F.col(ring_col).alias("_ring")),
                      "_ring", cell_deg, radius_m)
    p = (places.where(_usable(place_lat, place_lon))
               .select(F.col(place_lat).alias("_plat"), F.col(place_lon).alias("_plon"),
                       F.col(type_col).alias("_ptype"))
               .withColumns({"_cx": F.floor(F.col("_plon") / cell_deg), "_cy": F.floor(F.col("_plat") / cell_deg)}))
    q = F.broadcast(q) if _fits_broadcast(q, row_bytes=F.size("_ring") * 16 + 32) else q
    j = (p.join(q, ["_cx", "_cy"], "inner")
          .where(G.ring_distance_m(F.col("_ring"), F.col("_plon"), F.col("_plat")) <= radius_m))
    counts = j.groupBy("_qid").agg(*[F.count_if(F.col("_ptype") == t).alias(f"{out_prefix}{t}") for t in types])
    base = polygons.select(F.col(poly_id).alias("_qid"))
    out = base.join(counts, "_qid", "left")
    return out.select(F.col("_qid").alias(poly_id),
                      *[F.coalesce(F.col(f"{out_prefix}{t}"), F.lit(0)).cast("long").alias(f"{out_prefix}{t}")
                        for t in types])


def ring_centre(ring_col: str) -> dict[str, Column]:
    """Mean of the ring's vertices (closing vertex excluded)."""
    open_ring = F.slice(F.col(ring_col), 1, F.size(ring_col) - 1)
    n = F.size(open_ring)
    return {"lon": F.aggregate(open_ring, F.lit(0.0), lambda a, v: a + v["lon"]) / n,
            "lat": F.aggregate(open_ring, F.lit(0.0), lambda a, v: a + v["lat"]) / n}


# Declared district columns filled from place types.
DISTRICT_TYPE_COLUMNS = {"commerce": "nb_commerces", "ecole": "nb_ecoles", "parc": "nb_parcs"}


def district_attributes(quartiers: DataFrame, places: DataFrame, radius_m: float = 500.0,
                        transport_radius_m: float = 1000.0, type_col: str = "type_poi",
                        transport_type: str = "transport", type_columns: dict | None = None) -> DataFrame:
    """Declared district columns (never computed by the warehouse code):
    place counts by type within ``radius_m`` of the district polygon, and
    ``proximite_transports`` = mean distance (km) from the district centre to
    the transport places within ``transport_radius_m``."""
    type_columns = DISTRICT_TYPE_COLUMNS if type_columns is None else type_columns
    counts = count_near_polygons(quartiers, places, radius_m, type_col=type_col, types=list(type_columns),
                                 out_prefix="_n_")
    counts = counts.select("id", *[F.col(f"_n_{t}").alias(c) for t, c in type_columns.items()])
    c = ring_centre("ring")
    centres = quartiers.select("id", c["lat"].alias("latitude"), c["lon"].alias("longitude"))
    transports = places.where(F.col(type_col) == transport_type)
    prox = count_within_radius(centres, transports, transport_radius_m, mean_km_col="proximite_transports")
    return counts.join(prox.select("id", "proximite_transports"), "id", "left")
