"""Hand-made edge tables per operator (see FIXTURES.md)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from parcelle.functions import derive as D
from parcelle.functions import geo as G
from parcelle.functions import parse as P
from parcelle.operators import clean as C
from parcelle.operators import link as L
from parcelle.operators import spatial


def test_parse_dates_numbers_codes(spark):
    rows = [("05/01/2023", "250000,50", "75", "117", "75011.0", "45,5", "3.7"),
            ("25/01/2023", "1 250 000,00", "1", "4.0", "1000", "45", "3.0"),
            ("2023-01-05", "nan", "2A", "1", None, "0", "x"),
            ("31/02/2023", "abc", "971", "101", "", None, None),
            ("", "-5", "75.0", None, None, "abc", "0")]
    df = spark.createDataFrame(rows, "d string, p string, dep string, com string, cp string, s string, n string")
    out = df.select(P.parse_date("d").alias("d"), P.parse_number("p").alias("p"),
                    P.commune_code("dep", "com").alias("code"), P.postal_code("cp").alias("cp"),
                    P.to_double("s").alias("s"), P.to_int("n").alias("n")).collect()
    assert [r.d for r in out] == [dt.date(2023, 1, 5), dt.date(2023, 1, 25), dt.date(2023, 1, 5), None, None]
    assert [r.p for r in out] == [250000.5, 1250000.0, None, None, -5.0]
    assert [r.code for r in out] == ["75117", "01004", "2A001", "97101", None]
    assert [r.cp for r in out] == ["75011", "01000", None, None, None]
    assert [r.s for r in out] == [None, 45.0, 0.0, None, None]
    assert [r.n for r in out] == [3, 3, None, None, 0]


def test_dedupe_keeps_lowest_id_and_null_commune_rows(spark):
    d = dt.date(2023, 1, 1)
    rows = [(1, d, 100000.0, "75056", None, "Maison"), (2, d, 100000.0, "75056", 0.0, "Maison"),
            (3, d, 100000.0, "75056", None, None), (4, d, 100000.0, "75056", None, ""),
            (5, d, 100000.0, None, 50.0, "Maison"), (6, d, 100000.0, None, 50.0, "Maison")]
    df = spark.createDataFrame(rows, "id long, date_mutation date, valeur_fonciere double, code_commune string, "
                                     "surface_reelle_bati double, type_local string")
    kept = sorted(r.id for r in C.remove_duplicates(df).collect())
    assert kept == [1, 3, 5, 6]
    again = sorted(r.id for r in C.remove_duplicates(C.remove_duplicates(df)).collect())
    assert again == kept  # idempotent


def test_quality_score_and_bands(spark):
    df = spark.range(200).select(
        F.col("id"), F.when(F.col("id") % 2 == 0, "Maison").alias("type_local"),
        F.when(F.col("id") % 3 == 0, F.lit(40.0)).alias("surface_reelle_bati"),
        F.lit(None).cast("int").alias("nb_pieces"), F.lit("75011").alias("code_postal"),
        F.col("id").alias("commune_id"), F.when(F.col("id") % 5 == 0, F.lit(48.0)).alias("latitude"),
        F.lit(None).cast("double").alias("prix_m2"), F.lit(None).cast("string").alias("adresse_nom_voie"),
        F.lit(None).cast("double").alias("distance_centre_ville"))
    scored = df.withColumn("s", D.quality_score())
    lo, hi = scored.agg(F.min("s"), F.max("s")).first()
    assert 50 <= lo <= hi <= 100
    bands = C.quality_bands(scored, "s").collect()
    assert sum(r.nb for r in bands) == 200
    assert math.isclose(sum(r.pct for r in bands), 100.0)


def test_size_band_and_type_code(spark):
    df = spark.createDataFrame([(10.0, "Appartement"), (45.0, "Maison"), (46.0, "Local commercial"),
                                (120.0, "Dépendance"), (500.0, "x"), (None, None)], "a double, t string")
    out = df.select(D.size_band("a").alias("b"), D.type_code("t").alias("c")).collect()
    assert [r.b for r in out] == ["Studio", "Petit", "Moyen", "Grand", "Très grand", None]
    assert [r.c for r in out] == [1, 2, 3, 4, 0, 0]


def test_ratio_modes(spark):
    df = spark.createDataFrame([(1, 100000.0, 50.0), (2, 100000.0, 1000.0), (3, 100000.0, None), (4, 1e6, 10.0)],
                               "id long, valeur_fonciere double, surface_reelle_bati double")
    drop = sorted(r.id for r in C.filter_ratio(df, mode="drop").collect())
    assert drop == [1, 3]
    null = {r.id: r.prix_m2 for r in C.filter_ratio(df, mode="null").collect()}
    assert null == {1: 2000.0, 2: None, 3: None, 4: None}


def test_link_cascade_first_hit_and_least_id(spark):
    communes = spark.createDataFrame([(1, "01001", "01000"), (2, "01002", "01000"), (3, "75056", "75000")],
                                     "id long, code_commune string, code_postal string")
    sales = spark.createDataFrame([(10, "01002", None, None), (11, "1002", None, None), (12, "zzz", "01000", None),
                                   (13, "zzz", "99999", None), (14, "75056", None, 7)],
                                  "id long, code_commune string, code_postal string, commune_id long")
    out = {r.id: (r.commune_id, r.match_method) for r in L.link_cascade(sales, communes).collect()}
    assert out == {10: (2, "exact"), 11: (2, "ltrim"), 12: (1, "postal"), 13: (None, None), 14: (7, "existing")}


def test_point_in_polygon_concave_overlap_edge(spark):
    concave = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0), (0.0, 0.0)]
    square = [(1.0, 0.5), (3.0, 0.5), (3.0, 3.0), (1.0, 3.0), (1.0, 0.5)]
    to_ring = lambda pts: [{"lon": x, "lat": y} for x, y in pts]
    polys = spark.createDataFrame([(7, to_ring(concave)), (3, to_ring(square))],
                                  "id long, ring array<struct<lon:double,lat:double>>")
    pts = spark.createDataFrame([(1, 0.75, 1.5), (2, 2.0, 2.0), (3, 1.5, 0.5), (4, 2.0, 4.0), (5, 9.0, 9.0),
                                 (6, None, None)], "id long, latitude double, longitude double")
    # 1: inside both -> least id 3; 2: in the concave notch (outside concave), inside square -> 3;
    # 3: inside concave only; 4: on the concave's edge -> not contained; 5, 6: nowhere
    for max_bytes in (0, 1 << 26):  # shuffled (salted) grid join, then broadcast per-cell lists
        out = {r.id: r.quartier_id for r in spatial.locate_in_polygons(
            pts, polys, cell_deg=0.7, salt_buckets=3, max_broadcast_bytes=max_bytes).collect()}
        assert out == {1: 3, 2: 3, 3: 7, 4: None, 5: None, 6: None}


def test_radius_count_equals_brute_force(spark):
    pts = spark.range(300).select(F.col("id"), (45 + (F.col("id") * 37 % 200) / 1000.0).alias("latitude"),
                                  (2 + (F.col("id") * 53 % 300) / 1000.0).alias("longitude"))
    places = spark.range(80).select(F.col("id").alias("pid"), (45 + (F.col("id") * 41 % 200) / 1000.0).alias("latitude"),
                                    (2 + (F.col("id") * 29 % 300) / 1000.0).alias("longitude"),
                                    F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("t"))
    p = pts.alias("p").crossJoin(places.alias("q"))
    d = G.haversine_km(F.col("p.latitude"), F.col("p.longitude"), F.col("q.latitude"), F.col("q.longitude")) * 1000
    brute = p.where(d <= 2000).groupBy("p.id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("t") == "a").alias("na"))
    exp = {r.id: (r.n, r.na) for r in brute.collect()}
    for max_bytes in (0, 1 << 26):
        got = {r.id: (r.nb_total, r.nb_a) for r in spatial.count_within_radius(
            pts, places, 2000.0, type_col="t", types=["a"], salt_buckets=3, max_broadcast_bytes=max_bytes).collect()}
        assert {k: v for k, v in got.items() if v[0] > 0} == exp
        assert len(got) == 300


def test_distances(spark):
    import math as m
    # one degree of latitude on the 6371 km sphere
    assert m.isclose(G.METRES_PER_DEGREE, 111194.93, rel_tol=1e-6)
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (48.8566, 2.3522, 45.7640, 4.8357), (10.0, 10.0, 10.0, 10.0)],
                               "a double, b double, c double, d double")
    rows = df.select(G.geodesic_km("a", "b", "c", "d").alias("g"), G.haversine_km("a", "b", "c", "d").alias("h"),
                     G.cosine_law_km("a", "b", "c", "d").alias("k")).collect()
    assert m.isclose(rows[0].g, 111.319491, rel_tol=1e-6)      # one degree of longitude on the WGS84 equator
    assert m.isclose(rows[0].h, 111.194927, rel_tol=1e-6)
    assert abs(rows[1].g - rows[1].h) / rows[1].g < 0.005       # sphere vs ellipsoid within 0.5 %
    assert m.isclose(rows[1].h, rows[1].k, rel_tol=1e-9)
    assert rows[2].g == 0.0 and rows[2].h == 0.0


def test_upsert_overwrites_with_null(spark):
    t = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "k string, name string, pop int")
    i = spark.createDataFrame([("b", None, 5), ("c", "z", 3)], "k string, name string, pop int")
    out = {r.k: (r.name, r.pop, r.row_source) for r in L.upsert(t, i, "k", ["name", "pop"]).collect()}
    assert out == {"a": ("x", 1, "kept"), "b": (None, 5, "updated"), "c": ("z", 3, "inserted")}


def test_upsert_keeps_other_columns_and_times(spark):
    import datetime
    at = datetime.datetime(2020, 1, 1)
    t = spark.createDataFrame([(7, "a", 1, at), (8, "b", 2, at)], "id long, k string, pop int, updated_at timestamp")
    i = spark.createDataFrame([("b", 5), ("c", 3)], "k string, pop int")
    out = {r.k: r for r in L.upsert(t, i, "k", ["pop"]).collect()}
    assert out["a"].id == 7 and out["a"].updated_at == at and out["a"].pop == 1
    assert out["b"].id == 8 and out["b"].updated_at > at and out["c"].id is None


def test_price_variation_equals_window(spark):
    from pyspark.sql import Window
    from parcelle.operators import listings as LS
    # listing 0 holds half of the rows; months without a row, ties, missing times, prices and listings
    k = F.col("id")
    h = spark.range(3000).select(k, F.when(k % 2 == 0, 0).when(k % 41 != 0, k % 7).alias("listing_id"),
                                 F.when(k % 97 != 0, F.timestamp_seconds((k * 7919) % 1009 * 90000).cast("timestamp_ntz")).alias("date_observation"),
                                 F.when(k % 89 != 0, (k * 13) % 97).cast("double").alias("prix"))
    want = h.withColumn("p", F.lag("prix").over(Window.partitionBy("listing_id").orderBy("date_observation", "id")))
    got = {r.id: r.prix_precedent for r in LS.price_variation(h).collect()}
    assert got == {r.id: r.p for r in want.collect()}
    assert LS.price_variation(h.where("false")).count() == 0


def test_listing_rules_and_photos(spark):
    from parcelle.operators import listings as LS
    rows = [("u1", 200000.0, 50.0, 1990, "C", None, 80, ["a", "b"], None),
            ("u2", 0.0, None, 1700, "H", "B", 120, None, None),
            (None, 150000.0, 40.0, 2030, None, "Z", 50, [], 3)]
    df = spark.createDataFrame(rows, "url string, prix_affiche double, surface_habitable double, "
                                     "annee_construction int, dpe_classe string, ges_classe string, "
                                     "data_quality_score int, photos_urls array<string>, nb_photos int")
    ok, bad = C.split_valid(df, LS.listing_rules())
    assert [r.url for r in ok.collect()] == ["u1"]
    reasons = {r.url: list(r.reject_reasons) for r in bad.collect()}
    assert reasons["u2"] == ["price_not_positive", "build_year_out_of_range", "dpe_invalid", "quality_out_of_range"]
    assert reasons[None] == ["url_missing", "build_year_out_of_range", "ges_invalid"]
    photos = [r.nb_photos for r in LS.with_photo_count(df).collect()]
    assert photos == [2, None, 3]


def test_department_extract_defaults(spark):
    from parcelle.operators import extract as X
    rows = [(1, dt.date(2023, 5, 1), " 75", "Appartement"), (2, dt.date(2021, 5, 1), "75", "Maison"),
            (3, dt.date(2023, 6, 1), "75", "Dépendance"), (4, dt.date(2024, 1, 1), "69", "Maison"),
            (5, dt.date(2022, 1, 1), "75", "Maison")]
    df = spark.createDataFrame(rows, "id long, date_mutation date, code_departement string, type_local string")
    assert [r.id for r in X.by_department(df, "75").collect()] == [5, 1]
    assert [r.id for r in X.by_department(df, "75", max_records=1).collect()] == [5]


def test_density_and_variation_edges(spark):
    from parcelle.operators import listings as LS
    c = spark.createDataFrame([(1000, 0.0), (1000, 4.0), (None, 2.0)], "p int, a double")
    assert [r.d for r in c.select(D.density("p", "a").alias("d")).collect()] == [None, 250.0, None]
    h = spark.createDataFrame([(1, 10, dt.datetime(2024, 1, 1), 100.0),              # single observation
                               (2, 20, dt.datetime(2024, 1, 1), 50.0), (3, 20, dt.datetime(2024, 1, 2), 50.0),
                               (4, 30, dt.datetime(2024, 1, 1), 0.0), (5, 30, dt.datetime(2024, 1, 1), 80.0)],
                              "id long, listing_id long, date_observation timestamp_ntz, prix double")
    out = {r.id: (r.prix_precedent, r.variation_pct) for r in LS.price_variation(h).collect()}
    assert out[1] == (None, None)
    assert out[3] == (50.0, 0.0)          # equal prices
    assert out[5] == (0.0, None)          # previous price 0: NULLIF guard, same timestamp ordered by id


def test_truncate_widths(spark):
    df = spark.createDataFrame([("x" * 600, "750110", "Vente" * 20, None)],
                               "adresse_nom_voie string, code_postal string, nature_mutation string, other string")
    r = P.truncate_widths(df).first()
    assert len(r.adresse_nom_voie) == 500 and r.code_postal == "75011" and len(r.nature_mutation) == 50
    assert r.other is None


def test_price_history_pages_concatenate_to_whole(spark):
    import json
    from parcelle.operators import listings as LS
    h = spark.range(600).select(F.col("id"), (F.col("id") % 2).alias("listing_id"),
                                F.timestamp_seconds(F.col("id") * 100000).cast("timestamp_ntz").alias("date_observation"),
                                (F.col("id") * 1.5).alias("prix"))
    whole = {r.listing_id: json.loads(r.evolution_prix) for r in LS.price_history_json(h).collect()}
    pages = sorted(LS.price_history_pages(h).collect(), key=lambda r: (r.listing_id, r.page))
    joined = {}
    for r in pages:
        before = joined.setdefault(r.listing_id, [])
        mine = json.loads(r.evolution_prix)
        assert r.nb_avant == len(before) and r.prix_precedent == (before[-1]["prix"] if before else None)
        assert {o["date"][:7] for o in mine} == {r.mois} and len(mine) == r.nb_observations
        before.extend(mine)
    assert joined == whole and [r.page for r in pages if r.listing_id == 0] == list(range(len(pages) // 2)) and len(pages) > 40


def test_recent_departments(spark):
    from parcelle.operators import extract as X
    rows = [(1, dt.date(2024, 6, 1), "75"), (2, dt.date(2023, 1, 1), "75"), (3, dt.date(2024, 5, 1), "69"),
            (4, dt.date(2024, 6, 2), "01")]
    df = spark.createDataFrame(rows, "id long, date_mutation date, code_departement string")
    out = {r.id: (r.dept_recherche, r.ville_recherche) for r in X.recent_departments(df, "2024-06-30", 6).collect()}
    assert out == {1: ("75", "Paris"), 3: ("69", "Lyon")}
