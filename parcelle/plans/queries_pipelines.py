"""Queries over the end-to-end entry points (E7 clean, E8 enrich, E9 features)
and the enrichment report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.functions import derive as D
from parcelle.functions import geo as G
from parcelle.functions import parse as P
from parcelle.functions import rnd
from parcelle.operators import link as L
from parcelle.operators import reports as R
from parcelle.plans import pipelines as PL
from parcelle.plans.catalog import register
from parcelle.plans.oracle import r, with_adapter, with_ctes
from parcelle.plans.queries_clean import (RELOAD_OFFSET, SQL_DATE, SQL_INT, SQL_NUM, sql_commune_code,
                                          sql_postal, sql_without_duplicates)
from parcelle.plans.queries_geo import SQL_UNLINKED, unlinked_sales
from parcelle.plans.queries_reports import SQL_FEAT
from parcelle.sources import tables as T


def full_feed(spark: SparkSession, sf: str) -> DataFrame:
    """All sales plus the finished orders delivered again as raw text (new ids,
    only the columns a sale file carries)."""
    base = T.sales(spark, sf)
    raw = T.raw_sales(spark, sf).where(F.col("nature_mutation") == "F")
    again = P.clean_raw_sales(raw).withColumn("id", F.col("id") + RELOAD_OFFSET)
    return base.unionByName(again, allowMissingColumns=True)


SQL_FULL_FEED = f"""
feedfull AS (
  SELECT id, date_mutation, valeur_fonciere, code_commune, surface_reelle_bati, type_local, nb_pieces,
         code_postal, commune_id, latitude, adresse_nom_voie
  FROM sales_base
  UNION ALL
  SELECT r.id + {RELOAD_OFFSET}, {SQL_DATE.format(c='r.date_mutation')}, {SQL_NUM.format(c='r.valeur_fonciere')},
         {sql_commune_code('r.code_departement', 'r.code_commune')}, TRY_CAST(r.surface_reelle_bati AS DOUBLE),
         r.type_local, {SQL_INT.format(c='r.nb_pieces')}, {sql_postal('r.code_postal')}, NULL, NULL, NULL
  FROM raw_sales r
  WHERE r.nature_mutation = 'F' AND {SQL_DATE.format(c='r.date_mutation')} IS NOT NULL
    AND {SQL_NUM.format(c='r.valeur_fonciere')} > 0
),
dd AS ({sql_without_duplicates('feedfull')})"""


@register("clean_pipeline", "E7 W1 F6 F7 F8 P27 P28 S14", with_ctes(SQL_FULL_FEED, body=f"""
SELECT id,
       CASE WHEN type_local = 'Local industriel. commercial ou assimilé' THEN 'Local commercial' ELSE type_local END
         AS type_local,
       {r('prix_m2', 4)} AS prix_m2,
       50 + CASE WHEN type_local IS NOT NULL THEN 5 ELSE 0 END + CASE WHEN surface_reelle_bati IS NOT NULL THEN 10 ELSE 0 END
          + CASE WHEN nb_pieces IS NOT NULL THEN 5 ELSE 0 END + CASE WHEN code_postal IS NOT NULL THEN 3 ELSE 0 END
          + CASE WHEN commune_id IS NOT NULL THEN 5 ELSE 0 END + CASE WHEN latitude IS NOT NULL THEN 7 ELSE 0 END
          + CASE WHEN prix_m2 IS NOT NULL THEN 10 ELSE 0 END + CASE WHEN adresse_nom_voie IS NOT NULL THEN 3 ELSE 0 END
         AS data_quality_score
FROM (SELECT *, CASE WHEN surface_reelle_bati > 0 THEN valeur_fonciere / surface_reelle_bati END AS prix_m2 FROM dd
      WHERE NOT COALESCE(valeur_fonciere < 10000 OR valeur_fonciere > 10000000, FALSE)
        AND (surface_reelle_bati IS NULL OR surface_reelle_bati BETWEEN 9 AND 1000))
WHERE prix_m2 IS NULL OR prix_m2 BETWEEN 500 AND 20000
"""))
def q_clean_pipeline(spark, sf):
    cleaned, _ = PL.clean_sales(full_feed(spark, sf))
    return cleaned.select("id", "type_local", rnd("prix_m2", 4).alias("prix_m2"), "data_quality_score")


SQL_ENRICHED = f"""
linked AS (
  SELECT u.id, s.latitude AS lat0, s.longitude AS lon0,
         COALESCE(u.commune_id, e.cid, t.cid, p.cid) AS commune_id,
         CASE WHEN u.commune_id IS NOT NULL THEN 'existing' WHEN e.cid IS NOT NULL THEN 'exact'
              WHEN t.cid IS NOT NULL THEN 'ltrim' WHEN p.cid IS NOT NULL THEN 'postal' END AS match_method
  FROM unlinked u JOIN sales_base s ON u.id = s.id
  LEFT JOIN (SELECT code_commune AS k, MIN(id) AS cid FROM communes GROUP BY 1) e ON u.code_commune = e.k
  LEFT JOIN (SELECT ltrim(code_commune, '0') AS k, MIN(id) AS cid FROM communes GROUP BY 1) t
         ON ltrim(u.code_commune, '0') = t.k
  LEFT JOIN (SELECT code_postal AS k, MIN(id) AS cid FROM communes WHERE code_postal IS NOT NULL GROUP BY 1) p
         ON u.code_postal = p.k
),
enriched AS (
  SELECT l.id, l.commune_id, l.match_method,
         CASE WHEN l.lat0 IS NULL AND c.latitude IS NOT NULL THEN c.latitude ELSE l.lat0 END AS latitude,
         CASE WHEN l.lat0 IS NULL AND c.latitude IS NOT NULL THEN c.longitude ELSE l.lon0 END AS longitude,
         CASE WHEN l.lat0 IS NOT NULL THEN 'row' WHEN c.latitude IS NOT NULL THEN 'commune' END AS coord_source,
         c.latitude AS clat, c.longitude AS clon
  FROM linked l LEFT JOIN communes c ON l.commune_id = c.id
)"""


def enriched(spark, sf) -> DataFrame:
    s = unlinked_sales(spark, sf)
    return PL.enrich_sales(s, T.communes(spark, sf))


@register("enrich_pipeline", "E8 J3 J4 J5 J6 J7 J17 G1", with_ctes(SQL_UNLINKED, SQL_ENRICHED, body=f"""
SELECT id, commune_id, match_method, {r('latitude', 6)} AS latitude, {r('longitude', 6)} AS longitude, coord_source,
       {r(G.sql_haversine_km('latitude', 'longitude', 'clat', 'clon'), 3)} AS distance_centre_ville
FROM enriched
"""))
def q_enrich_pipeline(spark, sf):
    out = enriched(spark, sf)
    return out.select("id", "commune_id", "match_method", rnd("latitude", 6).alias("latitude"),
                      rnd("longitude", 6).alias("longitude"), "coord_source",
                      rnd("distance_centre_ville", 3).alias("distance_centre_ville"))


@register("enrich_report", "A6 A8 A9 A26 F9 P40", with_ctes(SQL_UNLINKED, SQL_ENRICHED, body=f"""
SELECT COUNT(*) AS total, COUNT(commune_id) AS with_commune,
       COUNT(*) FILTER (WHERE commune_id IS NULL) AS without_commune,
       COUNT(latitude) AS with_coords, {r('COUNT(latitude) * 100.0 / COUNT(*)', 1)} AS pct_coords,
       COUNT(*) FILTER (WHERE coord_source = 'commune') AS coords_from_commune,
       {r('AVG(' + G.sql_haversine_km('latitude', 'longitude', 'clat', 'clon') + ')', 3)} AS distance_moyenne,
       COUNT(DISTINCT commune_id) AS nb_communes, COUNT(DISTINCT match_method) AS nb_methods
FROM enriched
"""))
def q_enrich_report(spark, sf):
    e = enriched(spark, sf)
    return e.agg(F.count(F.lit(1)).alias("total"), F.count("commune_id").alias("with_commune"),
                 F.count_if(F.col("commune_id").isNull()).alias("without_commune"),
                 F.count("latitude").alias("with_coords"),
                 rnd(F.count("latitude") * 100.0 / F.count(F.lit(1)), 1).alias("pct_coords"),
                 F.count_if(F.col("coord_source") == "commune").alias("coords_from_commune"),
                 rnd(F.avg("distance_centre_ville"), 3).alias("distance_moyenne"),
                 F.count_distinct("commune_id").alias("nb_communes"),
                 F.count_distinct("match_method").alias("nb_methods"))


@register("features_pipeline", "E9 P15 P20 P21 P22 P24 P25 P26 J8 J9", with_adapter("").rstrip() + ",\n"
          + SQL_FEAT.strip() + f"""
, ca AS (SELECT commune_id, AVG(prix_m2) AS m FROM sales WHERE commune_id IS NOT NULL AND prix_m2 IS NOT NULL GROUP BY 1)
SELECT b.id, b.saison, {r('b.prix_par_piece')} AS prix_par_piece,
       CASE b.type_local WHEN 'Appartement' THEN 1 WHEN 'Maison' THEN 2 WHEN 'Local commercial' THEN 3
                         WHEN 'Dépendance' THEN 4 ELSE 0 END AS type_local_encoded,
       b.taille_categorie, b.categorie_prix, {r('ca.m')} AS commune_prix_m2_moyen, c.population AS commune_population
FROM banded b LEFT JOIN ca ON b.commune_id = ca.commune_id LEFT JOIN communes c ON b.commune_id = c.id
""")
def q_features_pipeline(spark, sf):
    out = PL.engineer_features(T.sales(spark, sf), T.communes(spark, sf))
    return out.select("id", "saison", rnd("prix_par_piece").alias("prix_par_piece"), "type_local_encoded",
                      "taille_categorie", "categorie_prix", rnd("commune_prix_m2_moyen").alias("commune_prix_m2_moyen"),
                      "commune_population")


# Feature groups of the feature-engineering summary.
FEATURE_GROUPS = {
    "Temporelles": ["annee", "mois", "trimestre", "jour_semaine", "saison", "is_weekend", "jour_annee"],
    "Prix": ["prix_m2", "prix_par_piece", "m2_par_piece", "grande_surface", "categorie_prix"],
    "Géographiques": ["latitude", "longitude", "distance_centre_ville", "proche_centre",
                      "commune_prix_m2_moyen", "commune_nb_ventes", "commune_population", "commune_densite"],
    "Bien immobilier": ["type_local_encoded", "taille_categorie"],
    "Qualité": ["data_quality_score"],
}


def _sql_feature_summary() -> str:
    from parcelle.plans.queries_reports import SQL_SCORE_FEAT
    parts = []
    for group, cols in FEATURE_GROUPS.items():
        for c in cols:
            parts.append(f"SELECT '{group}' AS groupe, '{c}' AS feature, COUNT({c}) AS non_null, "
                         f"{r(f'COUNT({c}) * 100.0 / COUNT(*)', 2)} AS pct FROM full_features")
    full = f"""
, ca AS (SELECT commune_id, AVG(prix_m2) AS m, CAST(COUNT(*) AS INTEGER) AS n FROM sales
         WHERE commune_id IS NOT NULL AND prix_m2 IS NOT NULL GROUP BY 1),
joined AS (
  SELECT b.*, ca.m AS commune_prix_m2_moyen, ca.n AS commune_nb_ventes
  FROM banded b LEFT JOIN ca ON b.commune_id = ca.commune_id
),
full_features AS (
  SELECT *, distance_centre_ville < 2 AS proche_centre,
         CASE type_local WHEN 'Appartement' THEN 1 WHEN 'Maison' THEN 2 WHEN 'Local commercial' THEN 3
                         WHEN 'Dépendance' THEN 4 ELSE 0 END AS type_local_encoded,
         {SQL_SCORE_FEAT} AS data_quality_score
  FROM joined
)
"""
    return full + "\nUNION ALL\n".join(parts)


def _feature_summary_sql() -> str:
    from parcelle.plans.queries_reports import SQL_FEAT
    body = _sql_feature_summary()
    return (with_adapter("").rstrip() + ",\n" + SQL_FEAT.strip() + "\n" + body.strip()).replace(
        "\n, ca AS", ",\nca AS")


@register("feature_summary", "A10 R4 E9", _feature_summary_sql())
def q_feature_summary(spark, sf):
    """Completeness of every engineered column, grouped as in the feature
    step's summary, from one aggregate."""
    from parcelle.plans.queries_reports import features
    f = features(spark, sf)
    f = L.commune_features(R.price_bands(f), T.communes(spark, sf))
    f = f.withColumns({"type_local_encoded": D.type_code("type_local"), "data_quality_score": D.quality_score()})
    cols = [c for cs in FEATURE_GROUPS.values() for c in cs]
    cov = R.coverage(f, cols)
    group_of = F.create_map(*[F.lit(x) for g, cs in FEATURE_GROUPS.items() for c in cs for x in (c, g)])
    return cov.select(F.element_at(group_of, F.col("feature")).alias("groupe"), "feature", "non_null",
                      rnd("pct", 2).alias("pct"))
