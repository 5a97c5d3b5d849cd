"""Queries for feature engineering and the analysis reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.functions import derive as D
from parcelle.functions import geo as G
from parcelle.functions import rnd
from parcelle.operators import reports as R
from parcelle.operators.quantiles import column_quantiles, with_one_row
from parcelle.plans.catalog import register
from parcelle.plans.oracle import r, with_adapter, with_ctes
from parcelle.plans.sizing import broadcast_if_small
from parcelle.sources import tables as T

# The driver tables carry order priorities where sale files carry property
# types; this mapping (applied with P27) gives the type steps real labels.
PRIORITY_TYPES = {
    "1-URGENT": "Appartement",
    "2-HIGH": "Maison",
    "3-MEDIUM": "Local industriel. commercial ou assimilé",
    "4-NOT SPECIFIED": "Dépendance",
}

FEATURE_COLS = ["annee", "mois", "trimestre", "jour_semaine", "saison", "is_weekend", "jour_annee",
                "prix_par_piece", "m2_par_piece", "grande_surface", "prix_m2", "surface_reelle_bati",
                "nb_pieces", "latitude", "longitude", "taille_categorie"]
CORR_COLS = ["valeur_fonciere", "prix_m2", "surface_reelle_bati", "nb_pieces", "distance_centre_ville",
             "commune_population", "commune_densite"]


def features(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table of the analysis notebooks: sales with temporal,
    price and size features and the commune labels (J2/J9)."""
    s = D.temporal_features(D.derive_sales(T.sales(spark, sf)))
    s = s.withColumns({
        "prix_par_piece": D.price_per_room("valeur_fonciere", "nb_pieces"),
        "m2_par_piece": D.area_per_room("surface_reelle_bati", "nb_pieces"),
        "grande_surface": D.large_area("surface_reelle_bati"),
        "taille_categorie": D.size_band("surface_reelle_bati"),
    })
    c = broadcast_if_small(T.communes(spark, sf).select(
        F.col("id").alias("commune_id"), "departement", "nom_commune",
        F.col("population").alias("commune_population"), F.col("densite_pop").alias("commune_densite"),
        F.col("latitude").alias("_clat"), F.col("longitude").alias("_clon")))
    out = s.join(c, "commune_id", "left")
    return out.withColumns({
        "distance_centre_ville": G.haversine_km("latitude", "longitude", "_clat", "_clon"),
        "type_prop": D.canonical_type(D.canonical_type("type_local", PRIORITY_TYPES)),
    }).drop("_clat", "_clon")


def _sql_type_map(col: str) -> str:
    cases = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in PRIORITY_TYPES.items())
    return f"(CASE {cases} ELSE {col} END)"


SQL_CANON = ("(CASE WHEN {c} = 'Local industriel. commercial ou assimilé' THEN 'Local commercial' ELSE {c} END)")


SQL_FEAT = f"""
feat AS (
  SELECT s.*, c.departement, c.nom_commune, c.population AS commune_population, c.densite_pop AS commune_densite,
         {G.sql_haversine_km('s.latitude', 's.longitude', 'c.latitude', 'c.longitude')} AS distance_centre_ville,
         {SQL_CANON.format(c=_sql_type_map('s.type_local'))} AS type_prop,
         CASE WHEN s.mois IN (12, 1, 2) THEN 'Hiver' WHEN s.mois IN (3, 4, 5) THEN 'Printemps'
              WHEN s.mois IN (6, 7, 8) THEN 'Été' WHEN s.mois IN (9, 10, 11) THEN 'Automne' END AS saison,
         s.jour_semaine IN (0, 6) AS is_weekend,
         CAST(dayofyear(s.date_mutation) AS INTEGER) AS jour_annee,
         CASE WHEN s.nb_pieces > 0 THEN s.valeur_fonciere / s.nb_pieces END AS prix_par_piece,
         CASE WHEN s.nb_pieces > 0 AND s.surface_reelle_bati > 0 THEN s.surface_reelle_bati / s.nb_pieces END
           AS m2_par_piece,
         s.surface_reelle_bati > 100 AS grande_surface,
         CASE WHEN s.surface_reelle_bati <= 25 THEN 'Studio' WHEN s.surface_reelle_bati <= 45 THEN 'Petit'
              WHEN s.surface_reelle_bati <= 75 THEN 'Moyen' WHEN s.surface_reelle_bati <= 120 THEN 'Grand'
              WHEN s.surface_reelle_bati IS NOT NULL THEN 'Très grand' END AS taille_categorie
  FROM sales s LEFT JOIN communes c ON s.commune_id = c.id
),
cuts AS (
  SELECT quantile_cont(valeur_fonciere, 0.25) AS p25, quantile_cont(valeur_fonciere, 0.5) AS p50,
         quantile_cont(valeur_fonciere, 0.75) AS p75, quantile_cont(valeur_fonciere, 0.9) AS p90
  FROM sales
),
banded AS (
  SELECT f.*, CASE WHEN f.valeur_fonciere <= cuts.p25 THEN 'Bas' WHEN f.valeur_fonciere <= cuts.p50 THEN 'Moyen'
                   WHEN f.valeur_fonciere <= cuts.p75 THEN 'Élevé' WHEN f.valeur_fonciere <= cuts.p90 THEN 'Premium'
                   ELSE 'Luxe' END AS categorie_prix
  FROM feat f, cuts
)"""


# Quality score over the feature table (its distance column is filled, +2).
SQL_SCORE_FEAT = ("(50 + CASE WHEN type_local IS NOT NULL THEN 5 ELSE 0 END"
                  " + CASE WHEN surface_reelle_bati IS NOT NULL THEN 10 ELSE 0 END"
                  " + CASE WHEN nb_pieces IS NOT NULL THEN 5 ELSE 0 END + CASE WHEN code_postal IS NOT NULL THEN 3 ELSE 0 END"
                  " + CASE WHEN commune_id IS NOT NULL THEN 5 ELSE 0 END + CASE WHEN latitude IS NOT NULL THEN 7 ELSE 0 END"
                  " + CASE WHEN prix_m2 IS NOT NULL THEN 10 ELSE 0 END"
                  " + CASE WHEN adresse_nom_voie IS NOT NULL THEN 3 ELSE 0 END"
                  " + CASE WHEN distance_centre_ville IS NOT NULL THEN 2 ELSE 0 END)")


def with_feat(body: str) -> str:
    return with_ctes(SQL_FEAT, body=body)


def banded(spark, sf) -> DataFrame:
    return R.price_bands(features(spark, sf))


# ------------------------------------------------------------ P15-P26 ------
@register("temporal_features", "P15 P16 P17 P18 P19 X5", with_feat("""
SELECT id, annee, mois, trimestre, jour_semaine, saison, is_weekend, jour_annee FROM feat
"""))
def q_temporal_features(spark, sf):
    return features(spark, sf).select("id", "annee", "mois", "trimestre", "jour_semaine", "saison",
                                      "is_weekend", "jour_annee")


@register("price_features", "P20 P21 P22", with_feat(f"""
SELECT id, {r('prix_par_piece')} AS prix_par_piece, {r('m2_par_piece', 4)} AS m2_par_piece, grande_surface FROM feat
"""))
def q_price_features(spark, sf):
    f = features(spark, sf)
    return f.select("id", rnd("prix_par_piece").alias("prix_par_piece"), rnd("m2_par_piece", 4).alias("m2_par_piece"),
                    "grande_surface")


@register("price_bands", "P26 A4 J16", with_feat("""
SELECT id, categorie_prix FROM banded
"""))
def q_price_bands(spark, sf):
    return banded(spark, sf).select("id", "categorie_prix")


@register("price_band_stats", "A17 K5", with_feat(f"""
SELECT categorie_prix, COUNT(*) AS nb, {r('AVG(CAST(valeur_fonciere AS DECIMAL(18,2)))', 0)} AS prix_moyen,
       {r('AVG(prix_m2)', 0)} AS prix_m2_moyen
FROM banded WHERE categorie_prix IS NOT NULL GROUP BY 1
"""))
def q_price_band_stats(spark, sf):
    out = R.band_stats(banded(spark, sf), "categorie_prix", "valeur_fonciere", {
        "prix_moyen": F.avg(F.col("valeur_fonciere").cast("decimal(18,2)")), "prix_m2_moyen": F.avg("prix_m2")})
    return out.select("categorie_prix", "nb", rnd("prix_moyen", 0).alias("prix_moyen"),
                      rnd("prix_m2_moyen", 0).alias("prix_m2_moyen"))


@register("size_bands", "P25 A18", with_feat(f"""
SELECT taille_categorie, COUNT(*) AS nb, {r('AVG(prix_m2)', 0)} AS prix_m2_moyen
FROM feat WHERE taille_categorie IS NOT NULL AND prix_m2 IS NOT NULL GROUP BY 1
"""))
def q_size_bands(spark, sf):
    f = features(spark, sf).where(F.col("prix_m2").isNotNull())
    out = R.band_stats(f, "taille_categorie", "surface_reelle_bati", {"prix_m2_moyen": F.avg("prix_m2")})
    return out.select("taille_categorie", "nb", rnd("prix_m2_moyen", 0).alias("prix_m2_moyen"))


@register("season_stats", "A18 P16", with_feat("""
SELECT saison, COUNT(*) AS nb FROM feat WHERE saison IS NOT NULL GROUP BY 1
"""))
def q_season_stats(spark, sf):
    return R.count_by(features(spark, sf), "saison")


@register("weekend_stats", "A18 P17", with_feat(f"""
SELECT is_weekend, COUNT(*) AS nb, {r('AVG(prix_m2)', 0)} AS prix_m2_moyen FROM feat
WHERE is_weekend IS NOT NULL GROUP BY 1
"""))
def q_weekend_stats(spark, sf):
    f = features(spark, sf).where(F.col("is_weekend").isNotNull())
    return f.groupBy("is_weekend").agg(F.count(F.lit(1)).alias("nb"), rnd(F.avg("prix_m2"), 0).alias("prix_m2_moyen"))


@register("type_codes", "P24 P27", with_adapter(f"""
SELECT id, type_local,
       CASE type_local WHEN 'Appartement' THEN 1 WHEN 'Maison' THEN 2 WHEN 'Local commercial' THEN 3
                       WHEN 'Dépendance' THEN 4 ELSE 0 END AS type_local_encoded
FROM (SELECT id, {SQL_CANON.format(c=_sql_type_map('type_local'))} AS type_local FROM sales_base)
"""))
def q_type_codes(spark, sf):
    s = T.sales(spark, sf).withColumn("type_local", D.canonical_type("type_local", PRIORITY_TYPES))
    s = s.withColumn("type_local", D.canonical_type("type_local"))
    return s.select("id", "type_local", D.type_code("type_local").alias("type_local_encoded"))


# ------------------------------------------------------------ A19-A24 ------
@register("type_stats", "A19 A5 F5", with_feat(f"""
SELECT type_prop AS type_local, COUNT(*) AS nb,
       {r('AVG(CAST(valeur_fonciere AS DECIMAL(18,2)))')} AS valeur_fonciere_mean,
       {r('quantile_cont(valeur_fonciere, 0.5)', 3)} AS valeur_fonciere_median,
       {r('AVG(prix_m2)')} AS prix_m2_mean, {r('quantile_cont(prix_m2, 0.5)')} AS prix_m2_median,
       {r('AVG(surface_reelle_bati)')} AS surface_reelle_bati_mean,
       {r('quantile_cont(surface_reelle_bati, 0.5)')} AS surface_reelle_bati_median
FROM feat WHERE type_prop IN ('Appartement', 'Maison') GROUP BY 1
"""))
def q_type_stats(spark, sf):
    f = features(spark, sf).where(F.col("type_prop").isin("Appartement", "Maison"))
    f = f.withColumn("valeur_fonciere", F.col("valeur_fonciere").cast("decimal(18,2)"))
    out = R.group_stats(f, ["type_prop"], ["valeur_fonciere", "prix_m2", "surface_reelle_bati"])
    return out.select(F.col("type_prop").alias("type_local"), "nb",
                      rnd("valeur_fonciere_mean").alias("valeur_fonciere_mean"),
                      rnd("valeur_fonciere_median", 3).alias("valeur_fonciere_median"),
                      *[rnd(c).alias(c) for c in ["prix_m2_mean", "prix_m2_median", "surface_reelle_bati_mean",
                                                 "surface_reelle_bati_median"]])


@register("dept_stats", "A20 K5", with_feat(f"""
SELECT departement, COUNT(*) AS nb_ventes, {r('quantile_cont(prix_m2, 0.5)')} AS prix_m2_median,
       {r('quantile_cont(valeur_fonciere, 0.5)', 3)} AS valeur_fonciere_median
FROM feat WHERE departement IS NOT NULL GROUP BY 1
"""))
def q_dept_stats(spark, sf):
    f = features(spark, sf).where(F.col("departement").isNotNull())
    out = R.group_stats(f, ["departement"], ["prix_m2", "valeur_fonciere"], count_name="nb_ventes")
    return out.orderBy("prix_m2_median").select(
        "departement", "nb_ventes", rnd("prix_m2_median").alias("prix_m2_median"),
        rnd("valeur_fonciere_median", 3).alias("valeur_fonciere_median"))


@register("monthly_medians", "A21 P32", with_feat(f"""
SELECT strftime(date_mutation, '%Y-%m') AS mois_str, COUNT(*) AS nb_ventes,
       {r('quantile_cont(prix_m2, 0.5)')} AS prix_m2_median,
       {r('quantile_cont(valeur_fonciere, 0.5)', 3)} AS valeur_fonciere_median
FROM feat GROUP BY 1
"""))
def q_monthly_medians(spark, sf):
    f = features(spark, sf).withColumn("mois_str", D.month_key("date_mutation"))
    out = R.group_stats(f, ["mois_str"], ["prix_m2", "valeur_fonciere"], count_name="nb_ventes")
    return out.select("mois_str", "nb_ventes", rnd("prix_m2_median").alias("prix_m2_median"),
                      rnd("valeur_fonciere_median", 3).alias("valeur_fonciere_median"))


@register("season_medians", "A22", with_feat(f"""
SELECT o.saison, {r('m.med')} AS prix_m2_median
FROM (VALUES (0, 'Hiver'), (1, 'Printemps'), (2, 'Été'), (3, 'Automne')) o(pos, saison)
LEFT JOIN (SELECT saison, quantile_cont(prix_m2, 0.5) AS med FROM feat WHERE saison IS NOT NULL GROUP BY 1) m
       ON o.saison = m.saison
"""))
def q_season_medians(spark, sf):
    out = R.ordered_groups(features(spark, sf), "saison", D.SEASON_ORDER, "prix_m2")
    return out.select("saison", rnd("prix_m2_median").alias("prix_m2_median"))


@register("price_band_medians", "A23", with_feat(f"""
SELECT categorie_prix, COUNT(*) AS nb, {r('quantile_cont(valeur_fonciere, 0.5)', 3)} AS valeur_fonciere_median,
       {r('quantile_cont(prix_m2, 0.5)')} AS prix_m2_median,
       {r('quantile_cont(surface_reelle_bati, 0.5)')} AS surface_reelle_bati_median
FROM banded GROUP BY 1
"""))
def q_price_band_medians(spark, sf):
    out = R.group_stats(banded(spark, sf), ["categorie_prix"], ["valeur_fonciere", "prix_m2", "surface_reelle_bati"])
    return out.select("categorie_prix", "nb", rnd("valeur_fonciere_median", 3).alias("valeur_fonciere_median"),
                      rnd("prix_m2_median").alias("prix_m2_median"),
                      rnd("surface_reelle_bati_median").alias("surface_reelle_bati_median"))


@register("category_share", "A24", with_feat(f"""
SELECT type_local, COUNT(*) AS nb, {r('COUNT(*) * 100.0 / (SELECT COUNT(*) FROM feat)', 4)} AS pct FROM feat GROUP BY 1
"""))
def q_category_share(spark, sf):
    out = R.share_by(features(spark, sf), "type_local")
    return out.withColumn("pct", rnd("pct", 4))


@register("count_by_type", "A12 K5", with_adapter("""
SELECT type_local, COUNT(*) AS nb FROM sales_base WHERE type_local IS NOT NULL GROUP BY 1
"""))
def q_count_by_type(spark, sf):
    return R.count_by(T.sales(spark, sf), "type_local")


@register("dept_summary", "A15 K5", with_feat(f"""
SELECT departement, COUNT(*) AS nb, {r('AVG(prix_m2)', 0)} AS pm2, {r('AVG(CAST(valeur_fonciere AS DECIMAL(18,2)))', 0)} AS pmoy
FROM sales s JOIN communes c ON s.commune_id = c.id WHERE s.prix_m2 IS NOT NULL GROUP BY 1
"""))
def q_dept_summary(spark, sf):
    f = features(spark, sf).where(F.col("prix_m2").isNotNull() & F.col("departement").isNotNull())
    g = f.groupBy("departement").agg(F.count(F.lit(1)).alias("nb"), rnd(F.avg("prix_m2"), 0).alias("pm2"),
                                     rnd(F.avg(F.col("valeur_fonciere").cast("decimal(18,2)")), 0).alias("pmoy"))
    return g.orderBy(F.desc("nb"), "departement")


# ------------------------------------------------------------ A10, F13 -----
def _sql_coverage(cols: list[str], where: str = "") -> str:
    parts = [f"SELECT '{c}' AS feature, COUNT({c}) AS non_null, {r(f'COUNT({c}) * 100.0 / COUNT(*)', 4)} AS pct FROM feat {where}"
             for c in cols]
    return "\nUNION ALL\n".join(parts)


@register("coverage_report", "A9 A10 R4", with_feat(_sql_coverage(FEATURE_COLS)))
def q_coverage_report(spark, sf):
    out = R.coverage(features(spark, sf), FEATURE_COLS)
    return out.withColumn("pct", rnd("pct", 4))


GATE_COLS = ["surface_reelle_bati", "nb_pieces", "latitude", "longitude", "prix_par_piece", "m2_par_piece",
             "mois", "trimestre", "jour_semaine", "annee"]


@register("feature_gate", "F13 M2", with_feat(f"""
SELECT feature, pct FROM ({_sql_coverage(GATE_COLS)}) WHERE pct > 30
"""))
def q_feature_gate(spark, sf):
    out = R.completeness_gate(features(spark, sf), GATE_COLS, 0.3)
    return out.withColumn("pct", rnd("pct", 4))


# ------------------------------------------------------------ D1-D7 --------
DESCRIBE_COLS = ["valeur_fonciere", "prix_m2", "surface_reelle_bati", "nb_pieces"]


def _sql_describe(c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", COUNT({c}) AS count, {r(f'AVG({c})', 4)} AS mean, "
            f"{r(f'STDDEV_SAMP({c})', 4)} AS std, {r(f'MIN({c})', 4)} AS min, "
            f"{r(f'quantile_cont({c}, 0.25)', 3)} AS p25, {r(f'quantile_cont({c}, 0.5)', 3)} AS p50, "
            f"{r(f'quantile_cont({c}, 0.75)', 3)} AS p75, {r(f'MAX({c})', 4)} AS max FROM feat")


@register("describe", "D1 A4", with_feat("\nUNION ALL\n".join(_sql_describe(c) for c in DESCRIBE_COLS)))
def q_describe(spark, sf):
    out = R.describe(features(spark, sf), DESCRIBE_COLS)
    return out.select("column", "count", *[rnd(c, 4).alias(c) for c in ["mean", "std", "min"]],
                      *[rnd(c, 3).alias(c) for c in ["p25", "p50", "p75"]], rnd("max", 4).alias("max"))


@register("histogram", "D2 M10", with_feat(f"""
, rng AS (SELECT CAST(MIN(prix_m2) AS DOUBLE) AS lo, CAST(MAX(prix_m2) AS DOUBLE) AS hi FROM feat),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((prix_m2 - lo) / ((hi - lo) / 50)), 49) END AS INTEGER)
             AS bin, lo, hi FROM feat, rng WHERE prix_m2 IS NOT NULL)
SELECT bin, COUNT(*) AS nb, {r('lo + bin * ((hi - lo) / 50)', 4)} AS bin_start FROM b GROUP BY bin, lo, hi
""".replace("\n, rng AS", ",\nrng AS")))
def q_histogram(spark, sf):
    out = R.histogram(features(spark, sf), "prix_m2", 50)
    return out.select("bin", "nb", rnd("bin_start", 4).alias("bin_start"))


@register("boxplot", "D3", with_feat(f"""
, q AS (SELECT type_local, quantile_cont(prix_m2, 0.25) AS q1, quantile_cont(prix_m2, 0.5) AS median,
               quantile_cont(prix_m2, 0.75) AS q3 FROM feat WHERE prix_m2 IS NOT NULL GROUP BY 1),
f AS (SELECT q.*, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.type_local, {r('f.q1')} AS q1, {r('f.median')} AS median, {r('f.q3')} AS q3,
       {r('MIN(CASE WHEN x.prix_m2 BETWEEN f.lo AND f.hi THEN x.prix_m2 END)')} AS whisker_low,
       {r('MAX(CASE WHEN x.prix_m2 BETWEEN f.lo AND f.hi THEN x.prix_m2 END)')} AS whisker_high,
       COUNT(*) FILTER (WHERE NOT (x.prix_m2 BETWEEN f.lo AND f.hi)) AS n_outliers
FROM f JOIN feat x ON x.type_local = f.type_local AND x.prix_m2 IS NOT NULL
GROUP BY f.type_local, f.q1, f.median, f.q3
""".replace("\n, q AS", ",\nq AS")))
def q_boxplot(spark, sf):
    out = R.boxplot(features(spark, sf), "type_local", "prix_m2")
    return out.select("type_local", *[rnd(c).alias(c) for c in ["q1", "median", "q3", "whisker_low", "whisker_high"]],
                      "n_outliers")


def _sql_corr() -> str:
    parts = []
    for a in CORR_COLS:
        for b in CORR_COLS:
            if a == b:
                parts.append(f"SELECT '{a}' AS x, '{b}' AS y, CAST(1.0 AS DOUBLE) AS corr")
            else:
                parts.append(f"SELECT '{a}' AS x, '{b}' AS y, {r(f'corr({a}, {b})')} AS corr FROM feat")
    return "\nUNION ALL\n".join(parts)


@register("correlations", "D4", with_feat(_sql_corr()))
def q_correlations(spark, sf):
    out = R.correlations(features(spark, sf), CORR_COLS)
    return out.withColumn("corr", rnd("corr"))


@register("sample_rows", "D5 D6 F1 F5", with_feat(f"""
, typed AS (SELECT *, {SQL_CANON.format(c=_sql_type_map('feat.type_local'))} AS type_p FROM feat)
SELECT id, surface_reelle_bati, valeur_fonciere, {r('prix_m2', 4)} AS prix_m2, type_p AS type_prop FROM typed
WHERE surface_reelle_bati IS NOT NULL AND valeur_fonciere IS NOT NULL AND type_p IN ('Appartement', 'Maison')
ORDER BY md5('42:' || CAST(id AS VARCHAR)), id LIMIT 5000
""".replace("\n, typed AS", ",\ntyped AS")))
def q_sample_rows(spark, sf):
    f = features(spark, sf).dropna(subset=["surface_reelle_bati", "valeur_fonciere", "type_prop"])
    f = f.where(F.col("type_prop").isin("Appartement", "Maison"))
    return R.sample_rows(f, "id", 5000).select("id", "surface_reelle_bati", "valeur_fonciere", rnd("prix_m2", 4).alias("prix_m2"), "type_prop")


@register("run_report", "A11 A27 D7 A26", with_feat(f"""
SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE type_local = 'Appartement') AS apparts,
       COUNT(*) FILTER (WHERE type_local = 'Maison') AS maisons, COUNT(commune_id) AS with_commune,
       COUNT(latitude) AS with_coords, COUNT(prix_m2) AS with_prix_m2,
       {r('AVG(CAST(valeur_fonciere AS DECIMAL(18,2)))', 0)} AS prix_moyen, {r('AVG(prix_m2)', 0)} AS prix_m2_moyen,
       {r('AVG(surface_reelle_bati)', 1)} AS surface_moy, MIN(date_mutation) AS date_min, MAX(date_mutation) AS date_max
FROM sales
"""))
def q_run_report(spark, sf):
    out = R.global_summary(D.derive_sales(T.sales(spark, sf)))
    return out.withColumns({"prix_moyen": rnd("prix_moyen", 0), "prix_m2_moyen": rnd("prix_m2_moyen", 0),
                            "surface_moy": rnd("surface_moy", 1)})


# ------------------------------------------------------------ K3, W2 -------
@register("top_by_median", "K3 F12", with_feat(f"""
SELECT nom_commune, COUNT(*) AS nb_ventes, {r('quantile_cont(prix_m2, 0.5)')} AS prix_m2_median,
       {r('quantile_cont(valeur_fonciere, 0.5)', 3)} AS valeur_fonciere_median
FROM feat WHERE nom_commune IS NOT NULL GROUP BY 1 HAVING COUNT(*) >= 10
ORDER BY quantile_cont(prix_m2, 0.5) DESC NULLS LAST, nom_commune LIMIT 20
"""))
def q_top_by_median(spark, sf):
    f = features(spark, sf).where(F.col("nom_commune").isNotNull())
    out = R.top_by_median(f, ["nom_commune"], "prix_m2", 10, 20, extra={"valeur_fonciere_median": "valeur_fonciere"})
    return out.select("nom_commune", F.col("nb").alias("nb_ventes"), rnd("median").alias("prix_m2_median"),
                      rnd("valeur_fonciere_median", 3).alias("valeur_fonciere_median"))


PER_DEPT = 100


@register("per_dept_limit", "W2 K4 E3", with_feat(f"""
SELECT id, departement FROM (
  SELECT id, departement, row_number() OVER (PARTITION BY departement ORDER BY date_mutation, id) AS rk FROM feat)
WHERE rk <= {PER_DEPT}
"""))
def q_per_dept_limit(spark, sf):
    out = R.limit_per_group(features(spark, sf), "departement", PER_DEPT, ["date_mutation", "id"])
    return out.select("id", "departement")


@register("eda_summary", "D7 A5 A6 A11 A14 A27", with_feat(f"""
SELECT COUNT(*) AS total, MIN(date_mutation) AS date_min, MAX(date_mutation) AS date_max,
       COUNT(DISTINCT type_prop) AS nb_types,
       {r('quantile_cont(valeur_fonciere, 0.5)', 3)} AS prix_median,
       {r('quantile_cont(prix_m2, 0.5)')} AS prix_m2_median,
       {r('quantile_cont(surface_reelle_bati, 0.5)')} AS surface_median,
       COUNT(*) FILTER (WHERE type_prop = 'Appartement') AS nb_appartements,
       {r("COUNT(*) FILTER (WHERE type_prop = 'Appartement') * 100.0 / COUNT(*)")} AS pct_appartements,
       COUNT(*) FILTER (WHERE type_prop = 'Maison') AS nb_maisons,
       {r("COUNT(*) FILTER (WHERE type_prop = 'Maison') * 100.0 / COUNT(*)")} AS pct_maisons,
       COUNT(DISTINCT nom_commune) AS nb_communes, COUNT(DISTINCT departement) AS nb_departements,
       {r('AVG(' + SQL_SCORE_FEAT + ')')} AS score_moyen,
       {r('COUNT(latitude) * 100.0 / COUNT(*)')} AS taux_geocodage
FROM feat
"""))
def q_eda_summary(spark, sf):
    f = features(spark, sf).withColumn("_score", D.quality_score())
    t = F.col("type_prop")
    one = f.agg(
        F.count(F.lit(1)).alias("total"), F.min("date_mutation").alias("date_min"),
        F.max("date_mutation").alias("date_max"), F.count_distinct(t).alias("nb_types"),
        F.count_if(t == "Appartement").alias("nb_appartements"),
        rnd(F.count_if(t == "Appartement") * 100.0 / F.count(F.lit(1))).alias("pct_appartements"),
        F.count_if(t == "Maison").alias("nb_maisons"),
        rnd(F.count_if(t == "Maison") * 100.0 / F.count(F.lit(1))).alias("pct_maisons"),
        F.count_distinct("nom_commune").alias("nb_communes"), F.count_distinct("departement").alias("nb_departements"),
        rnd(F.avg("_score")).alias("score_moyen"),
        rnd(F.count("latitude") * 100.0 / F.count(F.lit(1))).alias("taux_geocodage"))
    med = column_quantiles(f, ["valeur_fonciere", "prix_m2", "surface_reelle_bati"], 0.5)
    med = med.select(rnd("valeur_fonciere", 3).alias("prix_median"), rnd("prix_m2").alias("prix_m2_median"),
                     rnd("surface_reelle_bati").alias("surface_median"))
    return with_one_row(one, med)
