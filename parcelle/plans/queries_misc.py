"""Queries for listings, structural operators, extracts and file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.functions import derive as D
from parcelle.functions import parse as P
from parcelle.functions import rnd
from parcelle.operators import extract as X
from parcelle.operators import listings as LS
from parcelle.plans.catalog import register
from parcelle.plans.oracle import r, with_adapter
from parcelle.plans.queries_clean import SQL_DATE, SQL_NUM
from parcelle.plans.queries_core import AS_OF
from parcelle.plans.queries_reports import features, with_feat
from parcelle.sources import files as FS
from parcelle.sources import tables as T


# ------------------------------------------------------------ W3, JSON -----
@register("price_variation", "W3 P43", with_adapter(f"""
SELECT id, listing_id, prix_precedent, {r('(prix - prix_precedent) / NULLIF(prix_precedent, 0) * 100', 4)} AS variation_pct
FROM (SELECT id, listing_id, prix,
             lag(prix) OVER (PARTITION BY listing_id ORDER BY date_observation, id) AS prix_precedent
      FROM price_history)
"""))
def q_price_variation(spark, sf):
    out = LS.price_variation(T.price_history(spark, sf))
    return out.select("id", "listing_id", "prix_precedent", rnd("variation_pct", 4).alias("variation_pct"))


@register("price_history_json", "§2.16 evolution_prix", with_adapter("""
SELECT listing_id,
       '[' || string_agg('{"date":"' || strftime(date_observation, '%Y-%m-%dT%H:%M:%S') || '","prix":'
                         || CAST(prix AS VARCHAR) || '}', ',' ORDER BY date_observation, id) || ']' AS evolution_prix,
       COUNT(*) AS nb_observations
FROM price_history GROUP BY listing_id
"""))
def q_price_history_json(spark, sf):
    out = LS.price_history_json(T.price_history(spark, sf))
    return out.withColumn("nb_observations", F.col("nb_observations").cast("long"))


@register("listing_ratio", "P14", with_adapter(f"""
SELECT id, {r('CASE WHEN surface_habitable > 0 THEN prix_affiche / surface_habitable END', 4)} AS prix_m2 FROM listings
"""))
def q_listing_ratio(spark, sf):
    out = LS.with_listing_ratio(T.listings(spark, sf))
    return out.select("id", rnd("prix_m2", 4).alias("prix_m2"))


@register("listing_price_summary", "A25", with_adapter(f"""
SELECT COUNT(prix_affiche) AS nb, {r('AVG(prix_affiche)')} AS prix_moyen, {r('MIN(prix_affiche)')} AS prix_min,
       {r('MAX(prix_affiche)')} AS prix_max
FROM listings
"""))
def q_listing_price_summary(spark, sf):
    out = LS.price_summary(T.listings(spark, sf))
    return out.select("nb", *[rnd(c).alias(c) for c in ["prix_moyen", "prix_min", "prix_max"]])


# ------------------------------------------------------------ S11 ----------
def commune_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """One commune-API answer (a JSON list with one commune) per customer, with
    the gaps real answers have: no postal code, zero area, no centre."""
    c = T.read(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    k = F.col("c_custkey")
    postal = F.lpad((F.col("c_nationkey") % 7 * 1000 + 1000).cast("string"), 5, "0")
    rec = F.struct(
        F.col("c_name").alias("nom"),
        F.lpad(k.cast("string"), 8, "0").alias("code"),
        F.when(k % 7 == 0, F.array().cast("array<string>")).otherwise(F.array(postal)).alias("codesPostaux"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("codeDepartement"),
        (F.col("c_nationkey") % 5).cast("string").alias("codeRegion"),
        ((k % 1000) * 37).alias("population"),
        F.when(k % 13 == 0, F.lit(0.0)).otherwise((k % 5000).cast("double") + 0.5).alias("surface"),
        F.when(k % 11 != 0, F.struct(F.array(T._coord(k, 53, 1200, -4.0), T._coord(k, 37, 900, 42.0))
                                     .alias("coordinates"))).alias("centre"),
    )
    return c.select(F.to_json(F.array(rec)).alias("payload"))


@register("json_flatten", "S11 P31", with_adapter("""
SELECT c_name AS nom_commune, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS code_commune,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE lpad(CAST(c_nationkey % 7 * 1000 + 1000 AS VARCHAR), 5, '0') END
         AS code_postal,
       lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS departement, CAST(c_nationkey % 5 AS VARCHAR) AS region,
       CAST((c_custkey % 1000) * 37 AS INTEGER) AS population,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE (CAST(c_custkey % 5000 AS DOUBLE) + 0.5) / 100 END AS superficie_km2,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 42.0 + CAST((c_custkey * 37) % 900 AS DOUBLE) / 100.0 END AS latitude,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE -4.0 + CAST((c_custkey * 53) % 1200 AS DOUBLE) / 100.0 END AS longitude
FROM customer
"""))
def q_json_flatten(spark, sf):
    return X.flatten_communes(commune_payloads(spark, sf))


# ------------------------------------------------------------ U1, U2 -------
@register("union_by_name", "U1 P35", with_adapter("""
SELECT id, nature_mutation, 'A' AS source_file FROM sales_base WHERE nature_mutation = 'F'
UNION ALL
SELECT id, NULL AS nature_mutation, 'B' AS source_file FROM sales_base WHERE nature_mutation = 'O'
"""))
def q_union_by_name(spark, sf):
    s = T.sales(spark, sf)
    a = s.where(F.col("nature_mutation") == "F").select("id", "nature_mutation", F.lit("A").alias("source_file"))
    b = s.where(F.col("nature_mutation") == "O").select("id", F.lit("B").alias("source_file"))
    return X.union_files([a, b]).select("id", "nature_mutation", "source_file")


@register("dept_keys", "U2 P38 A7", with_adapter("""
SELECT DISTINCT CASE WHEN starts_with(code_postal, '97') THEN substr(code_postal, 1, 3)
                     ELSE substr(code_postal, 1, 2) END AS dept
FROM sales_base WHERE code_postal IS NOT NULL
"""))
def q_dept_keys(spark, sf):
    return X.department_keys(T.sales(spark, sf), "code_postal")


# ------------------------------------------------------------ E1-E4 --------
EXTRACT_TYPES = ["1-URGENT", "2-HIGH"]


@register("sales_extract", "E1 E2 F3 F4 F5 K4", with_feat("""
SELECT id, date_mutation, departement, type_local FROM feat
WHERE trim(departement) = 'AMERICA' AND date_mutation BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'
  AND type_local IN ('1-URGENT', '2-HIGH')
ORDER BY date_mutation, id LIMIT 500
"""))
def q_sales_extract(spark, sf):
    out = X.sales_extract(features(spark, sf), departement="AMERICA", date_debut="1998-01-01",
                          date_fin="1999-12-31", types=EXTRACT_TYPES, max_records=500)
    return out.select("id", "date_mutation", "departement", "type_local")


SEARCHES = [("AMERICA", "Americas"), ("ASIA", "Asian cities"), ("EUROPE", "European cities")]


@register("multi_dept_extract", "E3 W2 P35 S7", with_feat("""
SELECT id, dept_recherche, CASE dept_recherche WHEN 'AMERICA' THEN 'Americas' WHEN 'ASIA' THEN 'Asian cities'
                                                WHEN 'EUROPE' THEN 'European cities' END AS ville_recherche FROM (
  SELECT id, trim(departement) AS dept_recherche,
         row_number() OVER (PARTITION BY trim(departement) ORDER BY date_mutation, id) AS rk
  FROM feat WHERE trim(departement) IN ('AMERICA', 'ASIA', 'EUROPE'))
WHERE rk <= 200
"""))
def q_multi_dept_extract(spark, sf):
    out = X.multi_department(features(spark, sf), SEARCHES, 200)
    return out.select("id", "dept_recherche", "ville_recherche")


@register("recent_sales", "E4 P36", with_feat(f"""
SELECT id, date_mutation, departement FROM feat
WHERE date_mutation >= DATE '{AS_OF}' - INTERVAL 180 DAY AND departement IN ('AMERICA', 'ASIA')
"""))
def q_recent_sales(spark, sf):
    f = features(spark, sf).where(F.col("departement").isin("AMERICA", "ASIA"))
    return X.recent(f, AS_OF, 6).select("id", "date_mutation", "departement")


# ------------------------------------------------------------ S1-S7 --------
@register("sale_file_scan", "S1 S2 S5 S6 S7 E6", with_adapter(f"""
SELECT id, {SQL_DATE.format(c='date_mutation')} AS date_mutation, {SQL_NUM.format(c='valeur_fonciere')} AS valeur_fonciere
FROM raw_sales
WHERE year({SQL_DATE.format(c='date_mutation')}) BETWEEN 1998 AND 1999
"""))
def q_sale_file_scan(spark, sf):
    """Write the raw sales as pipe-delimited files, one folder per year, into
    the shared scratch area; read back two years (partition pruning) and parse."""
    raw = T.raw_sales(spark, sf)
    raw = raw.withColumn("annee", F.year(P.parse_date("date_mutation")))
    path = FS.scratch_path(spark, "sale_files")
    FS.write_by(raw, path, ["annee"], fmt="csv", sep="|", header=True)
    back = FS.read_years(spark, path, 1998, 1999, fmt="csv", sep="|", header=True)
    back = back.select(F.col("id").cast("long").alias("id"), "date_mutation", "valeur_fonciere")
    return back.select("id", P.parse_date("date_mutation").alias("date_mutation"),
                       P.parse_number("valeur_fonciere").alias("valeur_fonciere"))


# Original headers of a sale file for the columns the raw adapter renders.
_FILE_HEADERS = {"date_mutation": "Date mutation", "valeur_fonciere": "Valeur fonciere",
                 "code_departement": "Code departement", "code_commune": "Code commune",
                 "code_postal": "Code postal", "surface_reelle_bati": "Surface reelle bati",
                 "nb_pieces": "Nombre pieces principales", "type_local": "Type local"}


@register("newest_sale_file", "S1 S2 S4 P1 P2 S6", with_adapter(f"""
SELECT id, {SQL_DATE.format(c='date_mutation')} AS date_mutation, {SQL_NUM.format(c='valeur_fonciere')} AS valeur_fonciere
FROM raw_sales
WHERE year({SQL_DATE.format(c='date_mutation')}) = (SELECT MAX(year(CAST(o_orderdate AS DATE))) FROM orders)
"""))
def q_newest_sale_file(spark, sf):
    """Write pipe-delimited files with the original headers, a folder of several files a
    year, pick the newest year by name (S4), read all its files with an all-string schema,
    rename the headers (P1) and resolve the id column among candidates (P2)."""
    raw = T.raw_sales(spark, sf).withColumn("annee", F.year(P.parse_date("date_mutation")))
    raw = raw.withColumnsRenamed(_FILE_HEADERS).withColumnRenamed("id", "Identifiant")
    path = FS.scratch_path(spark, "year_files")
    FS.write_by(raw, path, ["annee"], fmt="csv", sep="|", header=True)
    newest = FS.newest_files(spark, [f"{path}/annee=*/*.zip", f"{path}/annee=*/*.csv"])
    df = P.standardize_columns(FS.read_delimited(spark, newest, sep="|"))
    id_col = P.resolve_column(df, ["id", "Identifiant", "identifiant"])
    return df.select(F.col(id_col).cast("long").alias("id"), P.parse_date("date_mutation").alias("date_mutation"),
                     P.parse_number("valeur_fonciere").alias("valeur_fonciere"))


@register("price_history_pages", "§2.16 evolution_prix", with_adapter("""
SELECT listing_id, CAST(row_number() OVER w - 1 AS INTEGER) AS page, mois, evolution_prix, nb_observations,
       CAST(COALESCE(SUM(nb_observations) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS nb_avant,
       lag(dernier) OVER w AS prix_precedent
FROM (SELECT listing_id, strftime(date_observation, '%Y-%m') AS mois,
             '[' || string_agg('{"date":"' || strftime(date_observation, '%Y-%m-%dT%H:%M:%S') || '","prix":'
                               || CAST(prix AS VARCHAR) || '}', ',' ORDER BY date_observation, id) || ']' AS evolution_prix,
             COUNT(*) AS nb_observations, arg_max(prix, (date_observation, id)) AS dernier
      FROM price_history GROUP BY 1, 2)
WINDOW w AS (PARTITION BY listing_id ORDER BY mois)
"""))
def q_price_history_pages(spark, sf):
    """Price histories in pages of a calendar month, with what comes before each page."""
    out = LS.price_history_pages(T.price_history(spark, sf))
    return out.withColumn("nb_observations", F.col("nb_observations").cast("long"))
