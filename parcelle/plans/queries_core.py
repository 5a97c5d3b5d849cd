"""Queries over the derived sales table: views, cleaning, features, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.functions import rnd
from parcelle.functions.derive import derive_sales
from parcelle.operators import marts
from parcelle.plans.catalog import register
from parcelle.plans.oracle import r, with_adapter
from parcelle.sources import tables as T

AS_OF = "2001-08-01"


def sales_d(spark: SparkSession, sf: str) -> DataFrame:
    return derive_sales(T.sales(spark, sf))


def round_cols(df: DataFrame, cols: list[str], d: int = 2) -> DataFrame:
    return df.withColumns({c: rnd(c, d) for c in cols})


# ---------------------------------------------------------------- A1 -------
@register("price_stats", "A1 A4 J2 P13 P37", with_adapter(f"""
SELECT c.code_commune, c.nom_commune, c.departement, c.region, s.type_local,
       COUNT(*) AS nb_ventes,
       {r('AVG(s.prix_m2)')} AS prix_m2_moyen,
       {r('quantile_cont(s.prix_m2, 0.5)')} AS prix_m2_median,
       {r('MIN(s.prix_m2)')} AS prix_m2_min,
       {r('MAX(s.prix_m2)')} AS prix_m2_max,
       {r('STDDEV_SAMP(s.prix_m2)')} AS prix_m2_stddev,
       {r('AVG(CAST(s.valeur_fonciere AS DECIMAL(18,2)))')} AS prix_moyen,
       MAX(s.date_mutation) AS derniere_vente
FROM sales s JOIN communes c ON s.commune_id = c.id
WHERE s.date_mutation >= DATE '{AS_OF}' - INTERVAL 12 MONTH
  AND s.prix_m2 IS NOT NULL AND s.prix_m2 > 0
GROUP BY c.code_commune, c.nom_commune, c.departement, c.region, s.type_local
"""))
def q_price_stats(spark: SparkSession, sf: str) -> DataFrame:
    out = marts.price_stats(sales_d(spark, sf), T.communes(spark, sf), as_of=AS_OF)
    return round_cols(out, ["prix_m2_moyen", "prix_m2_median", "prix_m2_min", "prix_m2_max",
                            "prix_m2_stddev", "prix_moyen"])


# ---------------------------------------------------------------- A2 -------
@register("monthly_trends", "A2 P33 J2", with_adapter(f"""
SELECT CAST(date_trunc('month', s.date_mutation) AS DATE) AS mois, c.departement, c.nom_commune, s.type_local,
       COUNT(*) AS nb_ventes,
       {r('AVG(s.prix_m2)')} AS prix_m2_moyen,
       {r('SUM(CAST(s.valeur_fonciere AS DECIMAL(18,2)))')} AS volume_total_euros
FROM sales s JOIN communes c ON s.commune_id = c.id
WHERE s.prix_m2 IS NOT NULL
GROUP BY 1, 2, 3, 4
"""))
def q_monthly_trends(spark: SparkSession, sf: str) -> DataFrame:
    out = marts.monthly_trends(sales_d(spark, sf), T.communes(spark, sf))
    return round_cols(out, ["prix_m2_moyen", "volume_total_euros"])
