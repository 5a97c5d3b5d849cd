"""Queries on stored tables: key and row rules on write, merge with linking."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.functions import derive as D
from parcelle.functions import rnd
from parcelle.operators import clean as C
from parcelle.operators import merge as MG
from parcelle.operators import reports as R
from parcelle.operators import view_store as VS
from parcelle.operators.keys import Foreign, Unique, check_keys
from parcelle.operators.link import distance_to_commune
from parcelle.plans.catalog import REGISTRY, register
from parcelle.plans.oracle import r, with_adapter
from parcelle.plans.queries_core import AS_OF, round_cols
from parcelle.plans.queries_misc import commune_payloads
from parcelle.session import ensure_checkpoint_dir, write_once
from parcelle.sources import tables as T


def fresh_path(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------ S15, F10 -----
def faulty_load(spark, sf: str) -> DataFrame:
    """A load of sales in which every rule is broken by some rows; a part of the
    sales comes twice under one ``dvf_id``."""
    s = D.derive_sales(T.sales(spark, sf))
    k = F.col("id")
    s = s.withColumns({
        "dvf_id": F.concat(F.lit("S"), k.cast("string")),
        "date_mutation": F.when(k % 97 != 5, F.col("date_mutation")),
        "valeur_fonciere": F.when(k % 89 == 7, F.lit(None)).when(k % 83 == 9, -F.col("valeur_fonciere")).otherwise(F.col("valeur_fonciere")),
        "type_local": F.when(k % 79 != 11, F.col("type_local")),
        "surface_reelle_bati": F.when(k % 73 == 13, -F.col("surface_reelle_bati")).otherwise(F.col("surface_reelle_bati")),
        "surface_terrain": F.when(k % 71 == 15, F.lit(-1.0)).when(k % 2 == 0, F.lit(10.0)),
        "mois": F.when(k % 67 == 17, F.lit(13)).otherwise(F.col("mois")),
        "trimestre": F.when(k % 61 == 19, F.lit(0)).otherwise(F.col("trimestre")),
        "jour_semaine": F.when(k % 59 == 21, F.lit(7)).otherwise(F.col("jour_semaine")),
        "data_quality_score": F.when(k % 53 == 23, F.lit(120)).otherwise(F.lit(50)),
        "nb_pieces": F.when(k % 47 == 25, F.lit(21)).otherwise(F.col("nb_pieces")),
        "annee_construction": F.when(k % 43 == 27, F.lit(1500)).when(k % 3 == 0, F.lit(1990)),
        "commune_id": F.when(k % 41 == 29, F.lit(1000) + k).otherwise(F.col("commune_id")),
    })
    return s.withColumn("copy", F.lit(0)).unionByName(s.where(k % 50 == 3).withColumn("copy", F.lit(1)))


@register("constraint_rejects", "S15 F10", with_adapter("""
, load AS (
  SELECT *, 0 AS copy FROM sales UNION ALL SELECT *, 1 FROM sales WHERE id % 50 = 3
), checked AS (
  SELECT id, copy, concat_ws(',',
      CASE WHEN id % 97 = 5 OR date_mutation IS NULL THEN 'date_missing' END,
      CASE WHEN id % 89 = 7 OR valeur_fonciere IS NULL THEN 'price_missing' END,
      CASE WHEN id % 89 <> 7 AND (CASE WHEN id % 83 = 9 THEN -valeur_fonciere ELSE valeur_fonciere END) <= 0 THEN 'price_not_positive' END,
      CASE WHEN id % 79 = 11 OR type_local IS NULL THEN 'type_missing' END,
      CASE WHEN (CASE WHEN id % 73 = 13 THEN -surface_reelle_bati ELSE surface_reelle_bati END) <= 0 THEN 'area_not_positive' END,
      CASE WHEN id % 71 = 15 THEN 'land_out_of_range' END,
      CASE WHEN id % 67 = 17 THEN 'month_out_of_range' END,
      CASE WHEN id % 61 = 19 THEN 'quarter_out_of_range' END,
      CASE WHEN id % 59 = 21 THEN 'weekday_out_of_range' END,
      CASE WHEN id % 53 = 23 THEN 'score_out_of_range' END,
      CASE WHEN id % 47 = 25 OR nb_pieces < 1 OR nb_pieces > 20 THEN 'rooms_out_of_range' END,
      CASE WHEN id % 43 = 27 THEN 'build_year_out_of_range' END,
      CASE WHEN row_number() OVER (PARTITION BY id ORDER BY copy) > 1 THEN 'dvf_id_taken' END,
      CASE WHEN id % 37 = 31 THEN 'dvf_id_stored' END,
      CASE WHEN (id % 41 = 29) OR (commune_id IS NOT NULL AND commune_id NOT IN (SELECT id FROM communes)) THEN 'commune_unknown' END) AS reasons
  FROM load
)
SELECT id, copy, reasons FROM checked WHERE reasons <> ''
""").replace("\n, load AS", ",\nload AS"))
def q_constraint_rejects(spark, sf):
    load = faulty_load(spark, sf)
    stored = T.sales(spark, sf).where("id % 37 = 31").select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("dvf_id"))
    rules = C.sales_rules(check_rooms=True, build_year="annee_construction")
    rows = C.check_constraints(load, rules).select("id", "copy", "dvf_id", "commune_id", "reject_reasons")
    rows = check_keys(rows, [Unique("dvf_id_taken", ["dvf_id"], stored, "dvf_id_stored")],
                      [Foreign("commune_unknown", "commune_id", T.communes(spark, sf))], order=["copy"])
    reasons = F.concat("reject_reasons", "key_reasons")
    return rows.where(F.size(reasons) > 0).select("id", "copy", F.concat_ws(",", reasons).alias("reasons"))


# ------------------------------------------------------------ S9, E10 ------
REFRESHED = "2024-06-01 00:00:00"
SQL_REFRESH = """
, stored AS (
  SELECT * FROM communes
), answers AS (
  SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS code, CAST((c_custkey % 1000) * 37 AS INTEGER) AS population,
         CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE (CAST(c_custkey % 5000 AS DOUBLE) + 0.5) / 100 END AS area FROM customer
  UNION ALL
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0'), CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE 777 + n_nationkey END,
         CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE CAST(n_nationkey + 1 AS DOUBLE) / 2 END FROM nation WHERE n_nationkey % 2 = 0
), added AS (
  SELECT code, (SELECT MAX(id) FROM stored) + row_number() OVER (ORDER BY code) AS id FROM answers WHERE code NOT IN (SELECT code_commune FROM stored)
), after AS (
  SELECT COALESCE(s.code_commune, a.code) AS code, COALESCE(s.id, n.id) AS id,
         CASE WHEN a.code IS NULL THEN s.population ELSE a.population END AS population,
         CASE WHEN a.code IS NULL THEN s.superficie_km2 ELSE a.area END AS area, s.densite_pop AS before,
         CASE WHEN a.code IS NULL THEN 'kept' WHEN s.id IS NULL THEN 'inserted' ELSE 'updated' END AS state
  FROM stored s FULL OUTER JOIN answers a ON s.code_commune = a.code LEFT JOIN added n ON n.code = a.code
), waiting AS (
  SELECT id, CASE WHEN id % 3 = 0 THEN NULL ELSE commune_id END AS commune_id,
         CASE WHEN id % 6 = 0 THEN lpad(CAST(id % 100 + 1 AS VARCHAR), 8, '0') WHEN id % 21 = 0 THEN 'XXXXX' ELSE code_commune END AS code FROM sales
)"""


def nation_payloads(spark, sf: str) -> DataFrame:
    """Answers for half of the stored communes, with gaps."""
    n = T.read(spark, sf, "nation").where("n_nationkey % 2 = 0")
    k = F.col("n_nationkey")
    rec = F.struct(F.lit("R").alias("nom"), F.lpad(k.cast("string"), 5, "0").alias("code"),
                   F.when(k % 4 != 0, k + 777).alias("population"),
                   F.when(k % 6 == 0, F.lit(0.0)).otherwise((k + 1).cast("double") * 50).alias("surface"))
    return n.select(F.to_json(F.array(rec)).alias("payload"))


@register("commune_refresh", "E10 S9 P30 P42 S11", with_adapter(f"""{SQL_REFRESH}
SELECT 'commune' AS entity, code AS key, state, id AS commune_id, population,
       {r('COALESCE(CASE WHEN population IS NOT NULL AND area > 0 THEN population / area END, before)')} AS densite_pop,
       CASE WHEN state = 'kept' THEN '2020-01-01 00:00:00' ELSE '{REFRESHED}' END AS updated_at FROM after
UNION ALL
SELECT 'sale', CAST(w.id AS VARCHAR), 'linked', a.id, NULL, NULL, NULL FROM waiting w JOIN after a ON w.code = a.code WHERE w.commune_id IS NULL
""").replace("\n, stored AS", ",\nstored AS"))
def q_commune_refresh(spark, sf):
    """Communes stored as a table, merged with the API's answers; then the waiting
    sales, stored by year, are linked to the communes."""
    places, sold = fresh_path(spark, "communes"), fresh_path(spark, "sales")
    before = T.communes(spark, sf).withColumn("updated_at", F.lit("2020-01-01 00:00:00").cast("timestamp"))
    MG.create_table(before, places, "code_commune")
    answers = commune_payloads(spark, sf).unionByName(nation_payloads(spark, sf))
    changed = MG.refresh_communes(spark, places, answers, REFRESHED).select("code_commune", "row_source")
    k = F.col("id")
    sales = D.derive_sales(T.sales(spark, sf)).select(
        "id", "annee", F.when(k % 3 != 0, F.col("commune_id")).alias("commune_id"),
        F.when(k % 6 == 0, F.lpad((k % 100 + 1).cast("string"), 8, "0")).when(k % 21 == 0, F.lit("XXXXX")).otherwise(F.col("code_commune")).alias("code_commune"))
    sales.repartition("annee").write.partitionBy("annee").parquet(sold)
    linked = MG.link_waiting(spark, sold, MG.read_table(spark, places))
    after = MG.read_table(spark, places).join(changed, "code_commune", "left")
    out = after.select(F.lit("commune").alias("entity"), F.col("code_commune").alias("key"), F.coalesce("row_source", F.lit("kept")).alias("state"),
                       F.col("id").alias("commune_id"), "population", rnd("densite_pop").alias("densite_pop"),
                       F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))
    # the linked sales as they now stand in the table
    now = spark.read.parquet(sold).join(linked.select("id"), "id", "left_semi")
    nothing = F.lit(None)
    return out.unionByName(now.select(F.lit("sale").alias("entity"), F.col("id").cast("string").alias("key"), F.lit("linked").alias("state"), "commune_id",
                                      nothing.cast("int").alias("population"), nothing.cast("double").alias("densite_pop"), nothing.cast("string").alias("updated_at")))


# ------------------------------------------------------------ A18, A26 -----
@register("near_centre_stats", "A18 P23 J17 G1", with_adapter(f"""
, placed AS (
  SELECT s.valeur_fonciere, s.prix_m2, 2 * 6371.0 * asin(sqrt(least(1.0, power(sin(radians(c.latitude - s.latitude) / 2), 2)
           + cos(radians(s.latitude)) * cos(radians(c.latitude)) * power(sin(radians(c.longitude - s.longitude) / 2), 2)))) AS d
  FROM sales s LEFT JOIN communes c ON s.commune_id = c.id
)
SELECT d < 300.0 AS proche_centre, COUNT(*) AS nb, {r('AVG(valeur_fonciere)')} AS prix_moyen, {r('AVG(prix_m2)')} AS prix_m2_moyen
FROM placed WHERE d IS NOT NULL GROUP BY 1
""").replace("\n, placed AS", ",\nplaced AS"))
def q_near_centre_stats(spark, sf):
    """The report by near-centre flag; the stand-in towns are far apart, so near
    means 300 km here."""
    s = distance_to_commune(D.derive_sales(T.sales(spark, sf)), T.communes(spark, sf))
    s = s.withColumn("proche_centre", D.near_centre("distance_centre_ville", 300.0)).where("proche_centre IS NOT NULL")
    return s.groupBy("proche_centre").agg(F.count(F.lit(1)).alias("nb"), rnd(F.avg("valeur_fonciere")).alias("prix_moyen"),
                                          rnd(F.avg("prix_m2")).alias("prix_m2_moyen"))


# ------------------------------------------------------------ S13 ----------
def refreshed_view(spark, sf: str, table: str) -> str:
    """A view's table stored before the last deliveries (a third of the sales since May
    2001), then the sales appended to theirs and the touched months refreshed; the folder."""
    sold, views = fresh_path(spark, "view-sales"), fresh_path(spark, "views")
    sales = D.derive_sales(T.sales(spark, sf)).select("id", "annee", "date_mutation", "commune_id", "type_local", "valeur_fonciere", "prix_m2")
    sales = write_once(sales, "all-sales")
    late = F.coalesce((F.col("id") % 3 == 0) & (F.col("date_mutation") >= "2001-05-01"), F.lit(False))
    sales.where(~late).repartition("annee").write.partitionBy("annee").parquet(sold)
    VS.create(spark.read.parquet(sold), views, tables=[table])
    delivery = sales.where(late)
    delivery.write.mode("append").partitionBy("annee").parquet(sold)
    VS.refresh(spark.read.parquet(sold), views, delivery, tables=[table])
    return views


@register("view_refresh", "S13 A1 A4 P37", REGISTRY["price_stats"].sql)
def q_view_refresh(spark, sf):
    out = VS.price_stats(spark, refreshed_view(spark, sf, "values"), T.communes(spark, sf), as_of=AS_OF)
    return round_cols(out, ["prix_m2_moyen", "prix_m2_median", "prix_m2_min", "prix_m2_max", "prix_m2_stddev", "prix_moyen"])


@register("trends_refresh", "S13 A2 P33", REGISTRY["monthly_trends"].sql)
def q_trends_refresh(spark, sf):
    out = VS.monthly_trends(spark, refreshed_view(spark, sf, "days"), T.communes(spark, sf))
    return round_cols(out, ["prix_m2_moyen", "volume_total_euros"])
