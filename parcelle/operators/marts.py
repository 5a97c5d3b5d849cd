"""The three warehouse views (A1-A3) as DataFrame functions.

Each view joins the large sales fact to a small commune dimension.  The
dimension is broadcast only behind a size check; the fact is aggregated with
map-side partial aggregation, so only one row per group and partition crosses
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.functions.derive import trailing_months_start
from parcelle.operators.quantiles import group_quantiles, join_groups
from parcelle.plans.sizing import broadcast_if_small

PRICE_STATS_KEYS = ["code_commune", "nom_commune", "departement", "region", "type_local"]


def price_stats(sales: DataFrame, communes: DataFrame, as_of: str, months: int = 12,
                ratio_col: str = "prix_m2") -> DataFrame:
    """A1: price statistics by commune and type over the trailing ``months``.

    ``sales`` carries ``commune_id, type_local, date_mutation, valeur_fonciere``
    and the ratio column; ``communes`` carries ``id`` and the label columns."""
    r = F.col(ratio_col)
    start = trailing_months_start(as_of, months)
    keep = (F.col("date_mutation") >= start) & r.isNotNull() & (r > 0)
    if "annee" in sales.columns:
        # Implied by the date bound; lets a year-partitioned table skip old years.
        keep = keep & (F.col("annee") >= F.year(start))
    s = sales.where(keep).select("commune_id", "type_local", "date_mutation", "valeur_fonciere", ratio_col)
    c = broadcast_if_small(communes.select(F.col("id").alias("commune_id"), *PRICE_STATS_KEYS[:-1]))
    j = s.join(c, "commune_id", "inner")
    aggs = [
        F.count(F.lit(1)).alias("nb_ventes"),
        F.avg(r).alias("prix_m2_moyen"),
        F.min(r).alias("prix_m2_min"),
        F.max(r).alias("prix_m2_max"),
        F.stddev_samp(r).alias("prix_m2_stddev"),
        # Money is DECIMAL(12,2) in the warehouse: average it exactly.
        F.avg(F.col("valeur_fonciere").cast("decimal(18,2)")).alias("prix_moyen"),
        F.max("date_mutation").alias("derniere_vente"),
    ]
    probs = {"prix_m2_median": 0.5}
    med = group_quantiles(j, PRICE_STATS_KEYS, ratio_col, probs)
    # Both sides are one row per group: a small join on the group keys.
    return join_groups(j.groupBy(*PRICE_STATS_KEYS).agg(*aggs), med, PRICE_STATS_KEYS)


def monthly_trends(sales: DataFrame, communes: DataFrame, ratio_col: str = "prix_m2") -> DataFrame:
    """A2: monthly count, mean ratio and total value by department, commune, type."""
    s = (sales.where(F.col(ratio_col).isNotNull())
              .select("commune_id", "type_local", "date_mutation", "valeur_fonciere", ratio_col))
    c = broadcast_if_small(communes.select(F.col("id").alias("commune_id"), "departement", "nom_commune"))
    j = s.join(c, "commune_id", "inner").withColumn("mois", F.trunc("date_mutation", "month"))
    return j.groupBy("mois", "departement", "nom_commune", "type_local").agg(
        F.count(F.lit(1)).alias("nb_ventes"),
        F.avg(ratio_col).alias("prix_m2_moyen"),
        F.sum(F.col("valeur_fonciere").cast("decimal(18,2)")).alias("volume_total_euros"),
    )


def district_analysis(quartiers: DataFrame, communes: DataFrame, sales: DataFrame, listings: DataFrame,
                      poi: DataFrame, as_of: str, months: int = 12, radius_m: float = 500.0,
                      poi_types: tuple[str, str, str] = ("transport", "ecole", "commerce"),
                      ratio_col: str = "prix_m2", listing_ratio_col: str = "prix_m2") -> DataFrame:
    """A3 by rewrite R1: sales and active listings are aggregated per district
    separately and joined (linear), instead of the district x sales x
    listings product; the place counts within ``radius_m`` of the district
    polygon come from one grid join (G5) instead of three correlated counts.

    ``sales`` and ``listings`` carry ``quartier_id`` (see
    ``spatial.locate_in_polygons``)."""
    from parcelle.operators.spatial import count_near_polygons

    s = (sales.where(F.col("quartier_id").isNotNull()
                     & (F.col("date_mutation") >= trailing_months_start(as_of, months)))
              .groupBy("quartier_id").agg(
                  # ids are unique per table, so the DISTINCT the fan-out needed is a plain count
                  F.count("id").alias("nb_ventes_12m"),
                  F.avg(ratio_col).alias("prix_m2_moyen_ventes"),
                  F.max("date_mutation").alias("derniere_vente")))
    lst = (listings.where(F.col("quartier_id").isNotNull() & (F.col("is_active") == F.lit(True)))
                   .groupBy("quartier_id").agg(
                       F.count("id").alias("nb_annonces_actives"),
                       F.avg(listing_ratio_col).alias("prix_m2_moyen_annonces"),
                       F.max("date_scraped").alias("derniere_maj_annonces")))
    near = count_near_polygons(quartiers, poi, radius_m, types=poi_types, out_prefix="nb_")
    near = near.select(F.col("id").alias("quartier_id"),
                       *[F.col(f"nb_{t}").alias(f"nb_{t}{'s' if not t.endswith('s') else ''}_{int(radius_m)}m")
                         for t in poi_types])
    c = broadcast_if_small(communes.select(F.col("id").alias("_cid"), "nom_commune", "departement"))
    q = (quartiers.select(F.col("id").alias("quartier_id"), "nom_quartier", F.col("commune_id").alias("_cid"),
                          "score_qualite_vie")
                  .join(c, "_cid", "inner").drop("_cid"))
    out = q.join(s, "quartier_id", "left").join(lst, "quartier_id", "left").join(near, "quartier_id", "left")
    gap = F.col("prix_m2_moyen_annonces") - F.col("prix_m2_moyen_ventes")
    return out.withColumns({
        "nb_ventes_12m": F.coalesce("nb_ventes_12m", F.lit(0)),
        "nb_annonces_actives": F.coalesce("nb_annonces_actives", F.lit(0)),
        "ecart_prix_m2": gap,
        "ecart_pct": F.try_divide(gap, F.nullif(F.col("prix_m2_moyen_ventes"), F.lit(0.0))) * 100,
    })
