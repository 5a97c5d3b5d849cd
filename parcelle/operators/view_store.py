"""Price and trend views kept as mergeable partials, refreshed month by month.

Two tables under one folder, both partitioned by the month of the sale:

* ``values``: per day, commune, type and ratio, the number of sales and the sum and
  number of their prices.  It is an exact histogram, so counts, means, deviations and
  also medians of any span of days come from it (A1);
* ``days``: per day, commune and type, the number of sales, the sum of their ratios and
  of their prices (A2).

A refresh recomputes the months that changed and replaces their folders by dynamic
partition overwrite (new files are staged, old ones go when the job commits); other
months are neither read nor written.  A refresh that was cut short can be run again: it
computes the months anew from the sales.  A month whose sales are all gone keeps one
empty partial.  Grouping is combined map-side; the groups are many and small, and a
commune or type with a third of all sales is spread over its days and ratios.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.functions.derive import trailing_months_start
from parcelle.operators.marts import PRICE_STATS_KEYS
from parcelle.operators.merge import replace_partitions
from parcelle.operators.quantiles import join_groups, quantiles
from parcelle.plans.sizing import lookup
from parcelle.session import write_once

MONTH = "_month"
MONEY = "decimal(18,2)"


def month_of(date: str = "date_mutation") -> Column:
    """The partition of a sale; sales without a date have one of their own."""
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit("none"))


def _values(sales: DataFrame, ratio_col: str) -> DataFrame:
    price = F.col("valeur_fonciere").cast(MONEY)
    return (sales.where(F.col(ratio_col) > 0)
                 .groupBy(MONTH, "date_mutation", "commune_id", "type_local", F.col(ratio_col).alias("ratio"))
                 .agg(F.count(F.lit(1)).alias("n"), F.sum(price).alias("volume"), F.count(price).alias("n_price")))


def _days(sales: DataFrame, ratio_col: str) -> DataFrame:
    return (sales.where(F.col(ratio_col).isNotNull())
                 .groupBy(MONTH, "date_mutation", "commune_id", "type_local")
                 .agg(F.count(F.lit(1)).alias("n"), F.sum(ratio_col).alias("ratio_sum"),
                      F.sum(F.col("valeur_fonciere").cast(MONEY)).alias("volume")))


PARTIALS = {"values": _values, "days": _days}


def create(sales: DataFrame, path: str, ratio_col: str = "prix_m2", tables: Sequence[str] = tuple(PARTIALS)) -> None:
    """Write the tables for all sales."""
    sales = sales.withColumn(MONTH, month_of())
    for name in tables:
        partial = PARTIALS[name]
        partial(sales, ratio_col).repartition(F.col(MONTH)).write.partitionBy(MONTH).parquet(f"{path}/{name}")


def refresh(sales: DataFrame, path: str, changed: DataFrame, ratio_col: str = "prix_m2",
            tables: Sequence[str] = tuple(PARTIALS)) -> list[str]:
    """Bring the tables up to date with ``sales`` as they now are.  ``changed`` holds the
    rows that were added, removed or altered (altered ones as before and after); only
    their months are recomputed.  Returns these months (one each, at most as many as the
    sales span)."""
    spark = sales.sparkSession
    months = write_once(changed.select(month_of().alias(MONTH), F.year("date_mutation").alias("annee")).distinct(), "changed-months")
    found = months.collect()
    names, years = sorted({r[0] for r in found}), sorted({r[1] for r in found if r[1] is not None})
    if not names:
        return []
    if "annee" in sales.columns and "none" not in names:
        sales = sales.where(F.col("annee").isin(years))       # skips the folders of other years
    sales = sales.withColumn(MONTH, month_of()).where(F.col(MONTH).isin(names))
    for name in tables:
        partial = PARTIALS[name]
        stored = spark.read.parquet(f"{path}/{name}").schema
        empty = months.select(MONTH, F.lit(0).cast("long").alias("n")).distinct()
        rows = partial(sales, ratio_col).unionByName(empty, allowMissingColumns=True)
        rows = rows.select(*[F.col(f.name).cast(f.dataType) if f.name != MONTH else F.col(MONTH) for f in stored.fields])
        replace_partitions(write_once(rows, f"refreshed-{name}"), f"{path}/{name}", MONTH)
    return names


def _stored(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}").where(F.col("n") > 0)


def _with_commune(partials: DataFrame, communes: DataFrame, columns: list[str]) -> DataFrame:
    side = communes.select(F.col("id").alias("_vc_id"), *columns)
    return lookup(partials, side, F.col("commune_id"), "_vc_id", "communes").where(F.col("_vc_id").isNotNull())


def price_stats(spark: SparkSession, path: str, communes: DataFrame, as_of: str, months: int = 12) -> DataFrame:
    """A1 from the stored histogram: the columns of ``marts.price_stats``."""
    start = trailing_months_start(as_of, months)
    recent = _stored(spark, path, "values").where((F.col(MONTH) >= F.date_format(start, "yyyy-MM")) & (F.col("date_mutation") >= start))
    j = _with_commune(recent, communes, PRICE_STATS_KEYS[:-1])
    n, v = F.col("n"), F.col("ratio")
    total, sums, squares = F.sum(n), F.sum(n * v), F.sum(n * v * v)
    spread = F.greatest(F.lit(0.0), squares - sums * sums / total)
    g = j.groupBy(*PRICE_STATS_KEYS).agg(
        total.alias("nb_ventes"), (sums / total).alias("prix_m2_moyen"), F.min(v).alias("prix_m2_min"),
        F.max(v).alias("prix_m2_max"), F.sqrt(F.try_divide(spread, total - 1)).alias("prix_m2_stddev"),
        F.try_divide(F.sum("volume").cast("decimal(28,2)"), F.sum("n_price")).cast("double").alias("prix_moyen"),
        F.max("date_mutation").alias("derniere_vente"))
    med = quantiles(j, PRICE_STATS_KEYS, {"ratio": {"prix_m2_median": 0.5}}, weight="n")
    return join_groups(g, med, PRICE_STATS_KEYS)


def monthly_trends(spark: SparkSession, path: str, communes: DataFrame) -> DataFrame:
    """A2 from the stored days: the columns of ``marts.monthly_trends``."""
    j = _with_commune(_stored(spark, path, "days"), communes, ["departement", "nom_commune"])
    return j.groupBy(F.trunc("date_mutation", "month").alias("mois"), "departement", "nom_commune", "type_local").agg(
        F.sum("n").alias("nb_ventes"), (F.sum("ratio_sum") / F.sum("n")).alias("prix_m2_moyen"),
        F.sum("volume").alias("volume_total_euros"))
