"""Listing history and listing-side reports (W3, P14, A25, declared JSON columns)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelle.functions import derive as D

def _month(ts_col: str) -> Column:
    return F.date_trunc("month", F.col(ts_col).cast("timestamp"))


def _carried(lasts: DataFrame, key: str, value: str, out_col: str) -> DataFrame:
    """``lasts`` (a row a key and month) with the value of the key's month before."""
    return lasts.withColumn(out_col, F.lag(value).over(Window.partitionBy(key).orderBy("_month")))


def previous_value(df: DataFrame, key: str, ts_col: str, tie_col: str, value_col: str, out_col: str) -> DataFrame:
    """``lag(value)`` over (key ordered by ts, tie) that never sorts a key in one task.

    One path for every size: the window runs per key and calendar month, and the first
    row of a month takes the last value of the key's month before from a table of one
    row a key and month.  A row without a time comes first, as in the plain window; a
    task holds at most one month of one key."""
    w = Window.partitionBy(key, "_month").orderBy(ts_col, tie_col)
    local = df.withColumn("_month", _month(ts_col)).withColumns({"_prev": F.lag(value_col).over(w), "_rn": F.row_number().over(w)})
    lasts = local.groupBy(key, "_month").agg(F.max_by(value_col, F.col("_rn")).alias("_last"))
    carry = _carried(lasts, key, "_last", "_carry").select(F.col(key).alias("_c_key"), F.col("_month").alias("_c_month"), "_carry")
    same = F.col(key).eqNullSafe(F.col("_c_key")) & F.col("_month").eqNullSafe(F.col("_c_month"))
    out = local.join(carry, same, "left")
    return (out.withColumn(out_col, F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_prev")))
               .select(*[c for c in df.columns if c != out_col], out_col))


def price_variation(history: DataFrame, listing_col: str = "listing_id", ts_col: str = "date_observation",
                    price_col: str = "prix", tie_col: str = "id") -> DataFrame:
    """Percent change from the previous observed price of the same listing
    (NULL for the first observation)."""
    out = previous_value(history, listing_col, ts_col, tie_col, price_col, "prix_precedent")
    return out.withColumn("variation_pct", D.percent_diff(F.col(price_col), F.col("prix_precedent")))


def price_history_json(history: DataFrame, listing_col: str = "listing_id", ts_col: str = "date_observation",
                       price_col: str = "prix", tie_col: str = "id") -> DataFrame:
    """Declared ``evolution_prix``: the listing's observations in time order as
    a JSON array of {date, prix}."""
    obs = F.struct(F.col(ts_col).alias("date"), F.col(tie_col).alias("_tie"), F.col(price_col).alias("prix"))
    g = history.groupBy(listing_col).agg(F.array_sort(F.collect_list(obs)).alias("_obs"))
    out = F.transform("_obs", lambda o: F.struct(F.date_format(o["date"], "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
                                                 o["prix"].alias("prix")))
    return g.select(listing_col, F.to_json(out).alias("evolution_prix"),
                    F.size("_obs").alias("nb_observations"))


def with_listing_ratio(listings: DataFrame, price_col: str = "prix_affiche",
                       area_col: str = "surface_habitable") -> DataFrame:
    """Unbounded price per area where the area is positive."""
    return listings.withColumn("prix_m2", D.listing_price_m2(price_col, area_col))


def price_summary(listings: DataFrame, price_col: str = "prix_affiche") -> DataFrame:
    """Count, mean, min and max asking price."""
    p = F.col(price_col)
    return listings.agg(F.count(p).alias("nb"), F.avg(p).alias("prix_moyen"),
                        F.min(p).alias("prix_min"), F.max(p).alias("prix_max"))


# Energy labels allowed by the listings table.
ENERGY_CLASSES = ["A", "B", "C", "D", "E", "F", "G"]


def listing_rules(min_year: int = D.MIN_YEAR, max_year: int = D.MAX_YEAR) -> list[tuple[str, "F.Column"]]:
    """S15/F10 for listings: the table's CHECK constraints plus the configured
    build-year range (declared in the settings, applied here)."""
    def energy(c: str):
        return F.col(c).isNotNull() & ~F.col(c).isin(*ENERGY_CLASSES)

    return [
        ("url_missing", F.col("url").isNull()),
        ("price_missing", F.col("prix_affiche").isNull()),
        ("price_not_positive", F.col("prix_affiche") <= 0),
        ("area_not_positive", F.col("surface_habitable") <= 0),
        ("build_year_out_of_range", (F.col("annee_construction") < min_year) | (F.col("annee_construction") > max_year)),
        ("dpe_invalid", energy("dpe_classe")),
        ("ges_invalid", energy("ges_classe")),
        ("quality_out_of_range", (F.col("data_quality_score") < 0) | (F.col("data_quality_score") > 100)),
    ]


def with_photo_count(listings: DataFrame, urls_col: str = "photos_urls", out_col: str = "nb_photos") -> DataFrame:
    """Declared ``nb_photos`` from the photo URL list when not already known."""
    n = F.when(F.col(urls_col).isNotNull(), F.size(urls_col))
    return listings.withColumn(out_col, F.coalesce(F.col(out_col), n) if out_col in listings.columns else n)


def price_history_pages(history: DataFrame, listing_col: str = "listing_id", ts_col: str = "date_observation",
                        price_col: str = "prix", tie_col: str = "id") -> DataFrame:
    """``evolution_prix`` in pages, one per listing and calendar month with an observation,
    for histories too long for one value.  A page has its number in the listing (from 0),
    its month, the month's observations as a JSON array in time order, their count and,
    carried over from the pages before, the number of earlier observations and the last
    price before it.  Pages depend on the dates alone, never on how many rows there are."""
    obs = F.struct(F.col(ts_col).alias("date"), F.col(tie_col).alias("_tie"), F.col(price_col).alias("prix"))
    g = (history.withColumn("_month", _month(ts_col)).groupBy(listing_col, "_month")
                .agg(F.array_sort(F.collect_list(obs)).alias("_obs"),
                     F.max_by(price_col, F.struct(ts_col, tie_col)).alias("_last")))
    out = F.transform("_obs", lambda o: F.struct(F.date_format(o["date"], "yyyy-MM-dd'T'HH:mm:ss").alias("date"),
                                                 o["prix"].alias("prix")))
    pages = g.select(listing_col, "_month", F.to_json(out).alias("evolution_prix"),
                     F.size("_obs").alias("nb_observations"), "_last")
    w = Window.partitionBy(listing_col).orderBy("_month")
    earlier = F.sum("nb_observations").over(w.rowsBetween(Window.unboundedPreceding, -1))
    # The window holds a row a month of a listing; the JSON texts wait outside of it.
    steps = _carried(pages.select(listing_col, "_month", "nb_observations", "_last"), listing_col, "_last", "prix_precedent")
    steps = steps.withColumns({"page": F.row_number().over(w) - 1, "nb_avant": F.coalesce(earlier, F.lit(0))})
    steps = steps.select(F.col(listing_col).alias("_s_key"), F.col("_month").alias("_s_month"), "page", "nb_avant", "prix_precedent")
    same = F.col(listing_col).eqNullSafe(F.col("_s_key")) & F.col("_month").eqNullSafe(F.col("_s_month"))
    return (pages.join(steps, same, "inner")
                 .select(listing_col, "page", F.date_format("_month", "yyyy-MM").alias("mois"), "evolution_prix",
                         "nb_observations", "nb_avant", "prix_precedent"))
