"""Linking sales to communes and attaching commune data.

Dimensions (communes) are bounded by the number of places: the joins against them are
broadcast behind a check of their size (``sizing.lookup``), and the sales fact is then not
shuffled for them; a larger side is joined on (key, salt).  Group statistics are aggregated first (map-side partial
aggregation) and joined back, instead of a correlated update per row.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelle.functions import derive as D
from parcelle.functions import geo as G
from parcelle.plans.sizing import lookup

MATCH_METHODS = ["existing", "exact", "ltrim", "postal"]


def link_by_code(df: DataFrame, communes: DataFrame, code_col: str = "code_commune",
                 out_col: str = "commune_id") -> DataFrame:
    """Dictionary lookup code -> id (left join; unknown codes get NULL)."""
    dim = communes.select(F.col("code_commune").alias("_lk_code"), F.col("id").alias("_lk_id"))
    j = lookup(df, dim, F.col(code_col), "_lk_code", "communes")
    return j.withColumn(out_col, F.col("_lk_id")).drop("_lk_code", "_lk_id")


def _one_per_key(communes: DataFrame, key, name: str) -> DataFrame:
    """Least commune id per key (T5: several matches are resolved, not arbitrary)."""
    return (communes.select(key.alias(f"_{name}_k"), F.col("id"))
                    .where(F.col(f"_{name}_k").isNotNull())
                    .groupBy(f"_{name}_k").agg(F.min("id").alias(f"_{name}_id")))


def link_cascade(sales: DataFrame, communes: DataFrame, code_col: str = "code_commune",
                 postal_col: str = "code_postal", id_col: str = "commune_id") -> DataFrame:
    """Fill a missing commune id by exact code, then by code without
    leading zeros, then by postal code; first hit wins.  ``match_method``
    tells which rule linked the row (NULL when none did)."""
    exact = _one_per_key(communes, F.col("code_commune"), "ex")
    ltrim = _one_per_key(communes, D.strip_leading_zeros("code_commune"), "lt")
    postal = _one_per_key(communes, F.col("code_postal"), "pc")
    s = sales
    s = lookup(s, exact, F.col(code_col), "_ex_k", "codes")
    s = lookup(s, ltrim, D.strip_leading_zeros(code_col), "_lt_k", "bare-codes")
    s = lookup(s, postal, F.col(postal_col), "_pc_k", "postal-codes")
    cur = F.col(id_col)
    method = (F.when(cur.isNotNull(), F.lit("existing"))
               .when(F.col("_ex_id").isNotNull(), F.lit("exact"))
               .when(F.col("_lt_id").isNotNull(), F.lit("ltrim"))
               .when(F.col("_pc_id").isNotNull(), F.lit("postal")))
    return (s.withColumns({id_col: F.coalesce(cur, F.col("_ex_id"), F.col("_lt_id"), F.col("_pc_id")),
                           "match_method": method})
             .drop("_ex_k", "_ex_id", "_lt_k", "_lt_id", "_pc_k", "_pc_id"))


def fill_coordinates(sales: DataFrame, communes: DataFrame, id_col: str = "commune_id") -> DataFrame:
    """J7 (+ T6): copy the commune centre when the row has no latitude and the
    commune has one; ``coord_source`` says where the coordinates come from."""
    dim = communes.select(F.col("id").alias("_fc_id"), F.col("latitude").alias("_fc_lat"),
                          F.col("longitude").alias("_fc_lon"))
    j = lookup(sales, dim, F.col(id_col), "_fc_id", "centres")
    take = F.col("latitude").isNull() & F.col("_fc_lat").isNotNull()
    return (j.withColumns({
        "coord_source": F.when(F.col("latitude").isNotNull(), F.lit("row")).when(take, F.lit("commune")),
        "latitude": F.when(take, F.col("_fc_lat")).otherwise(F.col("latitude")),
        "longitude": F.when(take, F.col("_fc_lon")).otherwise(F.col("longitude")),
    }).drop("_fc_id", "_fc_lat", "_fc_lon"))


def distance_to_commune(sales: DataFrame, communes: DataFrame, id_col: str = "commune_id",
                        method: str = "haversine", out_col: str = "distance_centre_ville") -> DataFrame:
    """Distance in km from each row to its commune centre; only where
    still NULL.  ``method="haversine"`` (G1, default) stands for the geodesic
    distance the warehouse computes whenever both points have coordinates;
    ``method="cosine"`` is its law-of-cosines fallback (G2); ``method="geodesic"``
    measures on the WGS84 ellipsoid (Vincenty)."""
    dim = communes.select(F.col("id").alias("_dc_id"), F.col("latitude").alias("_dc_lat"),
                          F.col("longitude").alias("_dc_lon"))
    j = lookup(sales, dim, F.col(id_col), "_dc_id", "centres")
    fn = {"cosine": G.cosine_law_km, "haversine": G.haversine_km, "geodesic": G.geodesic_km}[method]
    d = fn(F.col("latitude"), F.col("longitude"), F.col("_dc_lat"), F.col("_dc_lon"))
    if out_col in sales.columns:
        d = F.coalesce(F.col(out_col), d)
    return j.withColumn(out_col, d).drop("_dc_id", "_dc_lat", "_dc_lon")


def commune_stats(sales: DataFrame, id_col: str = "commune_id", ratio_col: str = "prix_m2") -> DataFrame:
    """Per commune with a ratio: count, mean ratio, mean price, mean area."""
    r = F.col(ratio_col)
    return (sales.where(F.col(id_col).isNotNull() & r.isNotNull() & (r > 0))
                 .groupBy(id_col).agg(
                     F.count(F.lit(1)).alias("nb_ventes"),
                     F.avg(r).alias("prix_m2_moyen"),
                     F.avg(F.col("valeur_fonciere").cast("decimal(18,2)")).alias("prix_moyen"),
                     F.avg("surface_reelle_bati").alias("surface_moyenne")))


def commune_features(sales: DataFrame, communes: DataFrame, id_col: str = "commune_id",
                     ratio_col: str = "prix_m2", near_km: float = 2.0) -> DataFrame:
    """J8/J9 + P23: mean ratio and sale count of the row's commune, commune
    population and density, near-centre flag."""
    r = F.col(ratio_col)
    stats = (sales.where(F.col(id_col).isNotNull() & r.isNotNull())
                  .groupBy(F.col(id_col).alias("_cs_id")).agg(F.avg(r).alias("commune_prix_m2_moyen"),
                                       F.count(F.lit(1)).cast("int").alias("commune_nb_ventes")))
    dim = communes.select(F.col("id").alias("_ca_id"), F.col("population").alias("commune_population"),
                          F.col("densite_pop").alias("commune_densite"))
    # The attributes are (re)computed: earlier values are replaced, as an UPDATE would.
    base = sales.drop("commune_prix_m2_moyen", "commune_nb_ventes", "commune_population", "commune_densite")
    out = lookup(base, stats, F.col(id_col), "_cs_id", "commune-stats")
    out = lookup(out, dim, F.col(id_col), "_ca_id", "commune-attributes").drop("_cs_id", "_ca_id")
    if "distance_centre_ville" in out.columns:
        out = out.withColumn("proche_centre", D.near_centre("distance_centre_ville", near_km))
    return out


def insert_new(target: DataFrame, incoming: DataFrame, key: str | list[str], order_col: str) -> DataFrame:
    """Incoming rows whose key is not in the target, exactly one per key:
    the first by ``order_col`` (nulls last), ties by all columns, ready to append.
    Counting after the anti-join gives the true number inserted (T16).

    Only keys counted more than once (a hash aggregate over the key columns) are
    ranked; a rank limit inside each partition keeps one row of a common key before
    the shuffle.  Rows with a key of their own go through as they are."""
    keys = [key] if isinstance(key, str) else list(key)
    again = (incoming.groupBy(*[F.col(c).alias(f"_a_{c}") for c in keys]).agg(F.count(F.lit(1)).alias("_n"))
                     .where(F.col("_n") > 1).drop("_n"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_a_{c}")) for c in keys])
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).asc_nulls_last(), *incoming.columns)
    first = (incoming.join(again, same, "left_semi").withColumn("_rank", F.row_number().over(w))
                     .where(F.col("_rank") == 1).drop("_rank"))
    batch = incoming.join(again, same, "left_anti").unionByName(first)
    return batch.join(target.select(*keys), keys, "left_anti")


def upsert(target: DataFrame, incoming: DataFrame, key: str, columns: list[str], now: Column | None = None) -> DataFrame:
    """Insert or overwrite by key.  Incoming values replace the stored
    ones, NULL included (no coalesce); ``row_source`` is 'updated', 'inserted'
    or 'kept', which also gives the insert/update counts (T15).  The target's
    other columns stay (NULL on inserted rows), and a kept row keeps its
    ``updated_at``; others get ``now`` (default: the current time)."""
    now = F.current_timestamp() if now is None else now
    stored = [c for c in target.columns if c != key]
    t = target.select(F.col(key), *[F.col(c).alias(f"_t_{c}") for c in stored]).withColumn("_t", F.lit(True))
    i = incoming.select(F.col(key), *[F.col(c).alias(f"_i_{c}") for c in columns]).withColumn("_i", F.lit(True))
    j = t.join(i, key, "full_outer")
    from_in = F.col("_i").isNotNull()
    src = (F.when(from_in & F.col("_t").isNotNull(), F.lit("updated"))
            .when(from_in, F.lit("inserted")).otherwise(F.lit("kept")))

    def value(c: str) -> Column:
        old = F.col(f"_t_{c}") if c in stored else F.lit(None)
        return F.when(from_in, F.col(f"_i_{c}")).otherwise(old).alias(c)

    before = F.col("_t_updated_at") if "updated_at" in stored else F.lit(None).cast("timestamp")
    others = [F.col(f"_t_{c}").alias(c) for c in stored if c not in columns and c not in ("updated_at", "row_source")]
    return j.select(F.col(key), *others, *[value(c) for c in columns], src.alias("row_source"),
                    F.when(from_in, now).otherwise(before).alias("updated_at"))


def insert_seed(target: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """The target plus seed rows whose key is absent (ON CONFLICT DO NOTHING)."""
    new = seed.join(target.select(key), key, "left_anti")
    return target.unionByName(new, allowMissingColumns=True)
