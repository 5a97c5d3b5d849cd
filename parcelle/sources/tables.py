"""Domain tables derived from the driver's parquet tables.

The driver ships TPC-H-like tables, not property data.  These functions give
the property operators real input whose size grows with the driver tables:

* sales          = orders LEFT JOIN (lineitem aggregated per order) LEFT JOIN customer
* communes       = nation JOIN region, population from customer counts
* quartiers      = one 1 x 1 degree square ring per commune
* poi            = supplier, type by key
* listings       = open orders
* price_history  = events
* raw_sales      = sales rendered as the raw text a sale file would hold

Every expression here has a twin in ``parcelle.plans.oracle`` (DuckDB SQL).
Only the columns each query needs are read: the parquet scans are pruned by
Catalyst because everything stays a lazy DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.plans.sizing import broadcast_if_small

# Fixed values of the adapter (shared with the SQL oracle).
POI_TYPES = ["transport", "ecole", "commerce"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _coord(key: Column, mult: int, modulo: int, base: float) -> Column:
    return F.lit(base) + ((key * mult) % modulo).cast("double") / 100.0


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-order area (sum of quantities) and room count (number of lines).

    Partial aggregation runs map-side; the result is hash partitioned on the
    order key, which the following join on that key reuses."""
    li = read(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("_surface"),
        F.count(F.lit(1)).cast("int").alias("_pieces"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales table (no derived columns; see ``functions.derive.derive_sales``)."""
    o = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    lines = order_lines(spark, sf_dir)
    j = (o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
          .join(c, o.o_custkey == c.c_custkey, "left"))
    key = F.col("o_orderkey")
    no_coords = key % 10 == 0
    return j.select(
        key.alias("id"),
        F.col("o_orderdate").cast("date").alias("date_mutation"),
        F.col("o_orderstatus").alias("nature_mutation"),
        F.col("o_totalprice").alias("valeur_fonciere"),
        F.col("o_orderpriority").alias("type_local"),
        F.col("_pieces").alias("nb_pieces"),
        F.col("_surface").alias("surface_reelle_bati"),
        F.col("c_nationkey").cast("long").alias("commune_id"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("code_commune"),
        F.when(key % 4 != 0, F.lpad((F.col("c_nationkey") % 7 * 1000 + 1000).cast("string"), 5, "0"))
         .alias("code_postal"),
        F.when(key % 3 != 0, F.concat(F.lit("voie "), F.col("o_custkey").cast("string")))
         .alias("adresse_nom_voie"),
        F.when(~no_coords, _coord(F.col("o_custkey"), 37, 900, 42.0)).alias("latitude"),
        F.when(~no_coords, _coord(F.col("o_custkey"), 53, 1200, -4.0)).alias("longitude"),
    )


def communes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commune reference table: one row per nation (bounded by the nation table)."""
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    pop = (read(spark, sf_dir, "customer").groupBy("c_nationkey")
           .agg(F.count(F.lit(1)).alias("_ncust")))
    j = (n.join(broadcast_if_small(r), n.n_regionkey == r.r_regionkey, "inner")
          .join(pop, n.n_nationkey == pop.c_nationkey, "left"))
    k = F.col("n_nationkey")
    population = (F.col("_ncust") * 1000).cast("int")
    area = (k + 10).cast("double")
    return j.select(
        k.cast("long").alias("id"),
        F.lpad(k.cast("string"), 5, "0").alias("code_commune"),
        F.col("n_name").alias("nom_commune"),
        F.lpad((k % 7 * 1000 + 1000).cast("string"), 5, "0").alias("code_postal"),
        F.col("r_name").alias("departement"),
        F.col("r_name").alias("region"),
        population.alias("population"),
        area.alias("superficie_km2"),
        F.try_divide(population, F.nullif(area, F.lit(0.0))).alias("densite_pop"),
        (F.lit(42.0) + (k % 5 * 2).cast("double")).alias("latitude"),
        (F.lit(-4.0) + (k % 6 * 2).cast("double")).alias("longitude"),
    )


def quartiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One square district per commune, ring closed, anchored at the commune centre."""
    c = communes(spark, sf_dir).select("id", "nom_commune", "latitude", "longitude")
    lat, lon = F.col("latitude"), F.col("longitude")

    def pt(x: Column, y: Column) -> Column:
        return F.struct(x.alias("lon"), y.alias("lat"))

    ring = F.array(pt(lon, lat), pt(lon + 1.0, lat), pt(lon + 1.0, lat + 1.0),
                   pt(lon, lat + 1.0), pt(lon, lat))
    return c.select(
        F.col("id"),
        F.col("id").alias("commune_id"),
        F.concat(F.lit("Q-"), F.col("nom_commune")).alias("nom_quartier"),
        ring.alias("ring"),
        ((F.col("id") % 10).cast("double") / 2.0).alias("score_qualite_vie"),
    )


def poi(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey")
    types = F.array(*[F.lit(t) for t in POI_TYPES])
    return s.select(
        k.alias("id"),
        F.get(types, (k % 3).cast("int")).alias("type_poi"),
        F.col("s_name").alias("nom"),
        F.col("s_nationkey").cast("long").alias("commune_id"),
        _coord(k, 37, 900, 42.0).alias("latitude"),
        _coord(k, 53, 1200, -4.0).alias("longitude"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders as listings; asking price = total price x 1.05."""
    o = (read(spark, sf_dir, "orders")
         .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
         .where(F.col("o_orderstatus") == "O"))
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    lines = order_lines(spark, sf_dir)
    j = (o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
          .join(c, o.o_custkey == c.c_custkey, "left"))
    key = F.col("o_orderkey")
    return j.select(
        key.alias("id"),
        F.concat(F.lit("L"), key.cast("string")).alias("listing_id"),
        F.concat(F.lit("https://annonces.example/"), key.cast("string")).alias("url"),
        F.col("o_orderdate").alias("date_scraped"),
        (key % 2 == 0).alias("is_active"),
        (F.col("o_totalprice") * 1.05).alias("prix_affiche"),
        F.col("_surface").alias("surface_habitable"),
        F.col("_pieces").alias("nb_pieces"),
        F.col("c_nationkey").cast("long").alias("commune_id"),
        _coord(F.col("o_custkey"), 37, 900, 42.0).alias("latitude"),
        _coord(F.col("o_custkey"), 53, 1200, -4.0).alias("longitude"),
    )


def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("listing_id"),
        F.col("value").alias("prix"),
        F.col("ts").alias("date_observation"),
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales rendered as the all-string columns of a raw sale file.

    Dates day-first for even keys, ISO for odd; prices with a decimal comma
    (and a leading space for every fifth key); codes with a trailing ``.0``
    for every third key; department and commune number split apart."""
    s = sales(spark, sf_dir)
    key = F.col("id")
    price_txt = F.regexp_replace(F.col("valeur_fonciere").cast("decimal(14,2)").cast("string"), r"\.", ",")
    dept = F.substring("code_commune", 1, 2).cast("int").cast("string")
    num = F.col("commune_id").cast("string")
    dotted = key % 3 == 0
    return s.select(
        key.alias("id"),
        F.when(key % 2 == 0, F.date_format("date_mutation", "dd/MM/yyyy"))
         .otherwise(F.date_format("date_mutation", "yyyy-MM-dd")).alias("date_mutation"),
        F.when(key % 5 == 0, F.concat(F.lit(" "), price_txt)).otherwise(price_txt).alias("valeur_fonciere"),
        F.when(dotted, F.concat(dept, F.lit(".0"))).otherwise(dept).alias("code_departement"),
        F.when(dotted, F.concat(num, F.lit(".0"))).otherwise(num).alias("code_commune"),
        F.when(key % 3 == 1, F.concat(F.col("code_postal"), F.lit(".0")))
         .otherwise(F.col("code_postal")).alias("code_postal"),
        F.col("surface_reelle_bati").cast("string").alias("surface_reelle_bati"),
        F.col("nb_pieces").cast("string").alias("nb_pieces"),
        F.col("type_local"),
        F.col("nature_mutation"),
    )
