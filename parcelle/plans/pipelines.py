"""End-to-end entry points (E6-E11) as compositions of the operators.

Each stage is a pure DataFrame -> DataFrame step; a whole run is one lazy
plan per output, written once.  The warehouse's 30 UPDATE/DELETE statements
become column expressions and joins inside that plan (R5).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.functions import derive as D
from parcelle.functions import parse as P
from parcelle.operators import clean as C
from parcelle.operators import link as L
from parcelle.operators import marts
from parcelle.operators import reports as R
from parcelle.operators import spatial
from parcelle.session import write_once
from parcelle.sources import files as FS
from parcelle.sources import pages as PG


@dataclass
class LoadResult:
    accepted: DataFrame   # rows to append (new keys only)
    rejected: DataFrame   # rows failing a constraint, with reasons


def load_sales(raw: DataFrame, target: DataFrame, communes: DataFrame) -> LoadResult:
    """Normalize raw sale rows, link communes, check constraints and keep
    only sales whose content id is not yet in ``target``.  The valid rows are written
    once: ``insert_new`` counts their ids and reads them again."""
    df = P.truncate_widths(P.clean_raw_sales(raw))
    df = P.with_content_id(df, "date_mutation", "code_commune", "valeur_fonciere", P.SALE_CONTENT)
    df = D.derive_sales(L.link_by_code(df, communes))
    land = "surface_terrain" if "surface_terrain" in df.columns else None
    ok, bad = C.split_valid(df, C.sales_rules(land=land, score=None))
    return LoadResult(L.insert_new(target, write_once(ok, "valid-sales"), "dvf_id", order_col="dvf_id"), bad)


def load_sales_file(spark: SparkSession, path: str, target: DataFrame, communes: DataFrame,
                    columns: list[str] | None = None, sep: str = "|", max_rows: int | None = None) -> LoadResult:
    """``load_sales`` of a raw sale file."""
    raw = FS.read_delimited(spark, path, columns, sep=sep)
    if max_rows is not None:
        raw = raw.limit(max_rows)  # S3 test mode
    return load_sales(raw, target, communes)


def clean_sales(sales: DataFrame, **thresholds) -> tuple[DataFrame, DataFrame]:
    """The cleaned table and its audit counts."""
    return C.clean(sales, **thresholds), C.audit_counts(sales)


def enrich_sales(sales: DataFrame, communes: DataFrame) -> DataFrame:
    """Link cascade, coordinates from the commune, distance to its centre."""
    out = L.link_cascade(sales, communes)
    out = L.fill_coordinates(out, communes)
    return L.distance_to_commune(out, communes)


def engineer_features(sales: DataFrame, communes: DataFrame) -> DataFrame:
    """Temporal, price, geographic and property features."""
    s = D.temporal_features(D.derive_sales(sales) if "prix_m2" not in sales.columns else sales)
    s = s.withColumns({
        "prix_par_piece": D.price_per_room("valeur_fonciere", "nb_pieces"),
        "m2_par_piece": D.area_per_room("surface_reelle_bati", "nb_pieces"),
        "grande_surface": D.large_area("surface_reelle_bati"),
        "type_local_encoded": D.type_code("type_local"),
        "taille_categorie": D.size_band("surface_reelle_bati"),
    })
    s = R.price_bands(s)
    return L.commune_features(s, communes)


def feature_report(features: DataFrame, cols: list[str]) -> DataFrame:
    """A10: completeness of the engineered columns."""
    return R.coverage(features, cols)


def listings_from_pages(search_pages: DataFrame, detail_pages: DataFrame, max_per_search: int = 100) -> DataFrame:
    """The first listings of every search (capped per search over all its
    result pages, W2, and tagged with it) with their detail pages (H7) and asking
    price per area (P14)."""
    cards = PG.search_listings(PG.cards_of(PG.scan_pages(search_pages)), max_per_search)
    merged = PG.merge_cards_details(cards, PG.page_details(detail_pages))
    return merged.withColumn("prix_m2", D.listing_price_m2("prix_affiche", "surface_habitable"))


def warehouse_views(sales: DataFrame, communes: DataFrame, quartiers: DataFrame, listings: DataFrame,
                    poi: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """The three views, ready for ``files.save_view``."""
    located = spatial.locate_in_polygons(sales, quartiers)
    lst = spatial.locate_in_polygons(listings, quartiers)
    return {
        "vw_price_stats": marts.price_stats(sales, communes, as_of),
        "vw_monthly_trends": marts.monthly_trends(sales, communes),
        "vw_quartier_analysis": marts.district_analysis(quartiers, communes, located, lst, poi, as_of),
    }


def run_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """The same counters before and after a run, as two rows."""
    def counters(df: DataFrame, label: str) -> DataFrame:
        return df.agg(F.lit(label).alias("state"), F.count(F.lit(1)).alias("total"),
                      F.count("commune_id").alias("with_commune"), F.count("latitude").alias("with_coords"),
                      F.count_if(F.col("commune_id").isNull()).alias("without_commune"))
    return counters(before, "before").unionByName(counters(after, "after"))


WAREHOUSE_TABLES = ("sales", "communes", "quartiers", "poi", "listings", "price_history")


def build_warehouse(spark: SparkSession, sf_dir: str, out_dir: str) -> dict[str, str]:
    """Write the domain tables once (sales with their derived columns,
    partitioned by year) so that views and reports read them instead of
    re-deriving them from the source tables each time."""
    from parcelle.sources import tables as T
    paths = {}
    for name in WAREHOUSE_TABLES:
        df = getattr(T, name)(spark, sf_dir)
        path = f"{out_dir.rstrip('/')}/{name}"
        if name == "sales":
            FS.write_by(D.derive_sales(df), path, ["annee"])
        else:
            df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


def read_warehouse(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{out_dir.rstrip('/')}/{name}") for name in WAREHOUSE_TABLES}
