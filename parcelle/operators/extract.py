"""Sales extracts and small structural operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.functions import derive as D
from parcelle.operators.reports import limit_per_group
from parcelle.plans.sizing import lookup

# Schema of a commune record as the commune API returns it.
COMMUNE_JSON = T.ArrayType(T.StructType([
    T.StructField("nom", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("codesPostaux", T.ArrayType(T.StringType())),
    T.StructField("codeDepartement", T.StringType()),
    T.StructField("codeRegion", T.StringType()),
    T.StructField("population", T.LongType()),
    T.StructField("surface", T.DoubleType()),
    T.StructField("centre", T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))])),
]))


def sales_extract(sales: DataFrame, departement: str | None = None, commune: str | None = None,
                  date_debut: str | None = None, date_fin: str | None = None,
                  types: Sequence[str] | None = None, max_records: int | None = 10000,
                  dept_col: str = "departement", commune_col: str = "code_commune",
                  order: Sequence[str] = ("date_mutation", "id")) -> DataFrame:
    """F3 (trimmed code equality), F4 (inclusive date range), F5 (type
    list) and K4 (first ``max_records`` in a stated order).  All filters are
    plain predicates, so they reach the parquet scan."""
    df = sales
    if departement is not None:
        df = df.where(F.trim(F.col(dept_col)) == departement)
    if commune is not None:
        df = df.where(F.trim(F.col(commune_col)) == commune)
    if date_debut is not None and date_fin is not None:
        df = df.where(F.col("date_mutation").between(F.to_date(F.lit(date_debut)), F.to_date(F.lit(date_fin))))
    if types:
        df = df.where(F.col("type_local").isin(*types))
    if max_records is not None:
        df = df.orderBy(*order).limit(max_records)
    return df


def multi_department(sales: DataFrame, departements: Sequence[tuple[str, str]], per_dept: int,
                     dept_col: str = "departement", order: Sequence[str] = ("date_mutation", "id"),
                     out_path: str | None = None) -> DataFrame:
    """One pass over the sales for several (department, city) searches,
    at most ``per_dept`` rows each, tagged with the searched department and
    city (P35, a literal map as long as the search list); with ``out_path``
    also written as one folder per department (S7)."""
    codes = [d for d, _ in departements]
    city = F.create_map(*[F.lit(x) for pair in departements for x in pair])
    dept = F.trim(F.col(dept_col))
    df = sales.where(dept.isin(*codes)).withColumns({"dept_recherche": dept,
                                                     "ville_recherche": F.element_at(city, dept)})
    out = limit_per_group(df, "dept_recherche", per_dept, list(order))
    if out_path is not None:
        out.write.mode("overwrite").partitionBy("dept_recherche").parquet(out_path)
    return out


def recent(sales: DataFrame, as_of: str, months: int = 6) -> DataFrame:
    """Sales of the last ``months`` x 30 days before ``as_of``."""
    return sales.where(F.col("date_mutation") >= D.recent_days_start(as_of, months))


def union_files(frames: Sequence[DataFrame]) -> DataFrame:
    """Append frames whose columns differ, aligned by name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def department_keys(sales: DataFrame, code_col: str = "code_commune") -> DataFrame:
    """U2 (+ T17): distinct department codes of the sales: 3 characters for
    overseas codes (97x), 2 otherwise."""
    c = F.col(code_col)
    return sales.where(c.isNotNull()).select(D.department_of(c).alias("dept")).distinct()


def flatten_communes(raw: DataFrame, json_col: str = "payload") -> DataFrame:
    """API payload (JSON list of commune objects) -> commune rows: first
    postal code (NULL for an empty list), area /100 (NULL for 0 or missing),
    latitude/longitude from the centre's [lon, lat] pair (NULL when absent)."""
    parsed = raw.select(F.inline(F.from_json(F.col(json_col), COMMUNE_JSON)))
    coords = F.col("centre.coordinates")
    return parsed.select(
        F.col("code").alias("code_commune"),
        F.col("nom").alias("nom_commune"),
        F.get(F.col("codesPostaux"), 0).alias("code_postal"),
        F.col("codeDepartement").alias("departement"),
        F.col("codeRegion").alias("region"),
        F.col("population").cast("int").alias("population"),
        D.hectares_to_km2(F.col("surface")).alias("superficie_km2"),
        F.get(coords, 1).alias("latitude"),
        F.get(coords, 0).alias("longitude"),
    )


def attach_dimension(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Attach dimension attributes (left join behind a check of the dimension's size)."""
    return lookup(fact, dim.withColumnRenamed(key, "_dim_key"), F.col(key), "_dim_key", "dimension").drop("_dim_key")


# Defaults of the department extract.
DEFAULT_START_DATE = "2022-01-01"
DEFAULT_END_DATE = "2024-12-31"
DEFAULT_TYPES = ["Appartement", "Maison"]
DEFAULT_DEPARTMENTS = [("75", "Paris"), ("69", "Lyon"), ("13", "Marseille"), ("33", "Bordeaux"), ("59", "Lille")]


def by_department(sales: DataFrame, departement: str, date_debut: str | None = None, date_fin: str | None = None,
                  max_records: int = 10000, dept_col: str = "code_departement") -> DataFrame:
    """One department, default date range and property types."""
    return sales_extract(sales, departement=departement, date_debut=date_debut or DEFAULT_START_DATE,
                         date_fin=date_fin or DEFAULT_END_DATE, types=DEFAULT_TYPES, max_records=max_records,
                         dept_col=dept_col)


def recent_departments(sales: DataFrame, as_of: str, months: int = 6,
                       departements: Sequence[tuple[str, str]] = tuple(DEFAULT_DEPARTMENTS),
                       per_dept: int = 10000, dept_col: str = "code_departement") -> DataFrame:
    """The last ``months`` x 30 days of several department searches (E3 + P36)."""
    return multi_department(recent(sales, as_of, months), list(departements), per_dept, dept_col=dept_col)
