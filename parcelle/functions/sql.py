"""The warehouse's scalar functions as Spark SQL functions.

``register_sql_functions(spark)`` creates session-scoped SQL functions
(``CREATE TEMPORARY FUNCTION ... RETURN <expression>``).  They are SQL
expressions, not Python: Catalyst inlines them into the calling plan, so they
stay inside whole-stage code generation like the Column functions in
``functions.derive`` / ``functions.geo``, which they mirror.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from parcelle.functions import derive as D
from parcelle.functions.geo import EARTH_RADIUS_KM


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _season_case() -> str:
    parts = " ".join(f"WHEN m IN ({', '.join(map(str, months))}) THEN {_quoted(label)}" for label, months in D.SEASONS)
    return f"CASE {parts} END"


def _type_case() -> str:
    parts = " ".join(f"WHEN t = {_quoted(label)} THEN {code}" for label, code in D.TYPE_CODES)
    return f"CASE {parts} ELSE 0 END"


def _size_case() -> str:
    parts = " ".join(f"WHEN a <= {upper} THEN {_quoted(label)}" for upper, label in D.SIZE_BANDS)
    return f"CASE WHEN a IS NULL THEN NULL {parts} ELSE {_quoted(D.SIZE_BAND_TOP)} END"


def _quality_case() -> str:
    parts = " ".join(f"WHEN s >= {lo} THEN {_quoted(label)}" for lo, label in D.QUALITY_BANDS)
    return f"CASE {parts} ELSE {_quoted(D.QUALITY_BAND_LOW)} END"


def definitions() -> dict[str, str]:
    r = EARTH_RADIUS_KM
    return {
        "distance_km": (
            "(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE RETURN "
            f"{2 * r} * asin(sqrt(least(1.0D, sin((radians(lat2) - radians(lat1)) / 2) * sin((radians(lat2) - radians(lat1)) / 2)"
            " + cos(radians(lat1)) * cos(radians(lat2))"
            " * (sin((radians(lon2) - radians(lon1)) / 2) * sin((radians(lon2) - radians(lon1)) / 2)))))"),
        "distance_cos_km": (
            "(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE RETURN "
            f"{r} * acos(greatest(-1.0D, least(1.0D, cos(radians(lat1)) * cos(radians(lat2))"
            " * cos(radians(lon2) - radians(lon1)) + sin(radians(lat1)) * sin(radians(lat2)))))"),
        "clean_price_per_m2": (
            "(p DOUBLE, a DOUBLE) RETURNS DOUBLE RETURN "
            f"CASE WHEN a > 0 AND p / a BETWEEN {D.MIN_PRICE_M2} AND {D.MAX_PRICE_M2} THEN p / a END"),
        "price_per_m2": "(p DOUBLE, a DOUBLE) RETURNS DOUBLE RETURN try_divide(p, nullif(a, 0))",
        "percent_diff": "(a DOUBLE, b DOUBLE) RETURNS DOUBLE RETURN try_divide(a - b, nullif(b, 0)) * 100",
        "season_of": f"(m INT) RETURNS STRING RETURN {_season_case()}",
        "type_code": f"(t STRING) RETURNS INT RETURN {_type_case()}",
        "size_band": f"(a DOUBLE) RETURNS STRING RETURN {_size_case()}",
        "quality_band": f"(s INT) RETURNS STRING RETURN {_quality_case()}",
        "department_of": ("(c STRING) RETURNS STRING RETURN "
                          "CASE WHEN startswith(c, '97') THEN substring(c, 1, 3) ELSE substring(c, 1, 2) END"),
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    names = []
    for name, body in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
        names.append(name)
    return names
