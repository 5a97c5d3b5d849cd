"""Derived-column functions (all JVM-side Column expressions).

Each function returns a ``Column``; none runs Python per row.  Thresholds are
arguments with the reference's defaults.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default thresholds of the cleaning rules.
MIN_PRICE, MAX_PRICE = 10000, 10000000
MIN_SURFACE, MAX_SURFACE = 9, 1000
MIN_PRICE_M2, MAX_PRICE_M2 = 500, 20000
MIN_ROOMS, MAX_ROOMS = 1, 20
MIN_YEAR, MAX_YEAR = 1800, 2025

# Labels written by the feature steps.
SEASONS = [("Hiver", [12, 1, 2]), ("Printemps", [3, 4, 5]), ("Été", [6, 7, 8]), ("Automne", [9, 10, 11])]
SEASON_ORDER = ["Hiver", "Printemps", "Été", "Automne"]
PRICE_BANDS = ["Bas", "Moyen", "Élevé", "Premium", "Luxe"]
PRICE_BAND_PROBS = [0.25, 0.5, 0.75, 0.9]
SIZE_BANDS = [(25, "Studio"), (45, "Petit"), (75, "Moyen"), (120, "Grand")]
SIZE_BAND_TOP = "Très grand"
TYPE_CODES = [("Appartement", 1), ("Maison", 2), ("Local commercial", 3), ("Dépendance", 4)]
TYPE_CANONICAL = {
    "Appartement": "Appartement",
    "Maison": "Maison",
    "Local industriel. commercial ou assimilé": "Local commercial",
    "Dépendance": "Dépendance",
}
QUALITY_BASE = 50
QUALITY_WEIGHTS = [
    ("type_local", 5), ("surface_reelle_bati", 10), ("nb_pieces", 5), ("code_postal", 3),
    ("commune_id", 5), ("latitude", 7), ("prix_m2", 10), ("adresse_nom_voie", 3),
    ("distance_centre_ville", 2),
]
QUALITY_BANDS = [(90, "Excellent (90-100)"), (75, "Bon (75-89)"), (60, "Moyen (60-74)")]
QUALITY_BAND_LOW = "Faible (<60)"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_per_area(price: str | Column, area: str | Column) -> Column:
    """Price / NULLIF(area, 0)."""
    return F.try_divide(_c(price), F.nullif(_c(area), F.lit(0)))


def clean_price_per_m2(price: str | Column, area: str | Column,
                       lo: float = MIN_PRICE_M2, hi: float = MAX_PRICE_M2) -> Column:
    """Ratio, NULL when area <= 0 / NULL or the ratio is outside [lo, hi]."""
    ratio = _c(price) / _c(area)
    return F.when((_c(area) > 0) & ratio.between(lo, hi), ratio)


def listing_price_m2(price: str | Column, area: str | Column) -> Column:
    """Unbounded listing ratio when area > 0."""
    return F.when(_c(area) > 0, _c(price) / _c(area))


def weekday_sunday0(d: str | Column) -> Column:
    """Day of week, 0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(_c(d)) - 1


def derive_sales(df: DataFrame, date_col: str = "date_mutation", price_col: str = "valeur_fonciere",
                 area_col: str = "surface_reelle_bati") -> DataFrame:
    """The columns the row triggers maintain (ratio, year, month, quarter, weekday)."""
    d = F.col(date_col)
    return df.withColumns({
        "prix_m2": clean_price_per_m2(price_col, area_col),
        "annee": F.year(d),
        "mois": F.month(d),
        "trimestre": F.quarter(d),
        "jour_semaine": weekday_sunday0(d),
    })


def season(month: str | Column) -> Column:
    """P16."""
    expr = None
    for label, months in SEASONS:
        cond = _c(month).isin(*months)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def is_weekend(weekday0: str | Column) -> Column:
    """Weekday 0 (Sunday) or 6 (Saturday); NULL stays NULL."""
    return _c(weekday0).isin(0, 6)


def temporal_features(df: DataFrame, date_col: str = "date_mutation") -> DataFrame:
    """Compute year/month/quarter/weekday, season, weekend, day of year,
    filling only where the column is still NULL (P19) when it already exists."""
    d = F.col(date_col)
    computed = {
        "annee": F.year(d), "mois": F.month(d), "trimestre": F.quarter(d),
        "jour_semaine": weekday_sunday0(d),
    }
    out = df.withColumns({k: (F.coalesce(F.col(k), v) if k in df.columns else v) for k, v in computed.items()})
    more = {"saison": season("mois"), "is_weekend": is_weekend("jour_semaine"), "jour_annee": F.dayofyear(d)}
    return out.withColumns({k: (F.coalesce(F.col(k), v) if k in out.columns else v) for k, v in more.items()})


def price_per_room(price: str | Column, rooms: str | Column) -> Column:
    """P20."""
    return F.when(_c(rooms) > 0, _c(price) / _c(rooms))


def area_per_room(area: str | Column, rooms: str | Column) -> Column:
    """P21."""
    return F.when((_c(rooms) > 0) & (_c(area) > 0), _c(area) / _c(rooms))


def large_area(area: str | Column, threshold: float = 100) -> Column:
    """NULL area stays NULL."""
    return _c(area) > threshold


def near_centre(distance_km: str | Column, threshold: float = 2) -> Column:
    """P23."""
    return _c(distance_km) < threshold


def type_code(type_col: str | Column) -> Column:
    """Fixed integer codes, 0 for anything else (NULL included)."""
    expr = None
    for label, code in TYPE_CODES:
        cond = _c(type_col) == label
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr.otherwise(F.lit(0))


def size_band(area: str | Column) -> Column:
    """P25: NULL area stays NULL."""
    a = _c(area)
    expr = None
    for upper, label in SIZE_BANDS:
        expr = F.when(a <= upper, F.lit(label)) if expr is None else expr.when(a <= upper, F.lit(label))
    return F.when(a.isNotNull(), expr.otherwise(F.lit(SIZE_BAND_TOP)))


def canonical_type(type_col: str | Column, mapping: dict | None = None) -> Column:
    """Map known labels, keep others unchanged."""
    mapping = TYPE_CANONICAL if mapping is None else mapping
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(m, _c(type_col)), _c(type_col))


def quality_score(weights: Sequence[tuple[str, int]] = QUALITY_WEIGHTS, base: int = QUALITY_BASE) -> Column:
    """Base + weight per non-null column."""
    total = F.lit(base)
    for c, w in weights:
        total = total + F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(F.lit(0))
    return total


def quality_band(score: str | Column) -> Column:
    """P29."""
    s = _c(score)
    expr = None
    for lo, label in QUALITY_BANDS:
        expr = F.when(s >= lo, F.lit(label)) if expr is None else expr.when(s >= lo, F.lit(label))
    return expr.otherwise(F.lit(QUALITY_BAND_LOW))


def density(population: str | Column, area_km2: str | Column) -> Column:
    """P30."""
    return F.try_divide(_c(population), F.nullif(_c(area_km2), F.lit(0)))


def hectares_to_km2(surface: str | Column) -> Column:
    """/100, zero or missing -> NULL."""
    return F.when(_c(surface) != 0, _c(surface) / 100)


def month_key(d: str | Column) -> Column:
    """P32: 'yyyy-MM'."""
    return F.date_format(_c(d), "yyyy-MM")


def month_start(d: str | Column) -> Column:
    """date_trunc('month') as a date."""
    return F.trunc(_c(d), "month")


def booleans_to_int(df: DataFrame) -> DataFrame:
    """Every boolean column as 0/1."""
    return df.withColumns({f.name: F.col(f.name).cast("int")
                           for f in df.schema.fields if f.dataType.typeName() == "boolean"})


def recent_days_start(as_of: str | Column, months: int) -> Column:
    """as_of - months * 30 days."""
    return F.date_sub(_lit_date(as_of), months * 30)


def trailing_months_start(as_of: str | Column, months: int = 12) -> Column:
    """Calendar months back, month-end clamped."""
    return F.add_months(_lit_date(as_of), -months)


def _lit_date(d: str | Column) -> Column:
    return F.to_date(F.lit(d)) if isinstance(d, str) else d


def department_of(code_commune: str | Column) -> Column:
    """3 characters for overseas codes starting with 97, else 2."""
    c = _c(code_commune)
    return F.when(c.startswith("97"), F.substring(c, 1, 3)).otherwise(F.substring(c, 1, 2))


def strip_leading_zeros(c: str | Column) -> Column:
    """LTRIM(c, '0')."""
    return F.ltrim(_c(c), F.lit("0"))


def percent_diff(a: str | Column, b: str | Column) -> Column:
    """(a - b) / NULLIF(b, 0) * 100."""
    return F.try_divide(_c(a) - _c(b), F.nullif(_c(b), F.lit(0))) * 100


def point(lat: str | Column, lon: str | Column) -> Column:
    """struct(lon, lat) when both are present."""
    return F.when(_c(lat).isNotNull() & _c(lon).isNotNull(),
                  F.struct(_c(lon).alias("lon"), _c(lat).alias("lat")))
