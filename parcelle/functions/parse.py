"""Lenient parsing of raw sale-file text (P1-P11), all JVM-side.

Under ANSI mode bad casts raise, so every conversion uses a ``try_`` form and
turns bad input into NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.operators.ranks import running_totals

# Raw sale-file headers and their column names.
RENAME_MAP = {
    "Date mutation": "date_mutation",
    "Nature mutation": "nature_mutation",
    "Valeur fonciere": "valeur_fonciere",
    "No voie": "adresse_numero",
    "B/T/Q": "adresse_suffixe",
    "Type de voie": "type_voie",
    "Code voie": "code_voie",
    "Voie": "adresse_nom_voie",
    "Code postal": "code_postal",
    "Commune": "commune_nom",
    "Code departement": "code_departement",
    "Code commune": "code_commune",
    "Section": "section",
    "No plan": "no_plan",
    "Nombre de lots": "nombre_lots",
    "Code type local": "code_type_local",
    "Type local": "type_local",
    "Surface reelle bati": "surface_reelle_bati",
    "Nombre pieces principales": "nb_pieces",
    "Surface terrain": "surface_terrain",
    "Longitude": "longitude",
    "Latitude": "latitude",
}

# String widths applied when sales are loaded (P10).
STRING_WIDTHS = {
    "dvf_id": 50, "nature_mutation": 50, "type_local": 50, "code_commune": 5, "adresse_numero": 10,
    "adresse_suffixe": 10, "adresse_nom_voie": 500, "code_postal": 5,
}


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standardize_columns(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename by map; names that are absent are ignored."""
    mapping = RENAME_MAP if mapping is None else mapping
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def resolve_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate name present in the frame (plan-time, no job)."""
    for c in candidates:
        if c in df.columns:
            return c
    return None


def parse_date(c: str | Column, formats: Sequence[str] = ("dd/MM/yyyy", "yyyy-MM-dd")) -> Column:
    """Each format explicitly, first that parses wins; invalid -> NULL.

    For the default pair the separator position picks the one format that
    can match, so a row is parsed once instead of failing one format first
    (a failed parse costs an exception inside the JVM)."""
    s = F.trim(_c(c))
    if tuple(formats) == ("dd/MM/yyyy", "yyyy-MM-dd"):
        return (F.when(s.substr(3, 1) == "/", F.try_to_date(s, "dd/MM/yyyy"))
                 .when(s.substr(5, 1) == "-", F.try_to_date(s, "yyyy-MM-dd")))
    return F.coalesce(*[F.try_to_date(s, f) for f in formats])


def parse_number(c: str | Column) -> Column:
    """Decimal comma -> dot, spaces dropped, lenient cast; NaN -> NULL.
    Plain string replacement (no regular expression)."""
    s = F.replace(F.replace(_c(c), F.lit(","), F.lit(".")), F.lit(" "), F.lit(""))
    v = s.try_cast("double")
    return F.when(~F.isnan(v), v)


def to_double(c: str | Column) -> Column:
    """P5: lenient cast, no comma fix (areas)."""
    v = _c(c).try_cast("double")
    return F.when(~F.isnan(v), v)


def strip_code(c: str | Column) -> Column:
    """Trim and drop a trailing '.0' (string functions, no regular expression)."""
    t = F.trim(_c(c))
    return F.when(t.endswith(".0"), t.substr(F.lit(1), F.length(t) - 2)).otherwise(t)


def pad_left(c: Column, n: int) -> Column:
    """Left pad without truncating longer values (``lpad`` alone truncates)."""
    return F.when(F.length(c) >= n, c).otherwise(F.lpad(c, n, "0"))


def commune_code(dept: str | Column, num: str | Column) -> Column:
    """P7 (+ T8): department padded to 2; commune number padded to 3.
    Overseas 3-digit departments (97x) take the last 2 digits of the number."""
    d = pad_left(strip_code(dept), 2)
    n = pad_left(strip_code(num), 3)
    return F.when(F.length(d) == 3, F.concat(d, F.substring(n, -2, 2))).otherwise(F.concat(d, n))


def postal_code(c: str | Column) -> Column:
    """Strip '.0', pad to 5; NULL/blank stays NULL."""
    s = strip_code(c)
    return F.when(s.isNotNull() & (s != ""), pad_left(s, 5))


def to_int(c: str | Column) -> Column:
    """Lenient number, then integer by truncation toward zero ('3', '3.0'
    and '3.7' give 3); bad text, NaN and out-of-range values give NULL."""
    v = _c(c).try_cast("double")
    return F.when(~F.isnan(v), v).try_cast("int")


def truncate_widths(df: DataFrame, widths: dict[str, int] | None = None) -> DataFrame:
    """P10: cut strings to their column width."""
    widths = STRING_WIDTHS if widths is None else widths
    return df.withColumns({c: F.substring(c, 1, n) for c, n in widths.items() if c in df.columns})


EXPAND_PIECE = 100_000

#: Business columns that make up a sale's content.
SALE_CONTENT = (
    "date_mutation", "nature_mutation", "valeur_fonciere", "adresse_numero", "adresse_suffixe", "type_voie", "code_voie",
    "adresse_nom_voie", "code_postal", "commune_nom", "code_departement", "code_commune", "section", "no_plan",
    "nombre_lots", "code_type_local", "type_local", "surface_reelle_bati", "nb_pieces", "surface_terrain",
)


def content_hash(df: DataFrame, content: Sequence[str]) -> Column:
    """16 hex digits over the columns of ``content`` that ``df`` has, in that order.

    A value is written as name=length:text, so no two contents share a text; NULL
    values are left out, as if the column were missing.  Fractional numbers count
    to four decimals, which makes the text the same in every engine."""
    parts = []
    for c in content:
        if c not in df.columns:
            continue
        v = F.col(c)
        if df.schema[c].dataType.typeName() in ("float", "double", "decimal"):
            v = v.try_cast("decimal(38,4)")
        v = v.cast("string")
        parts.append(F.concat(F.lit(c + "="), F.length(v).cast("string"), F.lit(":"), v))
    return F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 16)


def with_content_id(df: DataFrame, date: str, code: str, price: str, content: Sequence[str] | None = None,
                    out_col: str = "dvf_id") -> DataFrame:
    """P9 (+ T2): ``yyyyMMdd_commune_integer-price_content-hash_occurrence``.

    The hash covers the columns of ``content`` (all, if not given); the
    occurrence numbers rows that are identical in every column from 0.  An id
    depends on the row alone and on how often it occurs, never on other sales of
    the load, so a re-delivered file in any order gives the same ids and a new
    sale never takes a known id.  Where rows share a content but differ in
    columns outside ``content``, the occurrence goes through these columns in
    their order (``running_totals``: one write, a content of any size in many tasks).

    Identical rows become (row, count) in an aggregate combined map-side, so a row
    that makes up a third of the load never meets in one task; counts are cut
    into pieces of ``EXPAND_PIECE``, and the pieces of rows with more than one
    are dealt out before they are expanded."""
    cols = list(df.columns)
    content = cols if content is None else [c for c in content if c in cols]
    base = F.concat_ws("_", F.date_format(F.col(date), "yyyyMMdd"), F.col(code),
                       F.col(price).cast("long").cast("string"), content_hash(df, content))
    d = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c")).withColumn("_key", base)
    rest = [c for c in cols if c not in content]
    if rest:
        d = running_totals(d, "_key", rest, "_c", "_from")
    else:
        d = d.withColumn("_from", F.lit(0).cast("long"))
    few = d.where(F.col("_c") <= EXPAND_PIECE).withColumns({"_ps": F.col("_from"), "_pl": F.col("_c")})
    many = (d.where(F.col("_c") > EXPAND_PIECE)
             .withColumn("_p", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("_c") / EXPAND_PIECE) - 1)))
             .withColumns({"_ps": F.col("_from") + F.col("_p") * EXPAND_PIECE,
                           "_pl": F.least(F.lit(EXPAND_PIECE).cast("long"), F.col("_c") - F.col("_p") * EXPAND_PIECE)})
             .drop("_p").repartition("_key", "_ps"))
    pieces = few.unionByName(many)
    out = pieces.select(*cols, "_key", F.explode(F.sequence(F.col("_ps"), F.col("_ps") + F.col("_pl") - 1)).alias("_occ"))
    return out.withColumn(out_col, F.concat_ws("_", F.col("_key"), F.col("_occ").cast("string"))).drop("_key", "_occ")


def clean_raw_sales(raw: DataFrame) -> DataFrame:
    """E6 cleaning of a raw (all-string) sale frame: types, codes, NULL rules
    (F1/F2: rows without a date or a positive price are dropped).  Land area and
    number of lots become numbers where the file has them."""
    df = standardize_columns(raw)
    more = {"surface_terrain": to_double("surface_terrain"), "nombre_lots": to_int("nombre_lots")}
    df = df.withColumns({c: v for c, v in more.items() if c in df.columns})
    out = df.withColumns({
        "date_mutation": parse_date("date_mutation"),
        "valeur_fonciere": parse_number("valeur_fonciere"),
        "surface_reelle_bati": to_double("surface_reelle_bati"),
        "nb_pieces": to_int("nb_pieces"),
        "code_postal": postal_code("code_postal"),
        "code_commune": commune_code("code_departement", "code_commune"),
    })
    return out.where(F.col("date_mutation").isNotNull() & F.col("valeur_fonciere").isNotNull()
                     & (F.col("valeur_fonciere") > 0))
