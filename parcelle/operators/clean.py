"""Cleaning: duplicate removal, outlier filters, audit counts, quality score,
constraint checks (W1, F1-F11, P27-P29, A13, S15).

All steps are pure DataFrame -> DataFrame functions, so a chain of them is one
plan written once; audit counts come from one aggregate over flag columns
instead of one count job per step.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.functions import derive as D

DUP_KEY = ["date_mutation", "valeur_fonciere", "code_commune", "surface_reelle_bati", "type_local"]


DUP_KEY_NAMES = ["_k_date", "_k_price", "_k_code", "_k_area", "_k_type"]


def _dup_key_values(date_col="date_mutation", price_col="valeur_fonciere", code_col="code_commune",
                    area_col="surface_reelle_bati", type_col="type_local") -> list[Column]:
    return [F.col(date_col), F.col(price_col), F.col(code_col),
            F.coalesce(F.col(area_col), F.lit(0)).cast("double"), F.coalesce(F.col(type_col), F.lit(""))]


def _dup_key_cols(**names) -> list[Column]:
    return [c.alias(k) for c, k in zip(_dup_key_values(**names), DUP_KEY_NAMES)]


def _keyed(date_col="date_mutation", price_col="valeur_fonciere", code_col="code_commune", **_) -> Column:
    """Rows that can be duplicates: SQL equality never matches a NULL date, price or commune."""
    return F.col(date_col).isNotNull() & F.col(price_col).isNotNull() & F.col(code_col).isNotNull()


def remove_duplicates(df: DataFrame, id_col: str = "id", **names) -> DataFrame:
    """Keep the lowest id per (date, price, commune, area or 0, type or '').

    The least id and the row count of each key come from a hash aggregate over the key
    and the id alone, combined map-side; only keys met more than once go on, and rows of
    such a key with a larger id are left out by an anti-join.  With few repeated keys
    that join is broadcast at run time and whole rows are neither sorted nor shuffled;
    with many, AQE splits a hot key.  Rows that share the least id all stay, as in the
    self-join (ids are unique)."""
    g = df.where(_keyed(**names)).groupBy(*_dup_key_cols(**names))
    again = g.agg(F.min(id_col).alias("_least"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).drop("_n")
    same = [c == F.col(k) for c, k in zip(_dup_key_values(**names), DUP_KEY_NAMES)]
    return df.join(again, reduce(and_, [*same, F.col(id_col) > F.col("_least")]), "left_anti")


def filter_price(df: DataFrame, col: str = "valeur_fonciere", lo: float = D.MIN_PRICE,
                 hi: float = D.MAX_PRICE) -> DataFrame:
    """drop rows priced below ``lo`` or above ``hi`` (NULL kept)."""
    c = F.col(col)
    return df.where(~F.coalesce((c < lo) | (c > hi), F.lit(False)))


def filter_area(df: DataFrame, col: str = "surface_reelle_bati", lo: float = D.MIN_SURFACE,
                hi: float = D.MAX_SURFACE) -> DataFrame:
    """NULL areas kept."""
    c = F.col(col)
    return df.where(c.isNull() | c.between(lo, hi))


def filter_ratio(df: DataFrame, price_col: str = "valeur_fonciere", area_col: str = "surface_reelle_bati",
                 lo: float = D.MIN_PRICE_M2, hi: float = D.MAX_PRICE_M2, mode: str = "drop",
                 ratio_col: str = "prix_m2") -> DataFrame:
    """F8 (trap T4).

    ``mode="drop"``: recompute the raw ratio where area > 0 and drop rows whose
    ratio is outside [lo, hi] (the stated intent).  ``mode="null"``: the
    effective behaviour, the bounded ratio is NULL out of range and no row goes."""
    if mode == "null":
        return df.withColumn(ratio_col, D.clean_price_per_m2(price_col, area_col, lo, hi))
    raw = F.when(F.col(area_col) > 0, D.price_per_area(price_col, area_col))
    out = df.withColumn(ratio_col, F.coalesce(raw, F.col(ratio_col)) if ratio_col in df.columns else raw)
    r = F.col(ratio_col)
    return out.where(r.isNull() | r.between(lo, hi))


def clean(df: DataFrame, price=(D.MIN_PRICE, D.MAX_PRICE), area=(D.MIN_SURFACE, D.MAX_SURFACE),
          ratio=(D.MIN_PRICE_M2, D.MAX_PRICE_M2), ratio_mode: str = "drop") -> DataFrame:
    """E7 core: W1 -> F6 -> F7 -> F8 -> P27 -> P28."""
    out = remove_duplicates(df)
    out = filter_price(out, lo=price[0], hi=price[1])
    out = filter_area(out, lo=area[0], hi=area[1])
    out = filter_ratio(out, lo=ratio[0], hi=ratio[1], mode=ratio_mode)
    out = out.withColumn("type_local", D.canonical_type("type_local"))
    if "distance_centre_ville" not in out.columns:
        out = out.withColumn("distance_centre_ville", F.lit(None).cast("double"))
    return out.withColumn("data_quality_score", D.quality_score())


def audit_counts(df: DataFrame, price=(D.MIN_PRICE, D.MAX_PRICE), area=(D.MIN_SURFACE, D.MAX_SURFACE),
                 ratio=(D.MIN_PRICE_M2, D.MAX_PRICE_M2)) -> DataFrame:
    """rows removed by each cleaning step, in step order, from one aggregate."""
    # One row a duplicate key with its size and, since price and area are part of the
    # key, all that the later steps look at: the area is missing where the least id is
    # one of those without an area.  Rows without a full key are groups of their own.
    raw_area = F.col("surface_reelle_bati")
    f = (df.groupBy(*_dup_key_cols(), F.when(~_keyed(), F.col("id")).alias("_k_single"))
           .agg(F.min("id").alias("_least"), F.min(F.when(raw_area.isNull(), F.col("id"))).alias("_least_bare"),
                F.count(F.lit(1)).alias("_gsize")))
    p = F.col("_k_price")
    a = F.when(~F.coalesce(F.col("_least") == F.col("_least_bare"), F.lit(False)), F.col("_k_area"))
    raw_ratio = F.when(a > 0, D.price_per_area(p, a))
    low = F.coalesce(p < price[0], F.lit(False))
    high = F.coalesce(p > price[1], F.lit(False))
    small = a.isNotNull() & (a < area[0])
    big = a.isNotNull() & (a > area[1])
    bad_ratio = raw_ratio.isNotNull() & ((raw_ratio < ratio[0]) | (raw_ratio > ratio[1]))
    alive2 = ~low & ~high
    alive3 = alive2 & ~small & ~big
    return f.agg(
        F.sum("_gsize").alias("rows_before"),
        F.sum(F.col("_gsize") - 1).alias("removed_duplicates"),
        F.count_if(low).alias("removed_price_low"),
        F.count_if(high).alias("removed_price_high"),
        F.count_if(alive2 & small).alias("removed_area_small"),
        F.count_if(alive2 & big).alias("removed_area_big"),
        F.count_if(alive3 & bad_ratio).alias("removed_ratio"),
        F.count_if(alive3 & ~bad_ratio).alias("rows_after"),
    )


def quality_bands(df: DataFrame, score_col: str = "data_quality_score") -> DataFrame:
    """Rows per score band with percent of all rows (window over a
    one-row-per-band aggregate, so the total needs no second pass)."""
    g = df.groupBy(D.quality_band(score_col).alias("qualite")).agg(F.count(F.lit(1)).alias("nb"))
    from pyspark.sql import Window
    total = F.sum("nb").over(Window.partitionBy())
    return g.withColumn("pct", F.col("nb") * 100.0 / total)


# Row rules -> accepted / rejected with the reasons.
def sales_rules(price="valeur_fonciere", area="surface_reelle_bati", land="surface_terrain",
                rooms="nb_pieces", month="mois", quarter="trimestre", weekday="jour_semaine",
                score="data_quality_score", date="date_mutation", type_col="type_local",
                check_rooms: bool = False, build_year: str | None = None) -> list[tuple[str, Column]]:
    """Constraint rules of the sales table as (reason, violation predicate).

    A violation predicate that is NULL counts as satisfied, as for SQL CHECK."""
    def opt(c: str) -> Column:
        return F.col(c)

    rules = [
        ("date_missing", F.col(date).isNull()),
        ("price_missing", F.col(price).isNull()),
        ("price_not_positive", opt(price) <= 0),
        ("type_missing", F.col(type_col).isNull()),
        ("area_not_positive", opt(area) <= 0),
    ]
    named = {"land": land, "month": month, "quarter": quarter, "weekday": weekday, "score": score}
    checks = {
        "land": lambda c: c < 0,
        "month": lambda c: (c < 1) | (c > 12),
        "quarter": lambda c: (c < 1) | (c > 4),
        "weekday": lambda c: (c < 0) | (c > 6),
        "score": lambda c: (c < 0) | (c > 100),
    }
    for k, cname in named.items():
        if cname:
            rules.append((f"{k}_out_of_range", checks[k](F.col(cname))))
    if check_rooms:
        rules.append(("rooms_out_of_range", (opt(rooms) < D.MIN_ROOMS) | (opt(rooms) > D.MAX_ROOMS)))
    if build_year:
        rules.append(("build_year_out_of_range", (opt(build_year) < D.MIN_YEAR) | (opt(build_year) > D.MAX_YEAR)))
    return rules


def check_constraints(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Add ``reject_reasons`` (array of violated rule names, empty if none)."""
    reasons = F.array_compact(F.array(*[F.when(F.coalesce(pred, F.lit(False)), F.lit(name))
                                        for name, pred in rules]))
    return df.withColumn("reject_reasons", reasons)


def split_valid(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    flagged = check_constraints(df, rules)
    ok = F.size("reject_reasons") == 0
    return flagged.where(ok).drop("reject_reasons"), flagged.where(~ok)
