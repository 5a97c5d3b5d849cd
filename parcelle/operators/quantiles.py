"""Exact quantiles, bounded at any group size, as one lazy plan.

Definition (as SQL ``PERCENTILE_CONT``): for ``n`` values of a group and a fraction
``p``, ``pos = p * (n - 1)``; the result is the value of rank ``floor(pos)``
interpolated towards the value of rank ``ceil(pos)``.

The values are reduced to (group, value, count) before and by one shuffle, which a
hot group leaves spread over all tasks.  Ranks are then found by two prefix sums:
over ordered cells of ``log2 |value|`` (``CELLS`` to a power of two, so a group has
some 100,000 of them however many rows it has), and over the different values inside
those cells alone that hold a wanted rank (a cell is 0.002 % wide; money in cents has
few values there, and values without end are sorted with spill).  One path serves
every size, nothing runs while the plan is built and nothing reaches the driver.
Several measures go through the same steps together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells to a power of two.
CELLS = 1 << 15


def finite_or_null(col: str | Column) -> Column:
    """The value as a double, NaN turned into NULL (ignored like NULL)."""
    v = (F.col(col) if isinstance(col, str) else col).cast("double")
    return F.when(~F.isnan(v), v)


def quantiles(df: DataFrame, keys: Sequence[str], wanted: dict[str, dict[str, float]],
              weight: str | None = None) -> DataFrame:
    """Exact quantiles per group of ``keys`` (NULL is a group; one row for the whole
    frame where ``keys`` is empty): ``wanted`` maps a column to {output name:
    fraction}.  NULL and NaN values are ignored; a group without any is absent, a
    group without values of one column has NULL there.  ``weight`` names a column that says
    how often a row counts (a positive integer), for frames that are counted already."""
    keys = list(keys)
    names = [f"_k{i}" for i in range(len(keys))]
    group = [*names, "_m"]
    listed = ", ".join(group)
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("_m"), finite_or_null(c).alias("_v")) for i, c in enumerate(wanted)]))
    times = F.lit(1) if weight is None else F.col(weight)
    data = df.select(*[F.col(k).alias(x) for k, x in zip(keys, names)], each.alias("_e"), times.cast("long").alias("_w"))
    # 0.0 is also -0.0; the cell number never falls as the value grows
    cell = (f"CAST(signum(_e._v) * (floor(greatest(-1100D, least(1100D, log2(abs(_e._v)))) * {CELLS}) + {1101 * CELLS}L) AS BIGINT)")
    values = data.where("_e._v IS NOT NULL").groupBy(
        *names, F.expr("_e._m").alias("_m"), F.expr(f"CASE WHEN _e._v = 0 THEN 0L ELSE {cell} END").alias("_p"),
        F.expr("CASE WHEN _e._v = 0 THEN 0D ELSE _e._v END").alias("_v")).agg(F.sum("_w").alias("_c"))
    probs = sorted({p for by_name in wanted.values() for p in by_name.values()})
    # does a stretch of _c ranks from _b on hold a wanted one?
    hit = " OR ".join(f"(floor({p}D * (_n - 1)) BETWEEN _b AND _b + _c - 1) OR (ceil({p}D * (_n - 1)) BETWEEN _b AND _b + _c - 1)" for p in probs)
    cells = values.groupBy(*group, "_p").agg(F.sum("_c").alias("_c")).selectExpr(
        *group, "_p", "_c", f"sum(_c) OVER (PARTITION BY {listed} ORDER BY _p) - _c AS _b", f"sum(_c) OVER (PARTITION BY {listed}) AS _n").where(hit)
    cells = cells.selectExpr(*[f"{x} AS {x}_" for x in (*group, "_p")], "_n", "_b AS _from")
    inside = values.join(cells, F.expr(" AND ".join(f"{x} <=> {x}_" for x in (*group, "_p"))))
    last = inside.selectExpr(*group, "_v", "_c", "_n", f"_from + sum(_c) OVER (PARTITION BY {listed}, _p ORDER BY _v) - _c AS _b").where(hit)
    found, out = [], []
    for i, (c, by_name) in enumerate(wanted.items()):
        for j, (name, p) in enumerate(by_name.items()):
            pos, x = f"({p}D * (_n - 1))", f"{i}_{j}"
            found += [F.expr(f"max(CASE WHEN _m = {i} AND {f}{pos} BETWEEN _b AND _b + _c - 1 THEN _v END) AS _{f}{x}") for f in ("floor", "ceil")]
            found.append(F.expr(f"max(CASE WHEN _m = {i} THEN {pos} END) AS _pos{x}"))
            lo, hi, at = f"_floor{x}", f"_ceil{x}", f"_pos{x}"
            out.append(F.expr(f"CASE WHEN {lo} = {hi} OR floor({at}) = {at} THEN {lo} ELSE (ceil({at}) - {at}) * {lo} + ({at} - floor({at})) * {hi} END").alias(name))
    grouped = (last.groupBy(*names) if names else last).agg(*found)
    return grouped.select(*[F.col(x).alias(k) for k, x in zip(keys, names)], *out)


def group_quantiles(df: DataFrame, keys: Sequence[str], value_col: str, probs: dict[str, float]) -> DataFrame:
    """``quantiles`` of one column."""
    return quantiles(df, keys, {value_col: probs})


def column_quantiles(df: DataFrame, cols: Sequence[str], p: float = 0.5) -> DataFrame:
    """One-row frame with the exact ``p`` quantile of each column."""
    return quantiles(df, [], {c: {c: p} for c in cols})


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row DataFrame to every row of ``df`` as a
    single scalar subquery (run once, inlined; no join)."""
    packed = one_row.select(F.struct(*one_row.columns).alias("_s")).scalar()
    return df.withColumns({c: packed[c] for c in one_row.columns})


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join two per-group results on their group keys, NULL keys matching
    (a NULL category is a group of its own)."""
    keys = list(keys)
    if not keys:
        return with_one_row(left, right)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])
