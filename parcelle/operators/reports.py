"""Reports: distributions, group statistics, rankings, descriptive statistics
(A4-A27, F12, F13, K1-K5, W2, D1-D7).

One-row figures that a row-level expression needs (totals, global
percentiles, min/max) are attached as scalar subqueries (``DataFrame.scalar``):
computed once, inlined as a value, no cross join and no second scan of the
rows by the driver.  Percentiles go through ``operators.quantiles``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelle.functions import derive as D
from parcelle.operators.quantiles import group_quantiles, join_groups, quantiles, with_one_row


def count_by(df: DataFrame, col: str, out: str = "nb") -> DataFrame:
    """Rows per non-null value, most frequent first (ties by value)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(out))
              .orderBy(F.desc(out), F.col(col)))


def share_by(df: DataFrame, col: str) -> DataFrame:
    """Count and percent of all rows per category (NULL a category)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("nb")).withColumn("pct", F.col("nb") * 100.0 / total)


def global_summary(sales: DataFrame) -> DataFrame:
    """The one-row run summary."""
    return sales.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("type_local") == "Appartement").alias("apparts"),
        F.count_if(F.col("type_local") == "Maison").alias("maisons"),
        F.count("commune_id").alias("with_commune"),
        F.count("latitude").alias("with_coords"),
        F.count("prix_m2").alias("with_prix_m2"),
        F.avg(F.col("valeur_fonciere").cast("decimal(18,2)")).alias("prix_moyen"),
        F.avg("prix_m2").alias("prix_m2_moyen"),
        F.avg("surface_reelle_bati").alias("surface_moy"),
        F.min("date_mutation").alias("date_min"),
        F.max("date_mutation").alias("date_max"),
    )


def coverage(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-null count and percent per column from ONE aggregate,
    unpivoted to one row per column."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count(c).alias(c) for c in cols]
    one = df.agg(*aggs)
    long = one.unpivot("_n", list(cols), "feature", "non_null")
    return long.select("feature", "non_null", (F.col("non_null") * 100.0 / F.col("_n")).alias("pct"))


def completeness_gate(df: DataFrame, cols: Sequence[str], min_share: float = 0.3) -> DataFrame:
    """Candidate columns whose non-null share exceeds ``min_share``."""
    c = coverage(df, cols)
    return c.where(F.col("pct") > min_share * 100).select("feature", "pct")


def group_stats(df: DataFrame, keys: Sequence[str], measures: Sequence[str], medians: bool = True,
                count_name: str = "nb") -> DataFrame:
    """Count, mean and exact median per measure and group,
    flat ``<measure>_mean`` / ``<measure>_median`` names."""
    aggs = [F.count(F.lit(1)).alias(count_name), *[F.avg(m).alias(f"{m}_mean") for m in measures]]
    g = df.groupBy(*keys) if keys else df
    if not medians:
        return g.agg(*aggs)
    return join_groups(g.agg(*aggs), quantiles(df, keys, {m: {f"{m}_median": 0.5} for m in measures}), keys)


def ordered_groups(df: DataFrame, col: str, order: Sequence[str], measure: str) -> DataFrame:
    """Median per category in a fixed order; categories with no rows are
    listed with NULL (left join from the order list, sorted by its position)."""
    spark = df.sparkSession
    labels = spark.createDataFrame([(i, v) for i, v in enumerate(order)], f"_pos int, {col} string")
    med = group_quantiles(df.where(F.col(col).isNotNull()), [col], measure, {f"{measure}_median": 0.5})
    return join_groups(labels, med, [col]).orderBy("_pos").drop("_pos")


def top_by_median(df: DataFrame, key: Sequence[str], measure: str, min_count: int = 10, n: int = 20,
                  extra: dict[str, str] | None = None) -> DataFrame:
    """Groups with at least ``min_count`` rows (all rows counted),
    highest median of ``measure`` first (groups without a value last);
    ``extra`` adds medians of other columns (name -> column)."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("nb"))
    wanted: dict[str, dict[str, float]] = {measure: {"median": 0.5}}
    for name, col in (extra or {}).items():
        wanted.setdefault(col, {})[name] = 0.5
    j = join_groups(counts.where(F.col("nb") >= min_count), quantiles(df, key, wanted), key, "left")
    return j.orderBy(F.desc_nulls_last("median"), *key).limit(n)


def limit_per_group(df: DataFrame, group_col: str | Sequence[str], n: int, order_cols: Sequence[str | Column]) -> DataFrame:
    """At most ``n`` rows per group in a stated order (``n`` is the
    feature's cap).  The ``row_number() <= n`` filter lets Spark insert a
    partial per-group limit before the shuffle, so a skewed group sends at
    most ``n`` rows per input partition to the final ranking."""
    w = Window.partitionBy(group_col).orderBy(*order_cols)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles, max per column
    (one row per column)."""
    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75}

    def stats(c: str) -> list[Column]:
        return [F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
                F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max")]

    names = ["count", "mean", "std", "min", "max", *probs]
    one = with_one_row(df.agg(*[x for c in cols for x in stats(c)]),
                       quantiles(df, [], {c: {f"{c}__{n}": p for n, p in probs.items()} for c in cols}))
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{n}").alias(n) for n in names])
                               for c in cols]))
    return one.select(rows.alias("_r")).select("_r.*")


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Fixed-width bins between min and max; the max falls in the last bin."""
    v = F.col(col)
    rng = df.agg(F.struct(F.min(v).cast("double").alias("lo"), F.max(v).cast("double").alias("hi"))).scalar()
    lo, hi = rng["lo"], rng["hi"]
    width = (hi - lo) / bins
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((v - lo) / width), F.lit(bins - 1))).cast("int")
    g = df.where(v.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("nb"))
    return g.withColumns({"bin_start": lo + F.col("bin") * width, "bin_end": lo + (F.col("bin") + 1) * width})


def boxplot(df: DataFrame, key: str, col: str) -> DataFrame:
    """D3: quartiles, 1.5 IQR fences, whiskers (extreme values inside the
    fences) and the number of values outside them, per group."""
    q = group_quantiles(df, [key], col, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    q = q.withColumns({"low_fence": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
                       "high_fence": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))})
    from parcelle.plans.sizing import broadcast_if_small
    j = df.where(F.col(col).isNotNull()).select(key, col).join(broadcast_if_small(q), key, "inner")
    v = F.col(col)
    inside = (v >= F.col("low_fence")) & (v <= F.col("high_fence"))
    agg = j.groupBy(key).agg(
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))
    return join_groups(q, agg, [key])


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation of every ordered pair as
    (x, y, corr): each unordered pair is aggregated once (one pass for all)
    and mirrored; NaN is turned into NULL first."""
    clean = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c)
                        for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = clean.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs]) if pairs else clean.limit(1)
    cells = [F.struct(F.lit(a).alias("x"), F.lit(a).alias("y"), F.lit(1.0).alias("corr")) for a in cols]
    for a, b in pairs:
        cells.append(F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"{a}__{b}").alias("corr")))
        cells.append(F.struct(F.lit(b).alias("x"), F.lit(a).alias("y"), F.col(f"{a}__{b}").alias("corr")))
    return one.select(F.explode(F.array(*cells)).alias("s")).select("s.*")


def sample_rows(df: DataFrame, id_col: str, n: int = 5000, seed: int = 42) -> DataFrame:
    """A repeatable sample of up to ``n`` rows: those with the smallest MD5 of
    seed and id, the same in any SQL engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")).cast("binary"))
    return df.orderBy(digest, F.col(id_col)).limit(n)


def band_stats(df: DataFrame, band_col: str, order_col: str, measures: dict[str, Column]) -> DataFrame:
    """Per band, count and means, ordered by ``order_col``'s mean."""
    g = df.where(F.col(band_col).isNotNull()).groupBy(band_col).agg(
        F.count(F.lit(1)).alias("nb"), F.avg(order_col).alias("_order"),
        *[m.alias(k) for k, m in measures.items()])
    return g.orderBy("_order").drop("_order")


def price_bands(df: DataFrame, price_col: str = "valeur_fonciere") -> DataFrame:
    """Band by the global exact 25/50/75/90 percentiles of the price."""
    qs = group_quantiles(df, [], price_col, {f"_p{int(p * 100)}": p for p in D.PRICE_BAND_PROBS})
    packed = qs.select(F.struct(*qs.columns)).scalar()
    cuts = [packed[f"_p{int(p * 100)}"] for p in D.PRICE_BAND_PROBS]
    v = F.col(price_col)
    expr = F.when(v <= cuts[0], F.lit(D.PRICE_BANDS[0]))
    for cut, label in zip(cuts[1:], D.PRICE_BANDS[1:-1]):
        expr = expr.when(v <= cut, F.lit(label))
    return df.withColumn("categorie_prix", expr.otherwise(F.lit(D.PRICE_BANDS[-1])))
