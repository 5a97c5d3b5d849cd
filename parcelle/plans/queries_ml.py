"""Queries for the price model: preparation, split, fits, metrics, scoring."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.functions import derive as D
from parcelle.functions import rnd
from parcelle.operators import link as L
from parcelle.operators import ml as M
from parcelle.operators.model_store import ModelStore, best_of
from parcelle.operators.quantiles import with_one_row
from parcelle.plans.catalog import register
from parcelle.plans.oracle import r
from parcelle.plans.queries_reports import PRIORITY_TYPES, _sql_type_map, SQL_CANON, features, with_feat
from parcelle.session import ensure_checkpoint_dir, write_once
from parcelle.sources import tables as T


def ml_table(spark: SparkSession, sf: str, columns: list[str] | None = None) -> DataFrame:
    """The feature file: sales features with property types, type codes,
    distance to the commune centre and the commune attributes.  With ``columns``
    (of the sale), only these, written once for the communes' means and all reads after."""
    f = features(spark, sf)
    f = f.withColumn("type_local", D.canonical_type(D.canonical_type("type_local", PRIORITY_TYPES)))
    f = f.withColumn("type_local_encoded", D.type_code("type_local"))
    c = T.communes(spark, sf)
    f = L.distance_to_commune(f, c)
    if columns is not None:
        f = write_once(f.select(*columns), "feature-rows")
    return L.commune_features(f, c)


#: What a sale itself brings to a fit; the commune attributes are joined to it.
SALE_COLUMNS = ["id", "commune_id", "type_local", "prix_m2", M.LABEL, *M.BASE_FEATURES, "distance_centre_ville", "grande_surface"]


def prepared(spark: SparkSession, sf: str):
    rows = M.training_rows(ml_table(spark, sf, SALE_COLUMNS))
    feats = M.select_features(rows)
    return M.model_frame(rows, feats), feats


SQL_ML = f"""
, ml AS (
  SELECT f.*, {SQL_CANON.format(c=_sql_type_map('f.type_local'))} AS type_p FROM feat f
), ca AS (
  SELECT commune_id, AVG(prix_m2) AS m FROM sales WHERE commune_id IS NOT NULL AND prix_m2 IS NOT NULL GROUP BY 1
), rows AS (
  SELECT ml.*, ca.m AS commune_prix_m2_moyen FROM ml LEFT JOIN ca ON ml.commune_id = ca.commune_id
  WHERE valeur_fonciere IS NOT NULL AND surface_reelle_bati IS NOT NULL AND type_p IN ('Appartement', 'Maison')
    AND valeur_fonciere > 0 AND surface_reelle_bati > 0
), pred AS (
  SELECT *, surface_reelle_bati * commune_prix_m2_moyen AS prediction FROM rows WHERE commune_prix_m2_moyen IS NOT NULL
)"""


def fixed_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A per-area baseline model (area x commune mean ratio) used to check the
    metric formulas against SQL."""
    rows = M.training_rows(ml_table(spark, sf))
    return rows.where(F.col("commune_prix_m2_moyen").isNotNull()).withColumn(
        "prediction", F.col("surface_reelle_bati") * F.col("commune_prix_m2_moyen"))


@register("metric_formulas", "M9", with_feat(f"""{SQL_ML}
SELECT type_p AS type_local, COUNT(*) AS n,
       {r('1 - SUM((valeur_fonciere - prediction) * (valeur_fonciere - prediction)) / (var_pop(valeur_fonciere) * COUNT(*))', 4)} AS r2,
       {r('AVG(abs(valeur_fonciere - prediction))')} AS mae,
       {r('sqrt(SUM((valeur_fonciere - prediction) * (valeur_fonciere - prediction)) / COUNT(*))')} AS rmse
FROM pred GROUP BY 1
""".replace("\n, ml AS", ",\nml AS")))
def q_metric_formulas(spark, sf):
    m = M.regression_metrics(fixed_predictions(spark, sf), by=["type_local"])
    return m.select("type_local", "n", rnd("r2", 4).alias("r2"), rnd("mae").alias("mae"), rnd("rmse").alias("rmse"))


@register("error_stats", "M10 A4", with_feat(f"""{SQL_ML}
SELECT {r('AVG((valeur_fonciere - prediction) / valeur_fonciere * 100)', 4)} AS mean_error_pct,
       {r('AVG(abs((valeur_fonciere - prediction) / valeur_fonciere * 100))', 4)} AS mean_abs_error_pct,
       {r('quantile_cont(abs((valeur_fonciere - prediction) / valeur_fonciere * 100), 0.5)', 4)} AS median_abs_error_pct,
       {r('quantile_cont(abs((valeur_fonciere - prediction) / valeur_fonciere * 100), 0.9)', 4)} AS p90_abs_error_pct
FROM pred
""".replace("\n, ml AS", ",\nml AS")))
def q_error_stats(spark, sf):
    out = M.error_stats(fixed_predictions(spark, sf))
    return out.select(*[rnd(c, 4).alias(c) for c in ["mean_error_pct", "mean_abs_error_pct", "median_abs_error_pct",
                                                    "p90_abs_error_pct"]])


@register("cv_folds", "M11", with_feat(f"""{SQL_ML}
, numbered AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS rk, COUNT(*) OVER () AS n FROM rows)
SELECT id, CAST(rk >= (n // 5) + least(n % 5, 1) AS INTEGER)
           + CAST(rk >= 2 * (n // 5) + least(n % 5, 2) AS INTEGER)
           + CAST(rk >= 3 * (n // 5) + least(n % 5, 3) AS INTEGER)
           + CAST(rk >= 4 * (n // 5) + least(n % 5, 4) AS INTEGER) AS fold
FROM numbered
""".replace("\n, ml AS", ",\nml AS")))
def q_cv_folds(spark, sf):
    rows = M.training_rows(ml_table(spark, sf))
    return M.contiguous_folds(rows, "id", 5).select("id", "fold")


@register("feature_medians", "M12 A5", with_feat(f"""{SQL_ML}
SELECT {r('quantile_cont(surface_reelle_bati, 0.5)', 4)} AS surface_reelle_bati,
       {r('quantile_cont(nb_pieces, 0.5)', 4)} AS nb_pieces,
       {r('quantile_cont(commune_prix_m2_moyen, 0.5)', 4)} AS commune_prix_m2_moyen
FROM rows
""".replace("\n, ml AS", ",\nml AS")))
def q_feature_medians(spark, sf):
    rows = M.training_rows(ml_table(spark, sf))
    cols = ["surface_reelle_bati", "nb_pieces", "commune_prix_m2_moyen"]
    med = M.scoring_medians(rows, cols)
    return med.select(*[rnd(c, 4).alias(c) for c in cols])


SPLIT = "CASE WHEN CAST('0x' || substr(md5('42:' || CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END"
# the optional features that every row has, as ``prepared`` drops rows without one
SQL_SPLIT = f"""{SQL_ML}
, data AS (
  SELECT id, CAST(valeur_fonciere AS DOUBLE) AS y, CAST(surface_reelle_bati AS DOUBLE) AS x, commune_prix_m2_moyen AS m, {SPLIT} AS split
  FROM rows
)"""


@register("split_summary", "M1 M3 M4 F1 F2", with_feat(f"""{SQL_SPLIT}
SELECT split, COUNT(*) AS n, {r('AVG(y)')} AS mean, {r('quantile_cont(y, 0.5)')} AS median, {r('MIN(y)')} AS min, {r('MAX(y)')} AS max
FROM data GROUP BY split
""".replace("\n, ml AS", ",\nml AS")))
def q_split_summary(spark, sf):
    out = M.split_summary(M.hash_split(M.training_rows(ml_table(spark, sf))))
    return out.select("split", "n", *[rnd(c).alias(c) for c in ("mean", "median", "min", "max")])


# ---------------------------------------------------------------------------
# fitted models: one model a query, fitted once and kept in the store


def store_of(spark: SparkSession) -> ModelStore:
    """The store in the folder that all machines share."""
    return ModelStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/parcelle-models")


def model_named(name: str) -> M.ModelSpec:
    return next(s for s in M.REFERENCE_MODELS if s.name == name)


def model_metrics(spark: SparkSession, sf: str, spec: M.ModelSpec) -> DataFrame:
    """M5-M9: one model on the train split, its metrics on the test split."""
    store = store_of(spark)
    data = store.prepare(*prepared(spark, sf))
    found = store.fitted(data, spec).row
    cols = ("model", "train_rows", "n", "r2", "mae", "rmse", "path")
    return spark.createDataFrame([tuple(found[c] for c in cols)], "model string, train_rows long, n long, r2 double, mae double, rmse double, path string").drop("path")


@register("linear_metrics", "M5 M9 S17")
def q_linear_metrics(spark, sf):
    return model_metrics(spark, sf, model_named("Linear Regression"))


@register("forest_metrics", "M6 M9 S17")
def q_forest_metrics(spark, sf):
    return model_metrics(spark, sf, model_named("Random Forest"))


@register("boosting_metrics", "M7 M9 S17")
def q_boosting_metrics(spark, sf):
    return model_metrics(spark, sf, model_named("Gradient Boosting"))


@register("feature_importance", "M14 K6")
def q_feature_importance(spark, sf, spec: M.ModelSpec | None = None):
    """Importances of the stored forest, largest first."""
    store = store_of(spark)
    data = store.prepare(*prepared(spark, sf))
    return M.feature_importance(store.fitted(data, spec or model_named("Random Forest")).model, data.features, 10)


@register("cv_scores", "M11")
def q_cv_scores(spark, sf, spec: M.ModelSpec | None = None):
    """5-fold cross-validation of a named model (the linear one)."""
    spec = spec or model_named("Linear Regression")
    store = store_of(spark)
    return store.folds(store.prepare(*prepared(spark, sf)), spec).withColumn("model", F.lit(spec.name))


@register("score_properties", "X6 M12 M13")
def q_score_properties(spark, sf, spec: M.ModelSpec | None = None):
    """Price the open listings as properties with a stored model; what a listing
    does not say is filled with the stored medians."""
    store = store_of(spark)
    data = store.prepare(*prepared(spark, sf))
    found = store.fitted(data, spec or model_named("Linear Regression"))
    medians = spark.createDataFrame([tuple(found.row["medians"][f] for f in data.features)], ", ".join(f"{f} double" for f in data.features))
    props = (T.listings(spark, sf).where(F.col("surface_habitable") > 0)
              .select("id", F.col("surface_habitable").alias("surface_reelle_bati"), "nb_pieces",
                      F.lit(1).alias("type_local_encoded")))
    scored = M.score(found.model, props, data.features, medians, found.row["rmse"])
    return scored.select("id", "prix_predit", "prix_min", "prix_max", "prix_m2_estime")


# The same steps with a model that SQL can state: a straight line over the area.
AREA_MODEL = M.ModelSpec("Area line", "linear", {})


def area_data(spark: SparkSession, sf: str, store: ModelStore):
    return store.prepare(M.training_rows(ml_table(spark, sf)), ["surface_reelle_bati"])


SQL_LINE = f"""{SQL_SPLIT}
, line AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b, COUNT(*) AS train_rows FROM data WHERE split = 'train')
, tested AS (SELECT y, a * x + b AS p, train_rows FROM data, line WHERE split = 'test')
, fit AS (
  SELECT any_value(train_rows) AS train_rows, COUNT(*) AS n, 1 - SUM((y - p) * (y - p)) / (var_pop(y) * COUNT(*)) AS r2,
         AVG(abs(y - p)) AS mae, sqrt(SUM((y - p) * (y - p)) / COUNT(*)) AS rmse FROM tested
)"""


@register("area_model", "M5 M9 S17", with_feat(f"""{SQL_LINE}
SELECT {r('a', 4)} AS slope, {r('b')} AS intercept, train_rows, n, {r('r2', 4)} AS r2, {r('mae')} AS mae, {r('rmse')} AS rmse FROM line
JOIN fit USING (train_rows)
""".replace("\n, ml AS", ",\nml AS")))
def q_area_model(spark, sf):
    """Fitted, stored, and read back from the store."""
    store = store_of(spark)
    data = area_data(spark, sf, store)
    store.fitted(data, AREA_MODEL)
    found = store.find(data, AREA_MODEL)
    last = found.model.stages[-1]
    row = (float(last.coefficients[0]), float(last.intercept), *(found.row[c] for c in ("train_rows", "n", "r2", "mae", "rmse")))
    out = spark.createDataFrame([row], "slope double, intercept double, train_rows long, n long, r2 double, mae double, rmse double")
    return out.select(rnd("slope", 4).alias("slope"), rnd("intercept").alias("intercept"), "train_rows", "n", rnd("r2", 4).alias("r2"),
                      rnd("mae").alias("mae"), rnd("rmse").alias("rmse"))


@register("best_model", "K7 M9", with_feat(f"""{SQL_LINE}
, means AS (SELECT AVG(y) AS m0 FROM data WHERE split = 'train')
, guesses AS (
  SELECT 'Area line' AS model, y, a * x + b AS p FROM data, line WHERE split = 'test'
  UNION ALL SELECT 'Mean price', y, m0 FROM data, means WHERE split = 'test'
  UNION ALL SELECT 'Commune ratio', y, x * coalesce(m, 0) FROM data WHERE split = 'test'
), scored AS (
  SELECT model, COUNT(*) AS n, 1 - SUM((y - p) * (y - p)) / (var_pop(y) * COUNT(*)) AS r2, AVG(abs(y - p)) AS mae,
         sqrt(SUM((y - p) * (y - p)) / COUNT(*)) AS rmse FROM guesses GROUP BY model
)
SELECT model, n, {r('r2', 4)} AS r2, {r('mae')} AS mae, {r('rmse')} AS rmse,
       model = (SELECT arg_max(model, r2) FROM scored) AS is_best FROM scored
""".replace("\n, ml AS", ",\nml AS")))
def q_best_model(spark, sf):
    """K7 over a metrics table of three simple models."""
    data = M.hash_split(M.training_rows(ml_table(spark, sf)))
    y, x = F.col(M.LABEL).cast("double"), F.col("surface_reelle_bati").cast("double")
    train = data.where("split = 'train'").agg(F.regr_slope(y, x).alias("a"), F.regr_intercept(y, x).alias("b"), F.avg(y).alias("m0"))
    test = with_one_row(data.where("split = 'test'").select(y.alias(M.LABEL), x.alias("x"), F.col("commune_prix_m2_moyen").alias("m")), train)
    guess = F.explode(F.create_map(F.lit("Area line"), F.col("a") * F.col("x") + F.col("b"), F.lit("Mean price"), F.col("m0"),
                                   F.lit("Commune ratio"), F.col("x") * F.coalesce("m", F.lit(0.0)))).alias("model", "prediction")
    out = best_of(M.regression_metrics(test.select(M.LABEL, guess), by=["model"]))
    return out.select("model", "n", rnd("r2", 4).alias("r2"), rnd("mae").alias("mae"), rnd("rmse").alias("rmse"), "is_best")


@register("area_model_folds", "M11", with_feat(f"""{SQL_SPLIT}
, placed AS (SELECT *, row_number() OVER (ORDER BY id) - 1 AS rk, COUNT(*) OVER () AS c FROM data)
, folded AS (
  SELECT *, CAST(rk >= (c // 5) + least(c % 5, 1) AS INTEGER) + CAST(rk >= 2 * (c // 5) + least(c % 5, 2) AS INTEGER)
          + CAST(rk >= 3 * (c // 5) + least(c % 5, 3) AS INTEGER) + CAST(rk >= 4 * (c // 5) + least(c % 5, 4) AS INTEGER) AS fold FROM placed
), lines AS (
  SELECT f.fold, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM (SELECT DISTINCT fold FROM folded) f JOIN folded d ON d.fold <> f.fold GROUP BY f.fold
), scores AS (
  SELECT fold, 1 - SUM((y - a * x - b) * (y - a * x - b)) / (var_pop(y) * COUNT(*)) AS r2 FROM folded JOIN lines USING (fold) GROUP BY fold
), s AS (SELECT AVG(r2) AS m, stddev_pop(r2) AS d FROM scores)
SELECT fold, {r('r2', 4)} AS r2, {r('m', 4)} AS cv_r2_mean, {r('d', 4)} AS cv_r2_std, {r('m - 2 * d', 4)} AS cv_r2_low, {r('m + 2 * d', 4)} AS cv_r2_high
FROM scores, s
""".replace("\n, ml AS", ",\nml AS")))
def q_area_model_folds(spark, sf):
    store = store_of(spark)
    out = store.folds(area_data(spark, sf, store), AREA_MODEL)
    return out.select("fold", *[rnd(c, 4).alias(c) for c in ("r2", "cv_r2_mean", "cv_r2_std", "cv_r2_low", "cv_r2_high")])


@register("saved_predictions", "M13 M15 X6 S17", with_feat(f"""{SQL_LINE}
, wanted AS (SELECT id, CAST(surface_habitable AS DOUBLE) AS x FROM listings WHERE surface_habitable > 0)
SELECT id, '{{"surface_reelle_bati":' || CAST(x AS VARCHAR) || '}}' AS features_json, 'Area line' AS model_version,
       round_even(a * x + b, 0) AS prix_predit, round_even(greatest(0, a * x + b - 1.96 * rmse * 0.5), 0) AS prix_min,
       round_even(a * x + b + 1.96 * rmse * 0.5, 0) AS prix_max, round_even((a * x + b) / x, 0) AS prix_m2_estime
FROM wanted, line, fit
""".replace("\n, ml AS", ",\nml AS")))
def q_saved_predictions(spark, sf):
    """Predictions appended to a table with their features as JSON, read back."""
    store = store_of(spark)
    data = area_data(spark, sf, store)
    found = store.fitted(data, AREA_MODEL)
    props = T.listings(spark, sf).where("surface_habitable > 0").select("id", F.col("surface_habitable").cast("double").alias("surface_reelle_bati"))
    medians = M.scoring_medians(data.rows, data.features)
    scored = M.score(found.model, props, data.features, medians, found.row["rmse"]).withColumn("model_version", F.lit(AREA_MODEL.name))
    path = f"{store.root}/predictions/{uuid.uuid4().hex}"
    half = F.col("id") % 2 == 0
    for part in (half, ~half):                     # two appends to one table
        M.persist_predictions(scored.where(part), path, data.features)
    return spark.read.parquet(path).select("id", "features_json", "model_version", "prix_predit", "prix_min", "prix_max", "prix_m2_estime")
