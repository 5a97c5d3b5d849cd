"""Price models with Spark MLlib.

Training data never leaves the cluster: splits are hash-based columns,
models are MLlib estimators, metrics are one aggregate over (label,
prediction), and scoring is ``PipelineModel.transform``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.functions import derive as D
from parcelle.operators.quantiles import column_quantiles, group_quantiles, with_one_row
from parcelle.operators.ranks import number_rows
from parcelle.operators.reports import coverage
from parcelle.session import write_once

# Feature lists of the price model.
BASE_FEATURES = ["surface_reelle_bati", "nb_pieces", "type_local_encoded", "mois", "trimestre", "jour_semaine"]
OPTIONAL_FEATURES = ["distance_centre_ville", "commune_prix_m2_moyen", "commune_nb_ventes", "commune_population",
                     "commune_densite", "grande_surface", "proche_centre"]
MODEL_TYPES = ["Appartement", "Maison"]
SCORING_DEFAULTS = {"mois": 6, "trimestre": 2, "jour_semaine": 3}
LABEL = "valeur_fonciere"


@dataclass
class ModelSpec:
    name: str
    kind: str
    params: dict


# Reference settings (sklearn / xgboost) mapped onto MLlib estimators.
REFERENCE_MODELS = [
    ModelSpec("Linear Regression", "linear", {}),
    ModelSpec("Random Forest", "forest", {"numTrees": 100, "maxDepth": 15, "seed": 42,
                                          "featureSubsetStrategy": "all"}),
    ModelSpec("Gradient Boosting", "gbt", {"maxIter": 100, "maxDepth": 10, "stepSize": 0.1, "seed": 42}),
    ModelSpec("XGBoost", "gbt", {"maxIter": 200, "maxDepth": 15, "stepSize": 0.05, "subsamplingRate": 0.8,
                                 "featureSubsetStrategy": "0.8", "minInstancesPerNode": 5, "minInfoGain": 0.1, "seed": 42}),
]


def training_rows(df: DataFrame, label: str = LABEL, types: Sequence[str] = MODEL_TYPES) -> DataFrame:
    """M1: complete rows of the modelled types with positive price and area."""
    return (df.dropna(subset=[label, "surface_reelle_bati", "type_local"])
              .where(F.col("type_local").isin(*types) & (F.col(label) > 0) & (F.col("surface_reelle_bati") > 0)))


def select_features(df: DataFrame, base: Sequence[str] = BASE_FEATURES,
                    optional: Sequence[str] = OPTIONAL_FEATURES, min_share: float = 0.3) -> list[str]:
    """Base features plus optional ones present and more than
    ``min_share`` non-null (one aggregate; only the short list returns)."""
    present = [c for c in optional if c in df.columns]
    if not present:
        return list(base)
    kept = {r["feature"] for r in coverage(df, present).where(F.col("pct") > min_share * 100).collect()}
    return list(base) + [c for c in present if c in kept]


def model_frame(df: DataFrame, features: Sequence[str], label: str = LABEL) -> DataFrame:
    """P34 + F1: booleans as 0/1, rows with a missing feature dropped."""
    return D.booleans_to_int(df).dropna(subset=list(features) + [label])


def hash_split(df: DataFrame, id_col: str = "id", train_pct: int = 80, seed: int = 42) -> DataFrame:
    """M3: repeatable 80/20 split column from the MD5 of seed and id (independent of
    partitioning, unlike ``randomSplit``, and the same in any SQL engine)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100
    return df.withColumn("split", F.when(bucket < train_pct, F.lit("train")).otherwise(F.lit("test")))


def split_summary(df: DataFrame, label: str = LABEL) -> DataFrame:
    """M4: size, mean, exact median, min and max of the label per split."""
    stats = df.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("mean"),
                                    F.min(label).alias("min"), F.max(label).alias("max"))
    med = group_quantiles(df, ["split"], label, {"median": 0.5})
    return stats.join(med, "split", "left")


def estimator(spec: ModelSpec, label: str = LABEL):
    common = {"featuresCol": "features", "labelCol": label, "predictionCol": "prediction"}
    if spec.kind == "linear":
        return LinearRegression(regParam=0.0, **common, **spec.params)
    if spec.kind == "forest":
        return RandomForestRegressor(**common, **spec.params)
    if spec.kind == "gbt":
        return GBTRegressor(**common, **spec.params)
    raise ValueError(spec.kind)


#: Bytes of tree places (a number a row and tree) up to which a forest keeps them between
#: its passes instead of walking every tree from its root again; the trees are the same.
NODE_ID_BYTES = 1024 * 1024 * 1024
#: MB of histograms in a task of a forest's pass, as every node of the pass has a place in what
#: the driver sends and gets; the trees are the same.
PASS_MB = 64


def fit(train: DataFrame, features: Sequence[str], spec: ModelSpec, label: str = LABEL,
        rows: int | None = None) -> PipelineModel:
    """M5-M8: assemble the features and fit one estimator (``rows``: about how many there are, if known)."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    est = estimator(spec, label)
    if spec.kind == "forest":
        est.setMaxMemoryInMB(PASS_MB)
    if spec.kind == "forest" and rows is not None:
        est.setCacheNodeIds(4 * rows * est.getNumTrees() <= NODE_ID_BYTES)
    return Pipeline(stages=[assembler, est]).fit(train)


#: Nodes of a forest's trees that the driver holds at a time: some 250 bytes each while they
#: grow, some 2 KB for as long as their model is written or sent to the executors.
FOREST_NODES = 192 * 1024


def tree_nodes(spec: ModelSpec, rows: int) -> int:
    """The most nodes that a tree of a forest over ``rows`` rows can have."""
    return min(2 ** (estimator(spec).getMaxDepth() + 1), 2 * max(1, rows))


def in_groups(spec: ModelSpec, rows: int) -> bool:
    """Is this a forest of more nodes than the driver should hold?"""
    return spec.kind == "forest" and estimator(spec).getNumTrees() * tree_nodes(spec, rows) > FOREST_NODES


def grow_groups(train: DataFrame, features: Sequence[str], spec: ModelSpec, label: str, rows: int) -> Iterator[PipelineModel]:
    """All trees of a forest, in groups of about ``FOREST_NODES`` nodes (or one tree), each a forest
    with a seed of its own; groups after the first go by the size of the trees so far.  Drop a
    group before the next is taken."""
    est = estimator(spec)
    left, nodes, seed = est.getNumTrees(), tree_nodes(spec, rows), est.getSeed()
    # a group of one tree would take all features where a forest takes a third
    subset = "onethird" if left > 1 and est.getFeatureSubsetStrategy() == "auto" else est.getFeatureSubsetStrategy()
    first = left
    while left:
        trees = -(-left // -(-left // max(1, FOREST_NODES // nodes)))
        own = seed if left == first else zlib.crc32(f"{seed}:{first - left}".encode())
        model = fit(train, features, replace(spec, params={**spec.params, "numTrees": trees, "seed": own, "featureSubsetStrategy": subset}),
                    label, rows)
        sizes = [t.numNodes for t in model.stages[-1].trees]
        left, nodes = left - trees, max(sizes if left == first else [nodes, *sizes])
        yield model
        del model


@dataclass
class Forest:
    """A forest whose groups of trees are stored models; the driver holds one at a time."""
    folders: list[str]
    _importances: np.ndarray | None = None

    def groups(self) -> Iterator[PipelineModel]:
        return (PipelineModel.load(f) for f in self.folders)

    def transform(self, df: DataFrame) -> DataFrame:
        """The mean over all trees as ``prediction``."""
        for model in self.groups():
            df = add_votes(model, df)
        return mean_vote(df)

    @property
    def featureImportances(self) -> DenseVector:
        """As of one forest: the mean over the trees that split at all."""
        if self._importances is None:
            self._importances = sum(split_importances(model) for model in self.groups())
        return DenseVector(self._importances / (self._importances.sum() or 1.0))


def add_votes(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the predictions of a group's trees to their sum so far, and write it."""
    trees = model.stages[-1].getNumTrees
    if "_votes" not in df.columns:
        df = df.withColumns({"_votes": F.lit(0.0), "_trees": F.lit(0)})
    out = model.transform(df).withColumns({"_votes": F.col("_votes") + trees * F.col("prediction"), "_trees": F.col("_trees") + trees})
    return write_once(out.drop("features", "prediction"), "forest-votes")


def mean_vote(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", F.col("_votes") / F.col("_trees")).drop("_votes", "_trees")


def split_importances(model: PipelineModel) -> np.ndarray:
    """Importances of a group's trees, summed over those that split at all."""
    last = model.stages[-1]
    return sum(t.depth > 0 for t in last.trees) * last.featureImportances.toArray()


def regression_metrics(pred: DataFrame, label: str = LABEL, prediction: str = "prediction",
                       by: Sequence[str] = ()) -> DataFrame:
    """M9: R2, MAE, RMSE from one aggregate (sklearn definitions: R2 against
    the mean of the evaluated labels)."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    g = pred.groupBy(*by) if by else pred
    agg = g.agg(F.count(F.lit(1)).alias("n"), F.var_pop(y).alias("_var"),
                F.sum((y - p) * (y - p)).alias("_sse"), F.avg(F.abs(y - p)).alias("mae"))
    sst = F.col("_var") * F.col("n")
    return agg.select(*by, "n", (F.lit(1.0) - F.col("_sse") / sst).alias("r2"), "mae",
                      F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"))


def error_stats(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """Percent errors (y - p) / y * 100: mean, exact median and p90 of
    their absolute value, and the mean signed error."""
    e = pred.withColumn("error_pct", (F.col(label) - F.col(prediction)) / F.col(label) * 100) \
            .withColumn("abs_error_pct", F.abs("error_pct"))
    base = e.agg(F.avg("error_pct").alias("mean_error_pct"), F.avg("abs_error_pct").alias("mean_abs_error_pct"))
    q = group_quantiles(e, [], "abs_error_pct", {"median_abs_error_pct": 0.5, "p90_abs_error_pct": 0.9})
    return with_one_row(base, q)


def contiguous_folds(df: DataFrame, order_col: str, k: int = 5) -> DataFrame:
    """M11 folds like an unshuffled K-fold: contiguous blocks of the rows in
    ``order_col`` order, the first ``n % k`` blocks one row larger; rows without
    ``order_col`` have no fold.  Ranks are exact row numbers (64-bit integers, no
    global window), written once."""
    numbered, n = number_rows(df, order_col, name="_rank")
    empty = numbered.where(F.col(order_col).isNull()).count()      # nulls come first
    size, more = divmod(n - empty, k)
    rank = F.col("_rank") - F.lit(empty)
    fold = F.when(rank < more * (size + 1), F.expr(f"(_rank - {empty}L) div {size + 1}L")).otherwise(
        F.expr(f"{more}L + (_rank - {empty + more * (size + 1)}L) div {max(1, size)}L"))
    return numbered.withColumn("fold", F.when(F.col(order_col).isNotNull(), fold).cast("int")).drop("_rank")


def cross_validate(df: DataFrame, features: Sequence[str], spec: ModelSpec, order_col: str = "id",
                   k: int = 5, label: str = LABEL) -> DataFrame:
    """R2 per fold (train on the other folds), with mean and population
    std over folds.  The driver loops over the k folds; each fit is a Spark job."""
    folded = contiguous_folds(df, order_col, k)
    out = None
    for i in range(k):
        model = fit(folded.where(F.col("fold") != i), features, spec, label)
        m = regression_metrics(model.transform(folded.where(F.col("fold") == i)), label)
        m = m.select(F.lit(i).alias("fold"), "r2")
        out = m if out is None else out.unionByName(m)
    return with_one_row(out, fold_summary(out))


def fold_summary(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of the folds' R2, and mean -+ 2 deviations."""
    s = scores.agg(F.avg("r2").alias("cv_r2_mean"), F.stddev_pop("r2").alias("cv_r2_std"))
    return s.withColumns({"cv_r2_low": F.col("cv_r2_mean") - 2 * F.col("cv_r2_std"),
                          "cv_r2_high": F.col("cv_r2_mean") + 2 * F.col("cv_r2_std")})


def feature_importance(model: PipelineModel | Forest, features: Sequence[str], top: int = 10) -> DataFrame:
    """Importances of a tree model, largest first (one row per feature)."""
    spark = SparkSession.active()
    last = model if isinstance(model, Forest) else model.stages[-1]
    if not hasattr(last, "featureImportances"):
        return spark.createDataFrame([], "feature string, importance double")
    imp = last.featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(top)


def scoring_medians(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """Exact median of every feature over the modelling rows (one row)."""
    return column_quantiles(train, features, 0.5)


def score(model: PipelineModel | Forest, props: DataFrame, features: Sequence[str], medians: DataFrame, rmse: float,
          area_col: str = "surface_reelle_bati") -> DataFrame:
    """Fill missing features (given > default month/quarter/day >
    training median > 0), predict, band +-1.96 * RMSE * 0.5 floored at 0,
    price per area; all rounded to units half-to-even, as numpy rounds."""
    filled = with_one_row(props, medians.select(*[F.col(f).alias(f"_med_{f}") for f in features]))
    fill: dict[str, Column] = {}
    for f in features:
        cur = F.col(f) if f in props.columns else F.lit(None)
        default = F.lit(SCORING_DEFAULTS[f]) if f in SCORING_DEFAULTS else F.col(f"_med_{f}")
        fill[f] = F.coalesce(cur.cast("double"), default.cast("double"), F.lit(0.0))
    filled = filled.withColumns(fill).drop(*[f"_med_{f}" for f in features])
    pred = model.transform(filled)
    half = 1.96 * rmse * 0.5
    p = F.col("prediction")
    return pred.withColumns({
        "prix_predit": F.bround(p, 0),
        "prix_min": F.bround(F.greatest(F.lit(0.0), p - half), 0),
        "prix_max": F.bround(p + half, 0),
        "prix_m2_estime": F.bround(p / F.col(area_col), 0),
    }).drop("features")


def persist_predictions(scored: DataFrame, path: str, features: Sequence[str]) -> None:
    """Append predictions with the features as JSON."""
    out = scored.withColumn("features_json", F.to_json(F.struct(*features)))
    out.write.mode("append").parquet(path)


def prediction_context(props: DataFrame, quartiers: DataFrame, sales: DataFrame, places: DataFrame,
                       radius_m: float = 500.0, transport_type: str = "transport",
                       ratio_col: str = "prix_m2") -> DataFrame:
    """Declared prediction columns: the property's district (G4), the mean
    sale ratio of that district (J8 by district) and the transport places
    within ``radius_m`` (G3)."""
    from parcelle.operators import spatial
    from parcelle.plans.sizing import lookup
    located = spatial.locate_in_polygons(props, quartiers)
    sold = spatial.locate_in_polygons(sales.select("id", "latitude", "longitude", ratio_col), quartiers)
    per_district = (sold.where(F.col("quartier_id").isNotNull() & F.col(ratio_col).isNotNull())
                        .groupBy("quartier_id").agg(F.avg(ratio_col).alias("prix_m2_moyen_quartier")))
    out = lookup(located, per_district.withColumnRenamed("quartier_id", "_pd_id"), F.col("quartier_id"), "_pd_id",
                 "district-means").drop("_pd_id")
    transports = places.where(F.col("type_poi") == transport_type)
    return spatial.count_within_radius(out, transports, radius_m, out_prefix="_tr_").withColumnRenamed(
        "_tr_total", f"nb_transports_{int(radius_m)}m")


def predict_price(model: PipelineModel, features: Sequence[str], medians: DataFrame, rmse: float,
                  surface: float, nb_pieces: int, type_bien: str = "Appartement", **kwargs) -> dict:
    """X6 for one property, as a call: the same scoring as ``score`` on a
    one-row frame (type code 1 for an apartment, 2 otherwise; other features
    from ``kwargs``, else the defaults and training medians)."""
    spark = SparkSession.active()
    row = {"surface_reelle_bati": float(surface), "nb_pieces": int(nb_pieces),
           "type_local_encoded": 1 if type_bien == "Appartement" else 2}
    row.update({k: v for k, v in kwargs.items() if k in features})
    cols = [c for c in features if c in row]
    props = spark.createDataFrame([tuple(float(row[c]) for c in cols)], ", ".join(f"{c} double" for c in cols))
    out = score(model, props, features, medians, rmse).first()
    return {k: out[k] for k in ("prix_predit", "prix_min", "prix_max", "prix_m2_estime")}
