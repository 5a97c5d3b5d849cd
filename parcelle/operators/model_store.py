"""A store of fitted price models.

A model is fitted once per (training rows, features, settings, part of the rows)
and kept as a ``PipelineModel`` beside a row of a metrics table; comparison,
importance, scoring and folds read it back.  Rows are known by a fingerprint of
their content, so a stored model is the one a new fit would give, and what is read
never depends on which query ran first.

A fit writes the model into a folder of its own and its metrics row last: a reader
that finds the row finds a whole model, and a fit cut short leaves nothing to read.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.operators import ml as M
from parcelle.session import free_driver_memory

SCHEMA = ("fingerprint string, part string, model string, settings string, features array<string>, train_rows long, "
          "n long, r2 double, mae double, rmse double, medians map<string,double>, path string, groups int")
#: Bytes of training data that one partition of a fit holds.  A partition more costs one
#: more histogram of every tree node, so partitions beyond the cores come late.
PARTITION_BYTES = 256 * 1024 * 1024
#: Rows that are worth a partition of their own as long as cores are free.
PARTITION_ROWS = 5_000


@dataclass
class Prepared:
    """Modelling rows, written once: id, label, features, split (and fold)."""
    rows: DataFrame
    features: list[str]
    count: int
    fingerprint: str
    label: str


@dataclass
class Stored:
    model: PipelineModel | M.Forest
    row: dict


class ModelStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def metrics(self) -> DataFrame:
        """The metrics table: a row a fitted model."""
        try:
            return self.spark.read.schema(SCHEMA).parquet(f"{self.root}/metrics")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def prepare(self, rows: DataFrame, features: list[str], label: str = M.LABEL, id_col: str = "id") -> Prepared:
        """Write the modelling rows with their split once and fingerprint them."""
        cols = [F.col(id_col).alias("id"), F.col(label).cast("double").alias(label), *[F.col(f).cast("double").alias(f) for f in features]]
        path = f"{self.root}/rows/{uuid.uuid4().hex}"
        M.hash_split(rows.select(*cols), "id").write.parquet(path)
        kept = self.spark.read.parquet(path)
        n, mark = kept.agg(F.count("*"), F.sum(F.xxhash64(*kept.columns).cast("decimal(38,0)"))).first()
        return Prepared(kept, list(features), n, f"{n}:{mark}", label)

    def find(self, data: Prepared, spec: M.ModelSpec, part: str = "split") -> Stored | None:
        known = self.metrics().where((F.col("fingerprint") == data.fingerprint) & (F.col("part") == part)
                                     & (F.col("model") == spec.name) & (F.col("settings") == _settings(spec))
                                     & (F.col("features") == F.array(*map(F.lit, data.features))))
        row = known.orderBy("path").first()
        return Stored(stored_model(row["path"], row["groups"]), row.asDict()) if row else None

    def fitted(self, data: Prepared, spec: M.ModelSpec, part: str = "split", test=None) -> Stored:
        """The stored model, or a fit on the rows where ``test`` (default: the test
        split) does not hold, with its metrics on those where it does."""
        found = self.find(data, spec, part)
        if found:
            return found
        test = F.col("split") == "test" if test is None else test
        parts = fit_partitions(data.count, len(data.features) + 2, self.spark.sparkContext.defaultParallelism)
        # dealt and ordered by id: bootstraps do not depend on the files the rows lie in
        train = data.rows.where(~test).repartition(parts, "id").sortWithinPartitions("id").persist(StorageLevel.MEMORY_AND_DISK)
        path = f"{self.root}/models/{uuid.uuid4().hex}"
        try:
            if M.in_groups(spec, data.count):
                model, predicted = self._grow(train, data, spec, path, test)
            else:
                model = M.fit(train, data.features, spec, data.label, data.count)
                model.write().save(path)
                predicted = model.transform(data.rows.where(test))
            scores = M.regression_metrics(predicted, data.label).first()
            medians = M.scoring_medians(data.rows, data.features).first().asDict()
            train_rows = train.count()
        finally:
            train.unpersist()
        row = (data.fingerprint, part, spec.name, _settings(spec), data.features, train_rows, scores["n"], scores["r2"], scores["mae"],
               scores["rmse"], {k: float(v) for k, v in medians.items() if v is not None}, path,
               len(model.folders) if isinstance(model, M.Forest) else None)
        self.spark.createDataFrame([row], SCHEMA).write.mode("append").parquet(f"{self.root}/metrics")
        return Stored(model, dict(zip([f.name for f in self.metrics().schema], row)))

    def _grow(self, train: DataFrame, data: Prepared, spec: M.ModelSpec, path: str, test) -> tuple[M.Forest, DataFrame]:
        """Fit, store and apply a forest, one group of trees after the other."""
        votes, importances, folders = data.rows.where(test), 0.0, []
        for group in M.grow_groups(train, data.features, spec, data.label, data.count):
            free_driver_memory(self.spark)
            folders.append(f"{path}/group-{len(folders)}")
            group.write().save(folders[-1])
            votes, importances = M.add_votes(group, votes), importances + M.split_importances(group)
            del group                       # else it lies in the driver beside the next
            free_driver_memory(self.spark)
        return M.Forest(folders, importances), M.mean_vote(votes)

    def folds(self, data: Prepared, spec: M.ModelSpec, k: int = 5) -> DataFrame:
        """R2 of each fold, their mean, population deviation and the mean less
        and plus two deviations.  The models of the folds are stored as well."""
        rows = M.contiguous_folds(data.rows, "id", k)
        folded = Prepared(rows, data.features, data.count, data.fingerprint, data.label)
        each = [(i, self.fitted(folded, spec, f"fold {i} of {k}", F.col("fold") == i).row["r2"]) for i in range(k)]
        out = self.spark.createDataFrame(each, "fold int, r2 double")
        return M.with_one_row(out, M.fold_summary(out))


def stored_model(path: str, groups: int | None) -> PipelineModel | M.Forest:
    """The model below ``path``; ``groups`` is null unless it is a forest in groups."""
    return PipelineModel.load(path) if groups is None else M.Forest([f"{path}/group-{i}" for i in range(groups)])


def fit_partitions(rows: int, columns: int, cores: int) -> int:
    """Partitions of a fit: all cores where there are rows for them, and whole rounds of
    the cores where the rows fill more."""
    by_bytes = rows * 8 * columns // PARTITION_BYTES
    return max(1, min(cores, rows // PARTITION_ROWS), -(-by_bytes // cores) * cores)


def _settings(spec: M.ModelSpec) -> str:
    return json.dumps({"kind": spec.kind, **spec.params}, sort_keys=True)


def best_of(metrics: DataFrame) -> DataFrame:
    """K7: ``is_best`` on the model with the highest R2 (ties: first by name)."""
    best = metrics.agg(F.min_by("model", F.struct((-F.col("r2")).alias("r"), "model")).alias("_best"))
    return M.with_one_row(metrics, best).withColumn("is_best", F.col("model") == F.col("_best")).drop("_best")
