import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "prix_m2_median" in df.columns


def test_every_query_has_callable():
    qs = E.queries()
    sqls = E.oracle_sql()
    assert set(sqls) <= set(qs)


def test_model_queries_finite(spark):
    """The model queries' steps with small settings, given as arguments."""
    import math
    from parcelle.operators import ml as M
    from parcelle.plans import queries_ml as Q
    from tests.conftest import SF_SMALL
    small = M.ModelSpec("small forest", "forest", {"numTrees": 3, "maxDepth": 3, "seed": 1})
    for spec in (small, M.ModelSpec("small boosting", "gbt", {"maxIter": 2, "maxDepth": 2, "seed": 1})):
        r = Q.model_metrics(spark, SF_SMALL, spec).first()
        assert r.model == spec.name and all(math.isfinite(x) for x in (r.r2, r.mae, r.rmse)) and r.n > 0
    imp = Q.q_feature_importance(spark, SF_SMALL, small).collect()
    assert len(imp) == 10 and [r.importance for r in imp] == sorted((r.importance for r in imp), reverse=True)
    cv = E.queries()["cv_scores"](spark, SF_SMALL).collect()
    assert sorted(r.fold for r in cv) == [0, 1, 2, 3, 4]
    assert all(math.isfinite(r.r2) for r in cv) and len({(r.cv_r2_mean, r.cv_r2_low, r.cv_r2_high) for r in cv}) == 1
    scored = Q.q_score_properties(spark, SF_SMALL, small).collect()
    assert scored and all(r.prix_min <= r.prix_predit <= r.prix_max and r.prix_min >= 0 for r in scored)


def test_store_fits_once(spark, tmp_path, monkeypatch):
    from parcelle.operators import ml as M
    from parcelle.operators.model_store import ModelStore
    df = spark.range(400).selectExpr("id", "cast(id * 3 + 7 as double) valeur_fonciere", "cast(id as double) x", "cast(id % 7 as double) z")
    spec = M.ModelSpec("line", "linear", {})
    fits = []
    real = M.fit
    monkeypatch.setattr(M, "fit", lambda *a: fits.append(1) or real(*a))
    store = ModelStore(spark, str(tmp_path))
    first = store.fitted(store.prepare(df, ["x", "z"]), spec)
    again = ModelStore(spark, str(tmp_path)).fitted(store.prepare(df.repartition(3), ["x", "z"]), spec)    # the same rows anew
    assert len(fits) == 1 and again.row == first.row and abs(again.row["r2"] - 1) < 1e-9
    assert first.row["train_rows"] + first.row["n"] == 400 and first.row["medians"]["x"] == 199.5
    store.fitted(store.prepare(df.where("id < 390"), ["x", "z"]), spec)                                    # other rows
    store.fitted(store.prepare(df, ["x"]), spec)                                                           # other features
    store.fitted(store.prepare(df, ["x", "z"]), M.ModelSpec("line", "linear", {"maxIter": 5}))             # other settings
    assert len(fits) == 4 and store.metrics().count() == 4


def test_store_folds_are_kept(spark, tmp_path, monkeypatch):
    from parcelle.operators import ml as M
    from parcelle.operators.model_store import ModelStore
    df = spark.range(100).selectExpr("id", "cast(id + id % 5 as double) valeur_fonciere", "cast(id as double) x")
    store = ModelStore(spark, str(tmp_path))
    data = store.prepare(df, ["x"])
    spec = M.ModelSpec("line", "linear", {})
    want = sorted(map(tuple, store.folds(data, spec).collect()))
    monkeypatch.setattr(M, "fit", None)                        # nothing is fitted again
    assert sorted(map(tuple, store.folds(data, spec).collect())) == want
    assert [tuple(r) for r in M.cross_validate.__globals__["contiguous_folds"](df, "id").groupBy("fold").count().orderBy("fold").collect()] == [(i, 20) for i in range(5)]


def test_scale_conf_sizes_partitions():
    from parcelle.session import scale_conf
    c = scale_conf(100 * 1024 ** 4)
    assert c["spark.sql.shuffle.partitions"] == str(100 * 1024 ** 4 // (256 * 1024 ** 2))
    assert c["spark.sql.files.maxPartitionBytes"] == "256m"
    assert scale_conf(1024)["spark.sql.shuffle.partitions"] == "200"


def test_fit_uses_the_cores_and_repeats(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    from parcelle.operators import ml as M
    from parcelle.operators import model_store as S
    assert S.fit_partitions(10, 15, 12) == 1 and S.fit_partitions(353_208, 15, 12) == 12
    assert S.fit_partitions(20_000_000, 15, 12) == 12 and S.fit_partitions(40_000_000, 15, 12) == 24
    monkeypatch.setattr(S, "PARTITION_ROWS", 100)
    seen = []
    real = M.fit
    monkeypatch.setattr(M, "fit", lambda train, *a: seen.append(train.rdd.getNumPartitions()) or real(train, *a))
    spec = M.ModelSpec("rf", "forest", {"numTrees": 4, "maxDepth": 5, "seed": 42, "featureSubsetStrategy": "all"})
    df = spark.range(400).selectExpr("id", "cast(id * id as double) valeur_fonciere", "cast(id as double) x", "cast(id % 7 as double) z")
    rows = []
    for i, given in enumerate((df, df.orderBy(F.desc("id")).coalesce(1))):      # the same rows in other files
        store = S.ModelStore(spark, str(tmp_path / str(i)))
        rows.append(store.fitted(store.prepare(given, ["x", "z"]), spec).row)
    assert seen == [4, 4]
    assert all(abs(rows[0][c] - rows[1][c]) < 1e-6 * abs(rows[0][c]) for c in ("r2", "mae", "rmse"))
    # kept tree places change no tree
    kept, walked = (real(df, ["x", "z"], spec, M.LABEL, n).stages[-1] for n in (400, None))
    assert kept.toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:]


def test_boosting_fit_is_dealt_over_the_cores(spark, tmp_path, monkeypatch):
    from parcelle.operators import ml as M
    from parcelle.operators import model_store as S
    monkeypatch.setattr(S, "PARTITION_ROWS", 100)
    rows = {}
    real = M.fit
    monkeypatch.setattr(M, "fit", lambda train, *a: rows.update(n=[len(p) for p in train.select("id").rdd.glom().collect()]) or real(train, *a))
    df = spark.range(400).coalesce(1).selectExpr("id", "cast(id * id as double) valeur_fonciere", "cast(id as double) x")
    store = S.ModelStore(spark, str(tmp_path))
    found = store.fitted(store.prepare(df, ["x"]), M.ModelSpec("gbt", "gbt", {"maxIter": 3, "maxDepth": 4, "stepSize": 0.1, "seed": 42})).row
    assert len(rows["n"]) == 4 and min(rows["n"]) > 0 and sum(rows["n"]) == found["train_rows"]


def test_a_fit_reads_the_sales_once(spark):
    from pyspark.sql import functions as F
    from parcelle.operators import ml as M
    from parcelle.plans import queries_ml as Q
    rows, feats = Q.prepared(spark, "/root/testdata/sf0.001")
    assert not [f for f in rows.inputFiles() if "/orders.parquet" in f or "/lineitem.parquet" in f]
    # the rows and features of the feature file that is not written
    plain = M.training_rows(Q.ml_table(spark, "/root/testdata/sf0.001"))
    assert feats == M.select_features(plain)
    sums = [F.sum(F.col(c).cast("double") * (F.col("id") % 7 + 1)) for c in [M.LABEL, *feats]]
    found, wanted = (df.agg(F.count("*"), *sums).first() for df in (rows, M.model_frame(plain, feats)))
    assert found[0] == wanted[0] > 0
    assert all(abs(a - b) <= 1e-9 * abs(b) for a, b in zip(found, wanted))


def test_a_forest_grows_in_groups_of_trees(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F
    from parcelle.operators import ml as M
    from parcelle.operators import model_store as S
    monkeypatch.setattr(M, "FOREST_NODES", 200, raising=False)
    fits = []
    real = M.fit
    monkeypatch.setattr(M, "fit", lambda *a: fits.append(real(*a)) or fits[-1])
    df = spark.range(400).selectExpr("id", "cast(id * id as double) valeur_fonciere", "cast(id as double) x", "cast(id % 7 as double) z")
    spec = M.ModelSpec("rf", "forest", {"numTrees": 10, "maxDepth": 5, "seed": 42, "featureSubsetStrategy": "all"})
    store = S.ModelStore(spark, str(tmp_path))
    data = store.prepare(df, ["x", "z"])
    found = store.fitted(data, spec)
    forests = [m.stages[-1] for m in fits]
    # the driver never holds the whole forest, and no tree is missing or there twice
    assert len(forests) > 2 and all(f.totalNumNodes <= 200 for f in forests) and sum(f.getNumTrees for f in forests) == 10
    trees = [t for f in forests for t in f.trees]
    assert len({t.toDebugString.split("\n", 1)[1] for t in trees}) == 10
    # metrics, predictions and importances are those of all trees, from the store as well
    vectors = fits[0].stages[0].transform(df).select("id", "features").collect()
    want = {r.id: sum(t.predict(r.features) for t in trees) / 10 for r in vectors}
    again = store.fitted(data, spec)
    assert again.row == found.row and len(fits) == len(forests)
    for model in (found.model, again.model):
        got = {r.id: r.prediction for r in model.transform(df).collect()}
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) <= 1e-9 * max(1, abs(want[i])) for i in want)
        mean = sum(t.featureImportances.toArray() for t in trees) / 10
        assert [r.feature for r in M.feature_importance(model, data.features).collect()] == ["x", "z"]
        assert abs(model.featureImportances.toArray() - mean).max() < 1e-12
    test = [(r.id, r.valeur_fonciere) for r in data.rows.where(F.col("split") == "test").collect()]
    assert abs(found.row["mae"] - sum(abs(y - want[i]) for i, y in test) / len(test)) < 1e-6 and found.row["n"] == len(test)
