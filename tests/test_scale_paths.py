"""Paths taken when one key holds a large share of the rows, and the sinks."""

import os
import tempfile

from pyspark.sql import functions as F

from parcelle.operators import clean as C
from parcelle.operators import ml as M
from parcelle.operators import quantiles as Q
from parcelle.operators import spatial
from parcelle.sources import files as FS


def _hot(spark, n=4000):
    # a third of the rows share one key
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("g"),
        ((F.col("id") * 7919) % 1000 / 10.0).alias("v"))


def test_hot_group_quantiles(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
                                  ((F.col("id") * 7919) % 5003 / 7.0).alias("v"))
    want = {r.g: (r.m, r.p9) for r in df.groupBy("g").agg(F.percentile("v", 0.5).alias("m"), F.percentile("v", 0.9).alias("p9")).collect()}
    assert {r.g: (r.m, r.p9) for r in Q.group_quantiles(df, ["g"], "v", {"m": 0.5, "p9": 0.9}).collect()} == want


def test_hot_duplicate_key(spark):
    df = spark.range(3000).select(F.col("id"), F.lit("2020-01-01").cast("date").alias("date_mutation"),
                                  F.when(F.col("id") % 3 == 0, F.lit(100000.0)).otherwise(F.col("id").cast("double"))
                                  .alias("valeur_fonciere"),
                                  F.lit("75056").alias("code_commune"), F.lit(None).cast("double").alias("surface_reelle_bati"),
                                  F.lit("Maison").alias("type_local"))
    out = C.remove_duplicates(df)
    assert out.count() == 2001
    assert out.where(F.col("valeur_fonciere") == 100000.0).first().id == 0


def test_hot_cell_salted_join(spark):
    pts = spark.range(2000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(48.85))
                                   .otherwise(48 + (F.col("id") % 97) / 100.0).alias("latitude"),
                                   F.lit(2.35).alias("longitude"))
    places = spark.range(30).select((48 + F.col("id") / 30.0).alias("latitude"), F.lit(2.35).alias("longitude"))
    a = {r.id: r.nb_total for r in spatial.count_within_radius(pts, places, 3000.0, salt_buckets=8,
                                                               max_broadcast_bytes=0).collect()}
    b = {r.id: r.nb_total for r in spatial.count_within_radius(pts, places, 3000.0).collect()}
    assert a == b and len(a) == 2000


def test_view_and_model_sinks(spark):
    base = tempfile.mkdtemp(prefix="parcelle-sink-")
    df = spark.range(200).select(F.col("id"), (F.col("id") * 2.0 + 1).alias("x"), (F.col("id") * 4.0 + 3).alias("y"),
                                 (F.col("id") % 4).alias("part"))
    FS.write_by(df, os.path.join(base, "by_part"), ["part"])
    back = FS.read_years(spark, os.path.join(base, "by_part"), 1, 2, year_col="part")
    assert back.count() == 100
    model = M.fit(df, ["x"], M.ModelSpec("lr", "linear", {}), label="y")
    metrics = M.regression_metrics(model.transform(df), label="y")
    assert metrics.first().r2 > 0.999
    model.write().save(os.path.join(base, "model"))
    from pyspark.ml import PipelineModel
    again = PipelineModel.load(os.path.join(base, "model"))
    assert again.transform(df).count() == 200
    # Scored rows appended with their features as JSON
    meds = M.scoring_medians(df, ["x"])
    props = spark.createDataFrame([(1, 10.0), (2, None)], "id long, x double")
    scored = M.score(again, props, ["x"], meds, rmse=0.0, area_col="x")
    M.persist_predictions(scored, os.path.join(base, "predictions"), ["x"])
    M.persist_predictions(scored, os.path.join(base, "predictions"), ["x"])
    saved = spark.read.parquet(os.path.join(base, "predictions"))
    assert saved.count() == 4
    got = {r.id: (r.prix_predit, r.features_json) for r in saved.collect()}
    assert got[1] == (21.0, '{"x":10.0}')     # y = 2x + 1
    assert got[2] == (401.0, '{"x":200.0}')   # missing feature -> exact training median (199 + 201) / 2


def test_content_id_hot_identical_rows(spark, monkeypatch):
    from parcelle.functions import parse as P
    rows = [("2020-01-01", "75056", 1000.0, 1.0)] * 2500 + [("2020-01-01", "75056", 1000.0, float(i)) for i in range(40)] \
        + [("2021-01-01", "69123", 5.5, None)] * 2
    df = spark.createDataFrame(rows, "d string, code string, price double, extra double").withColumn("d", F.to_date("d"))
    a = sorted(r.dvf_id for r in P.with_content_id(df, "d", "code", "price").collect())
    monkeypatch.setattr(P, "EXPAND_PIECE", 7)
    b = sorted(r.dvf_id for r in P.with_content_id(df, "d", "code", "price").collect())
    assert a == b and len(a) == len(rows) and len(set(a)) == len(rows)
    assert sum(x.startswith("20200101_75056_1000_") and x.endswith("_2500") for x in a) == 1
    assert sum(x.startswith("20210101_69123_5_") for x in a) == 2 and max(map(len, a)) <= 50


def test_running_totals_of_a_hot_key_use_many_partitions(spark, monkeypatch):
    """A key with most of the rows is summed over several partitions, as one pass would."""
    import random
    from parcelle.operators import ranks
    rng = random.Random(4)
    rows = [("hot", None if i == 0 else i % 50, i, rng.randrange(1, 9)) for i in range(900)]
    rows += [(k, 1, i, 1 + i) for i, k in enumerate(["a", "b", "z", None]) for _ in (0,)] + [("a", 0, 7, 5), (None, 0, 9, 2)]
    rng.shuffle(rows)
    want, total = {}, {}
    for k, a, b, c in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2])):
        want[k, a, b] = total.get(k, 0)
        total[k] = total.get(k, 0) + c
    written = []
    real = ranks.write_once
    monkeypatch.setattr(ranks, "write_once", lambda df, label: written.append(real(df, label)) or written[-1])
    df = spark.createDataFrame(rows, "k string, a int, b int, c long")
    name = "spark.sql.adaptive.coalescePartitions.enabled"     # small partitions would become one
    held = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        got = ranks.running_totals(df, "k", ["a", "b"], "c", "before")
    finally:
        spark.conf.set(name, held)
    assert got.columns == ["k", "a", "b", "c", "before"]
    assert {(r.k, r.a, r.b): r.before for r in got.collect()} == want and got.count() == len(rows)
    hot = written[0].where("k = 'hot'").select(F.shiftright("_t_spot", 33)).distinct().count()
    assert hot > 1
    assert ranks.running_totals(df.where("false"), "k", ["a", "b"], "c", "before").count() == 0


def test_content_ids_survive_new_sales_and_order(spark):
    from parcelle.functions import parse as P
    schema = "d date, code string, price double, area double, note string"
    import datetime
    day = datetime.date(2024, 1, 5)

    def ids(rows):
        return {(r.area, r.dvf_id.rsplit("_", 1)[1]): r.dvf_id
                for r in P.with_content_id(spark.createDataFrame(rows, schema), "d", "code", "price").collect()}

    old = ids([(day, "75056", 200000.0, 50.0, "a|b"), (day, "75056", 200000.0, 80.0, None)])
    new = ids([(day, "75056", 200000.0, 30.0, None), (day, "75056", 200000.0, 80.0, None),
               (day, "75056", 200000.0, 50.0, "a|b"), (day, "75056", 200000.0, 50.0, "a|b")])
    assert all(new[k] == v for k, v in old.items()) and len(set(new.values())) == 4
    assert ids([]) == {}


def test_feature_importance_tree_model(spark):
    df = spark.range(400).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
                                 (F.col("id") * 3.0 + 1).alias("y"))
    spec = M.ModelSpec("rf", "forest", {"numTrees": 5, "maxDepth": 4, "seed": 42, "featureSubsetStrategy": "all"})
    model = M.fit(df, ["a", "b"], spec, label="y")
    imp = M.feature_importance(model, ["a", "b"], 10).collect()
    assert [r.feature for r in imp][0] == "a" and abs(sum(r.importance for r in imp) - 1.0) < 1e-9
    lin = M.fit(df, ["a", "b"], M.ModelSpec("lr", "linear", {}), label="y")
    assert M.feature_importance(lin, ["a", "b"]).count() == 0


def test_predict_price_call(spark):
    df = spark.range(300).select((F.col("id") % 100 + 10).cast("double").alias("surface_reelle_bati"),
                                 (F.col("id") % 5 + 1).cast("double").alias("nb_pieces"),
                                 (F.col("id") % 2 + 1).cast("double").alias("type_local_encoded"),
                                 (F.col("id") % 12 + 1).cast("double").alias("mois"))
    df = df.withColumn("valeur_fonciere", F.col("surface_reelle_bati") * 3000 + F.col("nb_pieces") * 1000)
    feats = ["surface_reelle_bati", "nb_pieces", "type_local_encoded", "mois"]
    model = M.fit(df, feats, M.ModelSpec("lr", "linear", {}))
    out = M.predict_price(model, feats, M.scoring_medians(df, feats), rmse=1000.0, surface=50, nb_pieces=2)
    assert out["prix_predit"] == 152000.0 and out["prix_min"] == 151020.0 and out["prix_max"] == 152980.0
    assert out["prix_m2_estime"] == 3040.0
