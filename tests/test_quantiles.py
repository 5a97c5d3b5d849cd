"""Exact quantiles against Spark's exact percentile aggregate."""

import math
import random

from pyspark.sql import functions as F

from parcelle.operators import quantiles as Q
from parcelle.operators import reports as R

PROBS = {"p0": 0.0, "p25": 0.25, "p33": 0.33, "p50": 0.5, "p90": 0.9, "p100": 1.0}


def plain(values, p):
    v = sorted(x for x in values if x is not None and not math.isnan(x))
    if not v:
        return None
    pos = p * (len(v) - 1)
    lo, hi = math.floor(pos), math.ceil(pos)
    return v[lo] if lo == hi or v[lo] == v[hi] else (hi - pos) * v[lo] + (pos - lo) * v[hi]


def awkward():
    rnd = random.Random(7)
    groups = {
        "wide": [rnd.choice([-1, 1]) * 10 ** rnd.uniform(-300, 300) for _ in range(200)], "near": [1.0 + i * 2 ** -52 for i in range(90)],
        "hot": [rnd.choice([5.0, 7.5, 7.25, -2.0]) for _ in range(3000)], "zero": [0.0, -0.0, 0.0, -1e-320, 1e-320, 5e-324], "one": [3.5],
        "inf": [math.inf, 1.0, -math.inf, math.inf], "none": [None, math.nan], "some": [None, 2.0, math.nan, 4.0], None: [1.0, 2.0, 9.0],
        "money": [round(rnd.uniform(1e4, 1e7), 2) for _ in range(500)],
    }
    return [(g, v, None if v is None else -v) for g, vs in groups.items() for v in vs], groups


def test_quantiles_are_exact(spark):
    rows, groups = awkward()
    df = spark.createDataFrame(rows, "g string, v double, w double").repartition(7)
    out = Q.quantiles(df, ["g"], {"v": PROBS, "w": {"w50": 0.5}})
    got = {r.g: tuple(r)[1:] for r in out.collect()}
    for g, vs in groups.items():
        want = (*[plain(vs, p) for p in PROBS.values()], plain([None if v is None else -v for v in vs], 0.5))
        if want[0] is None:
            assert g not in got
        else:
            assert all(a == b or math.isnan(a) and math.isnan(b) for a, b in zip(got[g], want)), (g, got[g], want)


def test_quantiles_of_the_whole_frame(spark):
    df = spark.range(10000).withColumn("v", (F.col("id") * 7919 % 10000).cast("double"))
    assert Q.group_quantiles(df, [], "v", {"m": 0.5, "q": 0.33}).first().asDict() == {"m": 4999.5, "q": 0.33 * 9999}
    assert Q.column_quantiles(df, ["v", "id"]).first().asDict() == {"v": 4999.5, "id": 4999.5}
    assert Q.column_quantiles(df.where("id < 0"), ["v"]).first().v is None
    two = df.withColumn("a", (F.col("id") % 3).cast("int")).withColumn("b", F.when(F.col("id") % 2 == 0, "x"))
    want = {(r.a, r.b): r.m for r in two.groupBy("a", "b").agg(F.percentile("v", 0.5).alias("m")).collect()}
    assert {(r.a, r.b): r.m for r in Q.group_quantiles(two, ["a", "b"], "v", {"m": 0.5}).collect()} == want


def test_no_job_while_the_plan_is_built(spark):
    df = spark.range(100).selectExpr("id % 3 as g", "cast(id as double) v", "cast(id as double) w")
    sc = spark.sparkContext
    sc.setJobGroup("build", "build")
    R.describe(df, ["v", "w"])
    R.boxplot(df, "g", "v")
    R.group_stats(df, ["g"], ["v", "w"])
    R.price_bands(df, "v")
    jobs = sc.statusTracker().getJobIdsForGroup("build")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_a_hot_group_is_reduced_before_it_meets(spark):
    """The only shuffle of values is by (group, value); what a task sees of a group
    after it are counts of cells and values."""
    df = spark.range(200_000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) g", "cast(id % 1000 as double) v")
    assert Q.group_quantiles(df.where("g = 'hot'"), ["g"], "v", {"m": 0.5}).first().m == plain([float(i % 1000) for i in range(0, 200_000, 3)], 0.5)
