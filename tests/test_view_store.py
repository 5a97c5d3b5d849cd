"""Stored views: equal to the full ones after appends and removals, other months untouched."""

import datetime as dt
import os

from pyspark.sql import functions as F

from parcelle.operators import marts
from parcelle.operators import view_store as VS

SCHEMA = "id long, date_mutation date, commune_id long, type_local string, valeur_fonciere double, prix_m2 double"


def sales_rows(spark):
    day = dt.date(2020, 1, 1)
    rows = [(i, day + dt.timedelta(days=(i * 37) % 500), (i * 7) % 4 if i % 11 else None, "AB"[i % 2] if i % 13 else None,
             None if i % 17 == 0 else 1000.0 * (i % 29) + 0.25, None if i % 19 == 0 else float((i * i) % 31 + (0 if i % 5 else 0.5))) for i in range(900)]
    rows += [(1000, None, 1, "A", 5.0, 2.0), (1001, None, 2, None, None, 3.0), (1002, day, 9, "A", 5.0, 2.0)]
    return spark.createDataFrame(rows, SCHEMA)


def rounded(df):
    cols = sorted(df.columns)
    return sorted(str(tuple(round(float(v), 6) if isinstance(v, float) or "Decimal" in type(v).__name__ else v for v in r)) for r in df.select(cols).collect())


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_refresh_equals_full_views(spark, tmp_path):
    communes = spark.createDataFrame([(0, "c0", "same", "d", "r"), (1, "c1", "n1", "d", "r"), (2, "c2", "same", "d", "r"), (3, "c3", "n3", "e", None)],
                                     "id long, code_commune string, nom_commune string, departement string, region string")
    sales, path = sales_rows(spark), str(tmp_path / "views")

    def same(now):
        a, b = VS.price_stats(spark, path, communes, "2021-05-10", 12), marts.price_stats(now, communes, "2021-05-10", 12)
        assert rounded(a) == rounded(b.withColumn("prix_moyen", F.col("prix_moyen").cast("double")))
        assert rounded(VS.monthly_trends(spark, path, communes)) == rounded(marts.monthly_trends(now, communes))

    late = (F.col("id") % 5 == 0) & F.col("date_mutation").between("2020-11-10", "2021-01-20") | (F.col("id") == 1001)
    first = sales.where(~F.coalesce(late, F.lit(False)))
    VS.create(first, path)
    same(first)
    before = files(path)
    assert VS.refresh(sales, path, sales.where(late)) == ["2020-11", "2020-12", "2021-01", "none"]
    same(sales)
    gone = {f.split("_month=")[1].split("/")[0] for f in before - files(path)}
    assert gone <= {"2020-11", "2020-12", "2021-01", "none"} and len(gone) > 2
    # a month without sales any more, and nothing to do
    left = sales.where(F.coalesce(F.date_format("date_mutation", "yyyy-MM") != "2021-02", F.lit(True)))
    assert VS.refresh(left, path, sales.where("date_mutation BETWEEN '2021-02-01' AND '2021-02-28'")) == ["2021-02"]
    same(left)
    assert VS.refresh(left, path, sales.where("false")) == []


def test_weighted_quantiles(spark):
    from parcelle.operators.quantiles import quantiles
    df = spark.range(400).select((F.col("id") % 3).alias("g"), ((F.col("id") * 31) % 17).cast("double").alias("v"), (F.col("id") % 5 + 1).alias("w"))
    many = df.withColumn("x", F.explode(F.sequence(F.lit(1).cast("long"), "w")))
    want = {"v": {"a": 0.25, "b": 0.5, "c": 0.9}}
    assert sorted(quantiles(df, ["g"], want, weight="w").collect()) == sorted(quantiles(many, ["g"], want).collect())
