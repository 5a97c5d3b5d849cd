from pyspark.sql import functions as F

from parcelle.plans.sizing import broadcast_if_small, estimated_bytes


def test_size_check_gives_and_withholds_the_hint(spark):
    small, big = spark.range(10), spark.range(1000).withColumnRenamed("id", "k")
    assert 0 < estimated_bytes(small) < 10_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def plan(bound):
            j = big.join(broadcast_if_small(small, bound), F.col("k") == F.col("id"))
            return j._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=broadcast" in plan(1 << 20)
        assert "strategy=broadcast" not in plan(1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
