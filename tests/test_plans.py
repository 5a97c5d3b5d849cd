"""Physical-plan properties the operators are designed for: column pruning
and filter pushdown into the parquet scan, partial aggregation, partial
per-group limits before the shuffle, map-only spatial probes."""

import re

from pyspark.sql import functions as F

from parcelle.operators import reports as R
from parcelle.operators import spatial
from parcelle.plans.catalog import load_all
from parcelle.sources import tables as T
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _read_schemas(plan: str, table: str) -> list[str]:
    return re.findall(r"Location: [^\n]*" + table + r"\.parquet[^\n]*ReadSchema: (struct<[^\n]*)", plan)


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(load_all()["price_stats"].fn(spark, SF_SMALL))
    orders = _read_schemas(plan, "orders")
    assert orders and all("o_orderstatus" not in s for s in orders)
    lineitem = _read_schemas(plan, "lineitem")
    assert lineitem and all(s.startswith("struct<l_orderkey:bigint,l_quantity:double>") for s in lineitem)


def test_filter_pushed_to_scan(spark):
    df = T.read(spark, SF_SMALL, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan


def test_partial_aggregation_and_group_limit(spark):
    sales = T.sales(spark, SF_SMALL)
    agg_plan = _plan(sales.groupBy("type_local").agg(F.count(F.lit(1))))
    assert "partial_count" in agg_plan
    lim = R.limit_per_group(sales, "type_local", 5, ["date_mutation", "id"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = lim._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_spatial_probe_is_map_only(spark):
    pts = T.sales(spark, SF_SMALL).select("id", "latitude", "longitude")
    out = spatial.count_within_radius(pts, T.poi(spark, SF_SMALL), 5000.0, type_col="type_poi", types=["ecole"])
    plan = _plan(out)
    # broadcast per-cell candidate lists; no per-point re-aggregation of the sales
    assert "BroadcastExchange" in plan and "collect_list" in plan
    shuffled = _plan(spatial.count_within_radius(pts, T.poi(spark, SF_SMALL), 5000.0, max_broadcast_bytes=0))
    per_point = re.compile(r"HashAggregate\(keys=\[_cx[^\]]*, id")
    assert per_point.search(shuffled) and not per_point.search(plan)


def test_bucketed_target_is_not_shuffled(spark, tmp_path):
    from parcelle.operators import link as L
    from parcelle.sources import files as FS
    sales = T.sales(spark, SF_SMALL).select("id", "valeur_fonciere")
    FS.save_bucketed(sales, "parcelle_sales_target", "id", 8, path=str(tmp_path / "target"))
    target = spark.table("parcelle_sales_target")
    incoming = T.sales(spark, SF_SMALL).select("id", "valeur_fonciere").withColumn("load_seq", F.lit(0))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = L.insert_new(target, incoming, "id", order_col="load_seq")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS parcelle_sales_target")
    # the bucketed side is read as is: no exchange directly above its scan
    assert "Bucketed: true" in plan
    assert not re.search(r"Exchange hashpartitioning\(id#\d+L, 8\)[^\n]*\n\s*\+- (\*\(\d+\) )?(ColumnarToRow\n\s*\+- )?FileScan parquet spark_catalog\.default\.parcelle_sales_target", plan)


def test_model_queries_use_the_reference_settings():
    from parcelle.operators import ml
    from parcelle.plans import queries_ml
    assert all(queries_ml.model_named(s.name) is s for s in ml.REFERENCE_MODELS)


def test_lookup_sides_are_measured(spark, monkeypatch):
    from parcelle.operators import link as L
    from parcelle.plans import sizing
    from parcelle.plans.queries_geo import unlinked_sales
    from parcelle.functions import derive as D
    c = T.communes(spark, SF_SMALL)
    sales = D.derive_sales(T.sales(spark, SF_SMALL))
    builds = {"stats": (lambda: L.commune_features(sales.withColumn("distance_centre_ville", F.lit(1.0)), c), ["_cs_id", "_ca_id"]),
              "cascade": (lambda: L.link_cascade(unlinked_sales(spark, SF_SMALL), c), ["_ex_k", "_lt_k", "_pc_k"])}
    want = {}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for bound in (sizing.DEFAULT_MAX_BROADCAST_BYTES, 0):
            monkeypatch.setattr(sizing, "DEFAULT_MAX_BROADCAST_BYTES", bound)
            for name, (build, keys) in builds.items():
                df = build()
                plan = _plan(df)
                for k in keys:
                    line = next(x for x in plan.splitlines() if "Join [" in x and f", [{k}#" in x or f"{k}#" in x and "Join [" in x)
                    assert ("BroadcastHashJoin" in line) == (bound > 0) and ("_lookup_salt" in line) == (bound == 0)
                rows = sorted(map(str, df.select(sorted(df.columns)).collect()))
                assert want.setdefault(name, rows) == rows
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_duplicates_and_new_rows_without_sort_aggregates(spark):
    for name in ("dedupe_sales", "audit_counts", "insert_new", "load_sales"):
        assert "SortAggregate" not in _plan(load_all()[name].fn(spark, SF_SMALL)), name


def test_a_load_parses_and_hashes_its_rows_once(spark):
    from parcelle.plans import pipelines as PL
    from parcelle.plans import queries_clean as Q
    from parcelle.sources import tables as T
    one, two = Q.raw_files(spark, SF_SMALL)
    for raw in (one, two):                                  # rows of a file, not rendered anew in the plan of the load
        assert "Join" not in _plan(raw) and "regexp_replace" not in _plan(raw)
    accepted = PL.load_sales(one, spark.createDataFrame([], "dvf_id string"), T.communes(spark, SF_SMALL)).accepted
    assert "md5" not in _plan(accepted) and accepted.count() > 0
