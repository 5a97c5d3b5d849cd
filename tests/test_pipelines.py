"""Loading a raw sale file end to end (E6): BOM and original headers (S2, P1),
lenient parsing, commune lookup (J1), constraint rejects (S15), insert-new
against the target (S8), test-mode row limit (S3), newest-file pick (S4)."""

import os
import tempfile

from parcelle.plans import pipelines as PL
from parcelle.sources import files as FS

HEADER = ["Date mutation", "Nature mutation", "Valeur fonciere", "Code postal", "Commune", "Code departement",
          "Code commune", "Type local", "Surface reelle bati", "Nombre pieces principales"]
ROWS = [
    ["05/01/2023", "Vente", "250000,50", "75011.0", "PARIS 11", "75", "111", "Appartement", "45", "2"],
    ["2023-01-25", "Vente", "1 250 000,00", "69003", "LYON 3", "69", "383", "Maison", "120", "5"],
    ["31/02/2023", "Vente", "100000", "13001", "MARSEILLE", "13", "201", "Appartement", "30", "1"],
    ["2023-03-01", "Vente", "180000", "33000", "BORDEAUX", "33", "63", None, "50", "2"],
    ["2023-03-02", "Vente", "-5", "59000", "LILLE", "59", "350", "Maison", "80", "3"],
]


def _write(path, rows, bom=True):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write("|".join(HEADER) + "\n")
        for r in rows:
            f.write("|".join("" if v is None else v for v in r) + "\n")


def test_load_sales_file(spark):
    d = tempfile.mkdtemp(prefix="parcelle-load-")
    _write(os.path.join(d, "ventes_2022.csv"), ROWS[:1])
    _write(os.path.join(d, "ventes_2023.csv"), ROWS)
    newest = FS.newest_file(spark, [os.path.join(d, "nothing_*.csv"), os.path.join(d, "ventes_*.csv")])
    assert newest.endswith("ventes_2023.csv")
    communes = spark.createDataFrame([(1, "75111"), (2, "69383")], "id long, code_commune string")
    target = spark.createDataFrame([], "dvf_id string")
    res = PL.load_sales_file(spark, newest, target, communes)
    got = {r.code_commune: r for r in res.accepted.collect()}
    # invalid date (31/02) and negative price are dropped by the parser's NULL rules
    assert set(got) == {"75111", "69383"}
    assert got["75111"].valeur_fonciere == 250000.5 and got["75111"].commune_id == 1
    assert got["69383"].valeur_fonciere == 1250000.0 and got["69383"].code_postal == "69003"
    # the row without a type passes the parser but breaks the table rule (T3: rejected alone, with its reason)
    rejected = {r.code_commune: (list(r.reject_reasons), r.commune_id) for r in res.rejected.collect()}
    assert rejected == {"33063": (["type_missing"], None)}
    # reloading: every content id is known now -> nothing new
    again = PL.load_sales_file(spark, newest, res.accepted.select("dvf_id"), communes)
    assert again.accepted.count() == 0
    limited = PL.load_sales_file(spark, newest, target, communes, max_rows=2)
    assert limited.accepted.count() <= 2


def test_views_and_summary(spark):
    from pyspark.sql import functions as F
    from parcelle.sources import tables as T
    from parcelle.plans.queries_core import AS_OF
    from tests.conftest import SF_SMALL
    communes = T.communes(spark, SF_SMALL)
    sales = T.sales(spark, SF_SMALL)
    from parcelle.functions import derive as D
    lst = T.listings(spark, SF_SMALL).withColumn("prix_m2", D.listing_price_m2("prix_affiche", "surface_habitable"))
    views = PL.warehouse_views(D.derive_sales(sales), communes, T.quartiers(spark, SF_SMALL), lst,
                               T.poi(spark, SF_SMALL), AS_OF)
    assert set(views) == {"vw_price_stats", "vw_monthly_trends", "vw_quartier_analysis"}
    assert views["vw_quartier_analysis"].count() == 25
    base = tempfile.mkdtemp(prefix="parcelle-views-")
    for name, df in views.items():  # S13: refresh = recompute and overwrite
        FS.save_view(df, name, path=os.path.join(base, name))
        FS.save_view(df, name, path=os.path.join(base, name))
    assert spark.table("vw_price_stats").count() == views["vw_price_stats"].count()
    for name in views:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    enriched = PL.enrich_sales(sales.withColumn("commune_id", F.lit(None).cast("long")), communes)
    summary = {r.state: r for r in PL.run_summary(sales, enriched).collect()}
    assert summary["before"].total == summary["after"].total
    assert summary["after"].with_commune >= summary["before"].with_commune - summary["before"].total


def test_bad_bytes_replaced(spark):
    d = tempfile.mkdtemp(prefix="parcelle-bytes-")
    path = os.path.join(d, "ventes.txt")
    with open(path, "wb") as f:
        f.write("Commune|Valeur fonciere\n".encode("utf-8") + b"Saint-\xe9tienne|1000,5\n")
    r = FS.read_delimited(spark, path).first()
    assert r["Commune"] == "Saint-�tienne" and r["Valeur fonciere"] == "1000,5"


def test_warehouse_written_once_and_pruned(spark):
    from parcelle.functions import derive as D
    from parcelle.operators import marts
    from parcelle.plans.queries_core import AS_OF
    from parcelle.sources import tables as T
    from tests.conftest import SF_SMALL
    out = tempfile.mkdtemp(prefix="parcelle-wh-")
    PL.build_warehouse(spark, SF_SMALL, out)
    wh = PL.read_warehouse(spark, out)
    a = marts.price_stats(wh["sales"], wh["communes"], AS_OF)
    b = marts.price_stats(D.derive_sales(T.sales(spark, SF_SMALL)), T.communes(spark, SF_SMALL), AS_OF)
    key = lambda r: (r.code_commune, r.type_local)
    ra, rb = sorted(a.collect(), key=key), sorted(b.collect(), key=key)
    assert len(ra) == len(rb) and all(x.nb_ventes == y.nb_ventes for x, y in zip(ra, rb))
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(annee" in plan and "(annee#" in plan
