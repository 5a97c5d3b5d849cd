"""Incremental loading: a second stream run over an overlapping file appends
only sales it has not seen (conflict skip), and a run with nothing new adds
nothing."""

import os
import tempfile

from parcelle.streaming.incremental import incremental_load

COLS = ["date_mutation", "valeur_fonciere", "code_departement", "code_commune", "code_postal",
        "surface_reelle_bati", "nb_pieces", "type_local"]


def _write(folder, name, rows):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("|".join(COLS) + "\n")
        for r in rows:
            f.write("|".join(r) + "\n")


def test_incremental_load_skips_known_sales(spark):
    base = tempfile.mkdtemp(prefix="parcelle-stream-")
    landing, target, ckpt = (os.path.join(base, x) for x in ("landing", "target", "ckpt"))
    os.makedirs(landing)
    a = ("05/01/2023", "250000,50", "75", "117", "75011", "45", "2", "Appartement")
    b = ("2023-02-01", "310000", "69", "123", "69003", "70", "3", "Maison")
    c = ("2023-03-10", "99000", "13", "55", "13001", "30", "1", "Appartement")
    _write(landing, "ventes_2023a.csv", [a, b])
    incremental_load(spark, landing, target, ckpt, COLS)
    assert spark.read.parquet(target).count() == 2
    _write(landing, "ventes_2023b.csv", [b, c, c])  # b already loaded; c twice = two distinct sales
    incremental_load(spark, landing, target, ckpt, COLS)
    ids = [r.dvf_id for r in spark.read.parquet(target).collect()]
    assert len(ids) == 4 and len(set(ids)) == 4
    incremental_load(spark, landing, target, ckpt, COLS)
    assert spark.read.parquet(target).count() == 4
