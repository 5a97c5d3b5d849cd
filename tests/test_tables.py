"""Row numbers, key rules and merges against plain Python."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parcelle.operators import merge as MG
from parcelle.operators import ml as M
from parcelle.operators.keys import Foreign, Unique, check_keys
from parcelle.operators.ranks import number_rows
from parcelle.plans import queries_tables as Q
from parcelle.sources import tables as T
from tests.conftest import SF_SMALL


def test_numbers_are_exact(spark):
    big = 2 ** 53
    ids = [big + i for i in range(50)] + [None, None, -3] + [7] * 400
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(5)
    out, n = number_rows(df, "id")
    rows = out.orderBy("row_number").collect()
    assert n == len(ids) and [r.row_number for r in rows] == list(range(n))
    assert [r.id for r in rows] == [None, None, *sorted(i for i in ids if i is not None)]
    empty, n = number_rows(df.where("id = 1"), "id")
    assert n == 0 and empty.count() == 0


def test_folds_beyond_doubles(spark):
    base = 2 ** 60
    for n, k in ((23, 5), (3, 5), (10, 2)):
        df = spark.createDataFrame([(base + i,) for i in range(n)] + [(None,)], "id long").repartition(4)
        got = {r.id: r.fold for r in M.contiguous_folds(df, "id", k).collect()}
        want = [f for f in range(k) for _ in range(n // k + (f < n % k))]
        assert got.pop(None) is None and [got[base + i] for i in range(n)] == want


def test_key_rules(spark):
    rows = [(1, "a", 1), (2, "a", 2), (3, None, None), (4, None, 9), (5, "b", 1), (5, "b", 1), (6, "z", 1)] + [(100 + i, "hot", 2) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, code string, place int").repartition(7)
    stored = spark.createDataFrame([("z",), ("z",), (None,)], "code string")
    places = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    out = check_keys(df, [Unique("taken", ["code"], stored, "stored")], [Foreign("unknown", "place", places)], order=["id"])
    assert out.columns == ["id", "code", "place", "key_reasons"]
    got = Counter((r.id, r.code, r.place, tuple(r.key_reasons)) for r in out.collect())
    want = Counter()
    seen = set()
    for i, c, p in sorted(rows, key=lambda x: x[0]):
        why = [x for x, bad in (("taken", c in seen), ("stored", c == "z"), ("unknown", p is not None and p not in (1, 2))) if bad]
        seen |= {c} - {None}
        want[(i, c, p, tuple(why))] += 1
    assert got == want
    assert check_keys(df.limit(0), [Unique("taken", ["code"])]).count() == 0


def test_every_constraint_is_broken_somewhere(spark):
    said = Counter(x for r in Q.q_constraint_rejects(spark, SF_SMALL).collect() for x in r.reasons.split(","))
    assert set(said) == {"date_missing", "price_missing", "price_not_positive", "type_missing", "area_not_positive", "land_out_of_range",
                         "month_out_of_range", "quarter_out_of_range", "weekday_out_of_range", "score_out_of_range", "rooms_out_of_range",
                         "build_year_out_of_range", "dvf_id_taken", "dvf_id_stored", "commune_unknown"}


@pytest.fixture
def communes(spark, tmp_path):
    path = str(tmp_path / "communes")
    df = T.communes(spark, SF_SMALL).withColumns({"updated_at": F.lit("2020-01-01").cast("timestamp"), "revenu_median": F.lit(1.5)})
    MG.create_table(df, path, "code_commune", 8)
    return path, {r.code_commune: r for r in df.collect()}


def files_of(spark, path):
    return {(r[0], r[1]) for r in spark.read.parquet(path).select(MG.BUCKET, F.input_file_name()).distinct().collect()}


def test_refresh_communes(spark, communes, monkeypatch):
    monkeypatch.setattr(MG.merge_table, "__defaults__", (8, None))
    path, before = communes
    files = files_of(spark, path)
    payload = json.dumps([{"nom": "Nouvelle", "code": "99999", "codesPostaux": [], "population": 10, "surface": 0, "centre": {"coordinates": [2.0, 48.0]}},
                          {"nom": "Autre", "code": "99990", "population": 30, "surface": 300.0},
                          {"nom": "Renommee", "code": "00001", "codesPostaux": ["01000"], "population": None, "surface": 250.0},
                          {"nom": "Sans code", "code": None}])
    answers = spark.createDataFrame([(payload,), (payload,)], "payload string")
    for turn in range(2):                                    # run again: the same table
        out = {r.code_commune: r for r in MG.refresh_communes(spark, path, answers, "2024-06-01 00:00:00").collect()}
        rows = {r.code_commune: r for r in MG.read_table(spark, path).collect()}
        assert set(rows) == {*before, "99999", "99990"} and MG.read_table(spark, path).count() == len(rows)
        top = max(r.id for r in before.values())
        assert (rows["99990"].id, rows["99999"].id) == (top + 1, top + 2)
        assert out["99999"].row_source == ("updated" if turn else "inserted") and out["00001"].row_source == "updated"
        assert rows["99999"].code_postal is None and rows["99999"].superficie_km2 is None and rows["99999"].latitude == 48.0
        assert rows["99990"].densite_pop == 10.0 and rows["99990"].revenu_median is None
        # without a population the density is not computed anew
        assert rows["00001"].population is None and rows["00001"].superficie_km2 == 2.5 and rows["00001"].densite_pop == before["00001"].densite_pop
        assert rows["00001"].updated_at.year == 2024 and rows["00001"].revenu_median == 1.5 and rows["00001"].id == before["00001"].id
        others = set(before) - {"00001"}
        assert all(tuple(rows[c]) == tuple(before[c]) for c in others)
    touched = {r[0] for r in spark.createDataFrame([("99999",), ("99990",), ("00001",)], "c string").select(MG.bucket_of("c", 8)).collect()}
    now = files_of(spark, path)
    assert {f for f in files if f[0] not in touched} == {f for f in now if f[0] not in touched} and len(touched) < 8


def test_link_waiting_rewrites_only_its_years(spark, tmp_path):
    path = str(tmp_path / "sales")
    df = spark.createDataFrame([(1, 2020, None, "A"), (2, 2020, 5, "A"), (3, 2021, None, "X"), (4, 2021, 8, None), (5, 2022, None, "B"), (6, 2022, None, None)],
                               "id long, annee int, commune_id long, code_commune string")
    df.repartition("annee").write.partitionBy("annee").parquet(path)
    before = {(r[0], r[1]) for r in spark.read.parquet(path).select("annee", F.input_file_name()).collect()}
    places = spark.createDataFrame([(10, "A"), (11, "A"), (12, "B"), (13, None)], "id long, code_commune string")
    linked = MG.link_waiting(spark, path, places)
    assert sorted((r.id, r.commune_id) for r in linked.collect()) == [(1, 10), (5, 12)]
    assert {r.id: r.commune_id for r in spark.read.parquet(path).collect()} == {1: 10, 2: 5, 3: None, 4: 8, 5: 12, 6: None}
    after = {(r[0], r[1]) for r in spark.read.parquet(path).select("annee", F.input_file_name()).collect()}
    assert {f for f in before if f[0] == 2021} == {f for f in after if f[0] == 2021} and len(before & after) == 1
    assert MG.link_waiting(spark, path, places).count() == 0
