"""Property tests: the parsing expressions against a small Python model, on
many generated strings evaluated in one Spark job each."""

from hypothesis import given, settings
from hypothesis import strategies as st

from parcelle.functions import parse as P

NUM_TEXT = st.text(alphabet="0123456789., -", max_size=12)
CODE_TEXT = st.text(alphabet="0123456789.A ", max_size=6)


def _number_model(s):
    t = s.replace(",", ".").replace(" ", "")
    try:
        v = float(t)
    except ValueError:
        return None
    return None if v != v else v


def _strip(s):
    t = s.strip(" ")
    return t[:-2] if t.endswith(".0") else t


def _pad(s, n):
    return s if len(s) >= n else s.rjust(n, "0")


def _code_model(dept, num):
    d, n = _pad(_strip(dept), 2), _pad(_strip(num), 3)
    return d + n[-2:] if len(d) == 3 else d + n


@settings(max_examples=5, deadline=None)
@given(st.lists(NUM_TEXT, min_size=50, max_size=80))
def test_parse_number_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r.i: r.v for r in df.select("i", P.parse_number("s").alias("v")).collect()}
    for i, v in enumerate(values):
        assert got[i] == _number_model(v), (v, got[i])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(CODE_TEXT, CODE_TEXT), min_size=50, max_size=80))
def test_commune_code_model(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, d string, c string")
    got = {r.i: r.v for r in df.select("i", P.commune_code("d", "c").alias("v")).collect()}
    for i, (a, b) in enumerate(pairs):
        assert got[i] == _code_model(a, b), (a, b, got[i])


def _contains_model(ring, x, y):
    inside = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            inside = not inside
        cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        if cross == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return False
    return inside


COORD = st.integers(min_value=0, max_value=40).map(lambda v: v / 4.0)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(COORD, COORD), min_size=3, max_size=7),
       st.lists(st.tuples(COORD, COORD), min_size=30, max_size=60))
def test_ring_contains_model(spark, vertices, points):
    from parcelle.functions import geo as G
    ring = vertices + [vertices[0]]
    rows = [(i, [{"lon": a, "lat": b} for a, b in ring], x, y) for i, (x, y) in enumerate(points)]
    df = spark.createDataFrame(rows, "i int, ring array<struct<lon:double,lat:double>>, x double, y double")
    got = {r.i: r.c for r in df.select("i", G.ring_contains("ring", "x", "y").alias("c")).collect()}
    for i, (x, y) in enumerate(points):
        assert got[i] == _contains_model(ring, x, y), (ring, x, y)
