from collections import Counter

from parcelle.operators.link import insert_new
from parcelle.operators.spatial import count_within_radius


def test_insert_new_keeps_one_row_a_key(spark):
    target = spark.createDataFrame([("a", 1, 1)], "k string, o int, v int")
    new = spark.createDataFrame([("a", 1, 2), ("b", 1, 9), ("b", 1, 3), ("b", 2, 0), ("c", None, 5), ("c", 7, 6), ("d", None, 1), ("d", None, 1)],
                                "k string, o int, v int")
    assert sorted(map(tuple, insert_new(target, new, "k", "o").collect()), key=str) == [("b", 1, 3), ("c", 7, 6), ("d", None, 1)]
    # the order column may be the key itself, as in the loaders
    assert Counter(r.k for r in insert_new(target, new, "k", "k").collect()) == Counter("bcd")


def test_mean_distance_on_both_join_paths(spark):
    points = spark.createDataFrame([(1, 45.0, 1.0), (2, 46.0, 2.0), (3, None, None)], "id int, latitude double, longitude double")
    places = spark.createDataFrame([(45.001, 1.0), (45.002, 1.001), (50.0, 5.0)], "latitude double, longitude double")
    both = [sorted((r.id, r.nb_total, r.km and round(r.km, 9)) for r in count_within_radius(
        points, places, 500.0, mean_km_col="km", max_broadcast_bytes=bound).collect()) for bound in (1 << 20, 0)]
    assert both[0] == both[1] and both[0][0][1] == 2
