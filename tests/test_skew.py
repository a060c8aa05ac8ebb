"""Joins with hot keys."""

from collections import Counter

import pytest

from kinora.operators.skew import salted_join
from kinora.plans import usercf


@pytest.mark.parametrize("rows_per_key", [1, 7, 50_000])
def test_salted_join_equals_a_join(spark, rows_per_key):
    left = [(i % 40 if i % 3 else 1, i) for i in range(300)] + [(None, 1), (77, 2), (1, 5), (1, 5)]
    right = [(k, f"r{k}{j}") for k in range(40) for j in range(k % 4)] + [(None, "x"), (88, "y")]
    a, b = spark.createDataFrame(left, "k int, a int"), spark.createDataFrame(right, "k int, b string")
    got = Counter(tuple(r) for r in salted_join(a, b, "k", rows_per_key).select("k", "a", "b").collect())
    assert got == Counter((k, x, y) for k, x in left for j, y in right if k is not None and k == j)


def test_a_hot_key_is_spread(spark):
    left = spark.createDataFrame([(1, i) for i in range(2000)], "k int, a int")
    right = spark.createDataFrame([(1, "r")], "k int, b string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = [len(p) for p in salted_join(left, right, "k", 100).rdd.glom().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(parts) == 2000 and max(parts) < 1200


def test_somebody_near_to_all(spark):
    rows = [(0, m, 5.0, 1) for m in range(30)] + [(u, m, 5.0, 1) for u in range(1, 60) for m in (u % 30, (u + 1) % 30)]
    ratings = spark.createDataFrame(rows, "uid int, mid int, score double, timestamp int")
    recs = usercf.recommend(ratings)
    assert recs.where("uid > 0").select("uid").distinct().count() == 59
    assert recs.join(ratings, ["uid", "mid"]).count() == 0
