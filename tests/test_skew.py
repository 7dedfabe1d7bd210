"""The hot-key helpers give the same rows as a plain join, and their bounds hold."""

import random

import pytest
from pyspark.sql import functions as F

from closure_engine.operators import skew


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_equals_plain_join(spark, how):
    rnd = random.Random(5)
    # key 0 holds most rows; some keys have no match on the small side
    big = [(0, i) for i in range(300)] + [(rnd.randrange(1, 40), i) for i in range(300, 500)]
    small = [(k, k * 10) for k in range(0, 35)]
    b = spark.createDataFrame(big, "k bigint, x bigint")
    s = spark.createDataFrame(small, "k bigint, y bigint")
    freq = b.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = skew.hot_keys(freq, "k", "n", max_hot=4, min_rows=50)
    assert [r.k for r in hot.collect()] == [0]
    got = skew.split_join(b, s, "k", skew.hot_lookup(s, "k", hot), how)
    want = b.join(s, "k", how)
    assert sorted(map(tuple, got.select("k", "x", "y").collect()), key=repr) == \
        sorted(map(tuple, want.select("k", "x", "y").collect()), key=repr)
    lookup = skew.skew_safe_lookup(b, s, "k", how, max_hot=4, min_rows=50)
    assert lookup.count() == want.count()


def test_hot_keys_bound(spark):
    # 1000 keys with equal counts: the threshold total/max_hot admits at most max_hot keys
    df = spark.createDataFrame([(k, 7) for k in range(1000)], "k bigint, n bigint")
    for max_hot in (1, 10, 999, 5000):
        assert skew.hot_keys(df, "k", "n", max_hot=max_hot, min_rows=1).count() <= max_hot


def test_salts(spark):
    df = spark.createDataFrame([(0,), (65535,), (65536,), (3 * 65536 + 5,)], "d bigint")
    got = [r.s for r in df.select(skew.n_salts(F.col("d")).alias("s")).collect()]
    assert got == [1, 1, 2, 4]


def test_salted_join_equals_plain_join(spark, monkeypatch):
    monkeypatch.setattr(skew, "SPLIT_ROWS", 20)
    rows = [(0, i) for i in range(300)] + [(k % 40, 1000 + k) for k in range(200)]
    big = spark.createDataFrame(rows, "k bigint, x bigint")
    small = spark.createDataFrame([(k, "v" * k) for k in range(35)], "k bigint, label string")
    salts = big.groupBy(F.col("k").alias("id")).agg(skew.n_salts(F.count("*"), 20).alias("_salts")).where("_salts > 1")
    assert salts.count() == 1
    got = skew.salted_join(big, small, "k", salts)
    want = big.join(small, "k", "left")
    assert sorted(map(tuple, got.select("k", "x", "label").collect()), key=repr) == sorted(map(tuple, want.select("k", "x", "label").collect()), key=repr)


def test_wide_attributes_are_not_broadcast(spark):
    from closure_engine import triplet_view

    edges = spark.createDataFrame([(0, i) for i in range(1, 30)], "src bigint, dst bigint")
    labels = spark.createDataFrame([(i, f"name {i}") for i in range(25)], "id bigint, label string")
    got = {(r.src, r.dst): (r.src_label, r.dst_label) for r in triplet_view(edges, labels).collect()}
    assert len(got) == 29 and got[0, 3] == ("name 0", "name 3") and got[0, 27] == ("name 0", None)
