"""Sharding: equal texts together, sizes near equal, slots without gaps."""

import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from closure_engine.llm.sharding import difference, difference_groups, shard_documents


def check(docs, shards=40, **settings):
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = shard_documents(docs, shards, **settings).collect()
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    slots, sums, groups = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in rows:
        assert 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
        sums[r["shard"]] += r["size"]
        if r["size"] > 16:
            groups[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(len(x) == 1 for x in groups.values())
    return sums


def test_given_documents(spark, sf, given):
    sizes = defaultdict(int)
    for t in given.values():
        sizes[t] += len((t or "").encode()) + 16
    sums = check(spark.read.parquet(f"{sf}/documents.parquet"), 10)
    assert max(sums.values()) - min(sums.values()) <= max(sizes.values())


def test_even_sizes(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat(string(id), int(1 + id * 7 % 100))").alias("text"))
    sums = check(docs, 40)
    mean = sum(sums.values()) / 40
    assert len(sums) == 40 and max(sums.values()) < 1.002 * mean and min(sums.values()) > 0.998 * mean


def test_levels(spark, monkeypatch):
    monkeypatch.setattr("closure_engine.llm.sharding.FAN", 2)
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.expr("repeat('y', int(1 + id * 7 % 1000))").alias("text"))
    sums = check(docs, 8)
    assert max(sums.values()) < 1.05 * min(sums.values())


def test_awkward_documents(odd):
    check(odd, 4)


def test_empty_table(none):
    assert shard_documents(none).count() == 0


def test_differencing_keeps_sums():
    r = np.random.default_rng(1)
    sums = r.integers(0, 1000, (30, 5))
    where = difference(sums)
    assert all(sorted(w) == [0, 1, 2, 3, 4] for w in where)
    total = np.bincount(where.reshape(-1), sums.reshape(-1), 5)
    assert total.sum() == sums.sum() and np.ptp(total) < 200


def test_differencing_textbook_case():
    part = difference_groups(np.array([8, 7, 6, 5, 4]), 2)
    total = np.bincount(part, [8, 7, 6, 5, 4], 2)
    assert sorted(total) == [14, 16]  # Karmarkar and Karp's own result for these numbers


def test_differencing_many_groups():
    sizes = np.random.default_rng(2).integers(1, 10_000, 700)
    total = np.bincount(difference_groups(sizes, 40), sizes, 40)
    assert total.sum() == sizes.sum() and np.ptp(total) < 0.01 * total.mean()


def test_buckets_follow_the_groups(spark, monkeypatch):
    """Several leaves and levels, the same shards whatever the session's number of partitions."""
    monkeypatch.setattr("closure_engine.llm.sharding.FAN", 2)
    monkeypatch.setattr("closure_engine.llm.sharding.LEAF", 150)
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.expr("repeat('y', int(1 + id * 7 % 1000))").alias("text"))
    sums = check(docs, 8)
    assert max(sums.values()) < 1.05 * min(sums.values())
    one = sorted(shard_documents(docs, 8).collect())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    assert sorted(shard_documents(docs, 8).collect()) == one
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_row_repeated_many_times(spark):
    docs = spark.range(100_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("doc_id"),
                                       F.when(F.col("id") % 3 == 0, F.concat(F.lit("t"), "id")).otherwise("copy").alias("text"))
    rows = shard_documents(docs, 5)
    got = rows.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("top")).collect()
    assert all(r["n"] == r["d"] == r["top"] + 1 for r in got) and sum(r["n"] for r in got) == 100_000
    assert rows.where("doc_id = -1").select("shard").distinct().count() == 1
