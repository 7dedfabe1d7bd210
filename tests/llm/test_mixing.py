"""Mixing: targets against plain resharing, and what the rounding promises."""

import re
from collections import defaultdict

from pyspark.sql import functions as F

from closure_engine.llm.mixing import mix_sources, source_targets, take_copies

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    capped = {}
    while True:
        free = [n for n in names if n not in capped]
        left = sum(sizes.values()) - sum(capped.values())
        share = {n: left * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n: 3 * sizes[n] for n in free if share[n] > 3 * sizes[n]}
        if not over:
            return share | capped
        capped |= over


def check(docs):
    texts = [(r["doc_id"], r["source"], len(WORD.findall(r["text"] or ""))) for r in docs.collect()]
    rows = mix_sources(docs).collect()
    assert sorted(map(str, ((r["doc_id"], r["source"], r["size"]) for r in rows))) == sorted(map(str, texts))
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, s, n in texts:
        sizes[s] += n
        largest[s] = max(largest[s], n)
    want = plain_targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) <= 1e-9 * max(1, want[r["source"]])
        assert 0 <= r["copies"] <= 3 and (r["size"] > 0 or r["copies"] == 0)
        taken[r["source"]] += r["copies"] * r["size"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    return rows


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = check(docs)
    assert sorted(rows) == sorted(mix_sources(docs.repartition(5)).collect())


def test_awkward_documents(odd):
    check(odd)


def test_many_documents_of_one_source(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', int(1 + id % 9))").alias("text"),
                                      F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    copies = defaultdict(list)
    for r in check(docs):
        if r["source"] == "hot":
            copies[r["size"]].append(r["copies"] - r["target"] / r["source_size"])
    assert len(copies) == 6 and all(abs(sum(x) / len(x)) < 0.06 for x in copies.values())  # no size is preferred


def test_copies_of_rows(odd):
    mixed = mix_sources(odd)
    copies = defaultdict(int)
    for r in mixed.collect():
        copies[r["doc_id"]] = max(copies[r["doc_id"]], r["copies"])
    out = take_copies(odd, mixed)
    assert out.columns == odd.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r["doc_id"]] += 1
    rows = defaultdict(int)
    for r in odd.collect():
        rows[r["doc_id"]] += 1
    assert dict(got) == {i: n * copies[i] for i, n in rows.items() if copies[i]}


def test_empty_and_wordless(none, odd):
    assert mix_sources(none).count() == 0
    silent = mix_sources(odd.where("text is null or text = ''")).collect()
    assert silent and all(r["target"] == 0 and r["copies"] == 0 for r in silent)


def test_targets_share_all(spark):
    rows = spark.createDataFrame([("a", 10), ("b", 1000), (None, 5), ("c", 3)], "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(rows).collect()}
    want = plain_targets({"a": 10, "b": 1000, None: 5, "c": 3})
    assert all(abs(got[s] - want[s]) < 1e-9 for s in want) and abs(sum(got.values()) - 1018) < 1e-9


def test_one_row_repeated_many_times(spark):
    """Equal rows fall in different cells, none of which grows with their number."""
    docs = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("doc_id"),
                                      F.when(F.col("id") % 3 == 0, F.expr("repeat('w ', int(1 + id % 9))")).otherwise("a b c").alias("text"),
                                      F.when(F.col("id") % 3 == 0, F.concat(F.lit("s"), F.col("id") % 7)).otherwise("hot").alias("source"))
    rows = check(docs)
    hot = [r["copies"] for r in rows if r["doc_id"] == -1]
    assert len(hot) == 26_666 and abs(sum(hot) * 3 - next(r["target"] for r in rows if r["doc_id"] == -1)) <= 3
