"""Toxicity: Kneser-Ney probabilities against plain sums, and held-out accuracy."""

import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa

from closure_engine.llm import common
from closure_engine.llm import toxicity as toxicity_module
from closure_engine.llm.toxicity import KneserNeyPair, evidence, toxicity, word_grams
from closure_engine.llm.rolling import LETTERS, Texts
from closure_engine.llm.common import string_buffers

BAD = ["grumpfel", "snorkwit", "blathrax"]


def corpus(n, seed):
    r = random.Random(seed)
    words = ["".join(r.choice("aeionrstl") for _ in range(r.randint(2, 8))) for _ in range(500)]
    docs, labels = [], []
    for i in range(n):
        toxic = r.random() < 0.3
        text = [r.choice(words) for _ in range(r.randint(20, 80))]
        if toxic:
            for _ in range(3):
                text[r.randrange(len(text))] = r.choice(BAD) + r.choice(["", "a", "en", "s!"])
        docs.append((i, " ".join(text).title() if i % 4 == 0 else " ".join(text), "x"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id long, text string, toxic string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = corpus(1500, 1)
    rows = {r["doc_id"]: r for r in toxicity(*frames(spark, docs, labels)).collect()}
    assert len(rows) == len(docs)
    right = n = 0
    for i, _, toxic in labels:
        assert rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= rows[i]["score"] <= 1 and rows[i]["predicted"] == int(rows[i]["score"] >= 0.5)
        if rows[i]["held_out"]:
            n, right = n + 1, right + (rows[i]["predicted"] == toxic)
    assert right / n > 0.97


def test_held_out_labels_are_not_used(spark):
    docs, labels = corpus(200, 2)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    one, two = (sorted(toxicity(*frames(spark, docs, x)).collect()) for x in (labels, turned))
    assert one == two


def test_awkward_documents(spark, odd):
    _, labels = frames(spark, [(0, "", "")], [(i, 1, i % 2) for i in range(1, 17)] + [(10, 1, 1), (99, 0, 1)])
    labels = labels.unionByName(spark.createDataFrame([(3, None, None), (None, 1, 1)], labels.schema))
    rows = toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2, 3, 14, 15)}) == 1


def test_no_labels_and_empty_table(spark, odd, none):
    _, labels = frames(spark, [(0, "", "")], [(1, 1, 0)])
    assert {r["score"] for r in toxicity(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity(none, labels).count() == 0


def _grams(words):
    t = Texts(*string_buffers(pa.array([" ".join(words)])), lower=True, solid=LETTERS)
    return word_grams(t, np.arange(len(words)))


def test_probabilities_sum_to_one():
    """Both models give every context's continuations, the unseen ones by backoff, a probability of 1 in all."""
    keys, _ = _grams(["banana", "bandana", "cabana", "ban", "nab"])
    names, counts = np.unique(keys, return_counts=True)
    pair = KneserNeyPair(names, np.stack((counts, counts[::-1]), 1).astype(float))
    twin = KneserNeyPair(names, np.stack((counts, counts), 1).astype(float))
    assert np.allclose(twin.excess(keys), 0) and not np.allclose(pair.excess(keys), 0)


def test_evidence_of_unseen_spellings():
    keys, _ = _grams(["plain", "talk", "plainly"])
    bad, _ = _grams(["snorkwit", "snorkwits"])
    names = np.unique(np.concatenate((keys, bad)))
    counts = np.stack([np.isin(names, keys) * 5.0, np.isin(names, bad) * 5.0], 1)
    e = evidence(pa.array(["plain talk", "snorkwitten talk", "", None]), KneserNeyPair(names, counts))
    assert e[1, 0] > e[0, 0] and e[1, 1] > 0 and (e[2:] == 0).all()


def test_all_grams_are_in_the_model(spark):
    """More n-grams than any fixed table holds, seen once each: every word's value is the plain model's."""
    r = random.Random(9)
    seen = sorted({"".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(100_000)})
    words = seen + ["unheardof", "zebra", "ü" * 5, "a" * 12]
    keys, word = _grams(words)
    kinds = np.array([r.randrange(4) if i < len(seen) else -1 for i in range(len(words))])
    trained = kinds[word] >= 0
    names, counts = toxicity_module._summed(keys[trained], np.eye(4)[kinds[word[trained]]])
    assert len(names) > 1 << 19
    rare = spark.createDataFrame(pd.DataFrame(counts.astype(int), columns=toxicity_module._COUNTS).assign(key=names.astype(np.int64)))
    some = [*range(0, len(seen), 97), *range(len(seen), len(words))]
    asked = spark.createDataFrame([(i, bytearray(words[i].encode()), 1) for i in some], "word long, letters binary, n long")
    got = {x["word"]: x for x in toxicity_module.word_values(rare, asked).collect()}
    for name, of in (("all", counts[:, :2] + counts[:, 2:]), ("half0", counts[:, :2]), ("half1", counts[:, 2:])):
        used = of.sum(1) > 0
        value = np.bincount(word, KneserNeyPair(names[used], of[used]).excess(keys))
        assert np.allclose([got[i][name] for i in some], value[some], atol=1e-4)


def test_words_beyond_the_hot_ones(spark, monkeypatch):
    """Scores do not depend on which words are sent to the tasks."""
    docs, labels = corpus(300, 3)
    docs += docs[:5] + [(None, "snorkwit plain", "x")]
    every = sorted(toxicity(*frames(spark, docs, labels)).collect(), key=str)
    monkeypatch.setattr(toxicity_module, "HOT_WORDS", 20)
    few = sorted(toxicity(*frames(spark, docs, labels)).collect(), key=str)
    assert [x["doc_id"] for x in every] == [x["doc_id"] for x in few]
    assert np.allclose([x["score"] for x in every], [x["score"] for x in few])


def test_few_labels_in_many_documents(spark, monkeypatch):
    """The fitting sample is a share of the labelled rows, however many documents have no label."""
    monkeypatch.setattr(toxicity_module, "MAX_FITTED", 100)
    fitted, plain = [], toxicity_module._logistic
    monkeypatch.setattr(toxicity_module, "_logistic", lambda e, y: fitted.append(len(y)) or plain(e, y))
    docs, labels = corpus(2000, 4)
    rows = {r["doc_id"]: r for r in toxicity(*frames(spark, docs, labels[:110])).collect()}
    assert fitted == [sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, _, _ in labels[:110])]
    assert sum(rows[i]["predicted"] == toxic for i, _, toxic in labels[110:]) / len(labels[110:]) > 0.9


def test_sample_without_a_class(spark):
    """A single toxic text has no other half to be measured by; words decide, and no evidence is not toxic."""
    docs = [(i, "plain talk of the town", "x") for i in range(20)] + [(50, "snorkwit blathrax", "x"), (51, "snorkwit blathrax", "x"), (52, "", "x"), (53, None, "x")]
    labels = [(i, 1, 0) for i in range(20)] + [(50, 1, 1)]
    assert zlib.crc32(b"50") % 5
    rows = {r["doc_id"]: r["predicted"] for r in toxicity(*frames(spark, docs, labels)).collect()}
    assert rows[50] == rows[51] == 1 and rows[52] == rows[53] == rows[0] == 0


def test_words_ask_in_batches(spark, monkeypatch):
    """A batch asks for each n-gram once, however many of its words have it; values don't depend on the batches."""
    r = random.Random(10)
    words = sorted({"".join(r.choice(["ba", "nan", "do", "ri"]) for _ in range(r.randint(1, 9))) for _ in range(800)}) + ["ü" * 5, "b" * 300]
    keys, word = _grams(words)
    kinds = np.array([i % 4 if i % 3 else -1 for i in range(len(words))])
    trained = kinds[word] >= 0
    names, counts = toxicity_module._summed(keys[trained], np.eye(4)[kinds[word[trained]]])
    grams = spark.createDataFrame(pd.DataFrame(counts.astype(int), columns=toxicity_module._COUNTS).assign(key=names.astype(np.int64)))
    rows = spark.createDataFrame([(i, bytearray(x.encode()), i + 1) for i, x in enumerate(words)], "word long, letters binary, n long").coalesce(1)
    one = toxicity_module._batched(rows)
    assert one.select("batch").distinct().count() == 1
    assert toxicity_module._asked(one).count() == len(np.unique(keys)) < len(keys) / 4
    value = np.bincount(word, KneserNeyPair(names, counts[:, :2] + counts[:, 2:]).excess(keys))
    for most_words, most_bytes in ((1 << 17, 4 << 20), (50, 4 << 20), (1 << 17, 64)):
        monkeypatch.setattr(toxicity_module, "BATCH_WORDS", most_words)
        monkeypatch.setattr(toxicity_module, "BATCH_BYTES", most_bytes)
        batched = toxicity_module._batched(rows).groupBy("batch").agg({"letters": "count"}).collect()
        assert sum(x[1] for x in batched) == len(words) and all(x[1] <= most_words for x in batched)
        got = {x["word"]: x for x in toxicity_module.word_values(grams, rows).collect()}
        assert len(got) == len(words) and all(got[i]["n"] == i + 1 for i in got)
        assert np.allclose([got[i]["all"] for i in range(len(words))], value, atol=1e-4)


def test_steps_remove_what_they_need_no_more(spark, monkeypatch):
    """Only the result's table is left, no step's shuffle outlives it, and the session's setting is as it was."""
    name, held = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", set()
    before, plain = spark.conf.get(name, None), toxicity_module.written
    monkeypatch.setattr(toxicity_module, "written", lambda df, *a: held.add(spark.conf.get(name)) or plain(df, *a))
    common.release(spark)
    docs, labels = corpus(60, 5)
    scores = toxicity(*frames(spark, docs, labels))
    assert held == {"true"} and spark.conf.get(name, None) == before
    assert ["toxic-means" in x for x in common._WRITTEN] == [True]
    assert scores.count() == len(docs)


def test_hot_words_are_few_rows_of_any_partition(spark, monkeypatch):
    """The driver gets HOT_WORDS rows at most, the most frequent, whatever the number of partitions."""
    monkeypatch.setattr(toxicity_module, "HOT_WORDS", 100)
    values = spark.range(1000).selectExpr("id AS word", "1000 DIV (id + 1) AS n", "0D AS all", "0D AS half0", "0D AS half1").repartition(40)
    hot = toxicity_module._hot(values.where("n > 0"))
    assert 80 <= len(hot) <= 100 and hot["word"].tolist() == list(range(len(hot)))
    assert len(toxicity_module._hot(values.where("word < 70"))) == 70
    assert len(toxicity_module._hot(values.withColumn("n", values["n"] * 0 + 1))) == 0
