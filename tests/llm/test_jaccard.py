"""The n-gram Jaccard join against all pairs."""

import random
import re
from collections import Counter

from closure_engine.llm.components import components
from closure_engine.llm.jaccard import jaccard_groups, one_of_each_group

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}


def plain(texts, percent=80):
    sets = {}
    for i, t in texts:
        w = WORD.findall((t or "").translate(LOW))
        s = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        sets.setdefault(i, []).append(s)
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if i is not None)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = top(a), top(b)
                parent[max(p, q)] = min(p, q)
    return {i: top(i) if i is not None else None for i in sets}, sets


def check(docs):
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want, sets = plain(texts)
    rows = jaccard_groups(docs).collect()
    assert Counter(str(r["doc_id"]) for r in rows) == Counter(str(i) for i, _ in texts)
    for r in rows:
        assert r["component_id"] == want[r["doc_id"]]
        assert r["n_shingles"] in [len(s) for s in sets[r["doc_id"]]]
    return want


def test_given_documents(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet"))


def test_awkward_documents(odd):
    want = check(odd)
    assert want[7] == want[8] == want[9] == 7 and want[5] == want[-3] == -3 and want[2] == 2


def test_chains_and_borders(spark):
    r = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 90):  # each changes a few words of an earlier one, or drops some at the end
        words = rows[r.randrange(len(rows))][1].split()
        for _ in range(r.randrange(4)):
            words[r.randrange(len(words))] = f"n{r.randrange(1000)}"
        rows.append((i, " ".join(words[:len(words) - r.randrange(12)])))
    rows += [(100 + n, " ".join(f"s{j}" for j in range(n))) for n in range(1, 14)]
    want = check(spark.createDataFrame(rows, "doc_id long, text string"))
    assert 3 < len(set(want.values())) < 100


def test_one_of_each_group_stays(odd):
    kept = one_of_each_group(odd, jaccard_groups(odd))
    assert kept.schema == odd.schema
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter({1: 1, 2: 1, 3: 1, 4: 1, -3: 1, 6: 1, 7: 1, 10: 1, None: 1, 11: 1, 12: 1, 13: 1, 14: 1, 15: 1, 16: 1})


def test_empty_table(none):
    assert jaccard_groups(none).count() == 0


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(400), r.randrange(400)) for _ in range(330)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2200)]
    parent = {}

    def top(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        p, q = top(a), top(b)
        parent[max(p, q)] = min(p, q)
    got = {x["id"]: x["component"] for x in components(spark.createDataFrame(links, "a long, b long"), "test").collect()}
    assert all(got.get(i, i) == top(i) for i in list(parent))
