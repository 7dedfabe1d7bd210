"""Set-valued messages as rows, declared vertices with repeated ids, fenced blocks: against plain Python."""

from collections import Counter

import pytest
from graph_helpers import as_dict, edges_df
from pyspark.sql import functions as F
from test_properties import brute, gnp

from closure_engine import (
    SkewConfig,
    block_meetings,
    canonical_edges,
    closing_with_multiplicity,
    common_element_sums,
    intersect_sets,
    neighbour_sets,
    one_per_id,
    repeated_ids,
    send_sets,
    triangles_total,
    triplet_view,
    with_vertices,
)
from closure_engine.operators.compat import common_neighbours_multiset

PAIRS = gnp(35, 0.3, 77) + [(0, i) for i in range(1, 35)]


@pytest.mark.parametrize("split_rows", [2, 1 << 16])
def test_intersections_equal_common_neighbours(spark, split_rows):
    *_, adj = brute(PAIRS)
    canon = canonical_edges(edges_df(spark, PAIRS))
    sets = neighbour_sets(canon, "u", "v")
    assert {(r.id, r.element) for r in sets.collect()} == {(v, w) for v, ws in adj.items() for w in ws}
    found = intersect_sets(canon, sets, "u", "v", split_rows).collect()
    assert len(found) == len({(r.u, r.v, r.element) for r in found})
    assert {(r.u, r.v, r.element) for r in found} == {(u, v, w) for u in adj for v in adj[u] if u < v for w in adj[u] & adj[v]}
    sums = {r.id: r.n_common_sum for r in common_element_sums(canon, sets, "u", "v").collect()}
    assert sums == {v: sum(len(adj[v] & adj[w]) for w in ws) for v, ws in adj.items()}


def test_counts_of_both_ends(spark):
    edges = edges_df(spark, [(1, 2)])
    sets = spark.createDataFrame([(1, 7, 3), (1, 8, 1), (2, 7, 5), (2, 9, 1), (2, 10, 1)], "id bigint, element bigint, count bigint")
    assert [tuple(r) for r in intersect_sets(edges, sets).collect()] == [(1, 2, 7, 3, 5)]
    assert [tuple(r) for r in intersect_sets(edges_df(spark, [(2, 1)]), sets).collect()] == [(2, 1, 7, 5, 3)]


@pytest.mark.parametrize("split_rows", [2, 1 << 16])
def test_a_further_round_of_sets(spark, split_rows):
    *_, adj = brute(PAIRS)
    canon = canonical_edges(edges_df(spark, PAIRS))
    got = {(r.id, r.element): r["count"] for r in send_sets(canon, neighbour_sets(canon, "u", "v"), "u", "v", split_rows=split_rows).collect()}
    assert got == Counter((v, x) for v, ws in adj.items() for w in ws for x in adj[w])


def test_a_hub_set_is_never_one_row(spark):
    star = spark.range(1, 3001).select(F.lit(0).cast("bigint").alias("u"), F.col("id").alias("v"))
    sets = neighbour_sets(star, "u", "v")
    assert not any("array" in t for _, t in sets.dtypes)
    assert sets.where("id = 0").count() == 3000 and common_element_sums(star, sets, "u", "v").agg(F.sum("n_common_sum")).first()[0] == 0


def test_repeated_vertices_are_merged(spark):
    rows = [(1, "a", 3), (1, "c", None), (1, "b", 5), (2, None, 1), (2, None, 1), (None, "z", 9)]
    v = spark.createDataFrame(rows, "id bigint, label string, n int")
    assert [tuple(r) for r in repeated_ids(v).where("id is not null").orderBy("id").collect()] == [(1, 3), (2, 2)]
    assert repeated_ids(one_per_id(v)).isEmpty()
    assert sorted(map(tuple, one_per_id(v).collect())) == [(1, "c", 5), (2, None, 1)]
    assert sorted(map(tuple, one_per_id(v, merge={"label": F.min, "n": F.sum}).collect())) == [(1, "a", 8), (2, None, 2)]
    assert sorted(r.id for r in one_per_id(v.select("id")).collect()) == [1, 2]
    with pytest.raises(ValueError):
        one_per_id(v, merge={"nothing": F.max})
    edges = edges_df(spark, [(1, 2), (2, 3), (1, 3)])
    g = as_dict(with_vertices(edges, v, merge={"n": F.sum}))
    assert g == {1: {"id": 1, "label": "c", "n": 8}, 2: {"id": 2, "label": None, "n": 2}, 3: {"id": 3, "label": None, "n": None}}
    view = triplet_view(edges, v, attrs=["n"], merge={"n": F.sum, "label": F.min})
    assert sorted((r.src, r.dst, r.src_n, r.dst_n) for r in view.collect()) == [(1, 2, 8, 2), (1, 3, 8, None), (2, 3, 2, None)]
    assert triplet_view(edges, v).count() == 3  # text attributes are salted, repeated ids still make no further edges


@pytest.mark.parametrize("wide,block", [(1, 1), (2, 3), (7, 2), (5, 64), (4096, 64)])
def test_fenced_blocks_are_exact_and_each_edge_handles_few_ids(spark, wide, block):
    pairs = gnp(60, 0.4, 9) + [(0, i) for i in range(1, 60)]
    _, triangles, *_, adj = brute(pairs)
    canon = canonical_edges(edges_df(spark, pairs))
    cfg = SkewConfig(block=block, wide=wide)
    assert triangles_total(canon, cfg=cfg).first().triangles == len(triangles)
    out = Counter()
    for u, v in {(min(p), max(p)) for p in pairs}:
        out[min(u, v, key=lambda x: (len(adj[x]), x))] += 1
    met = block_meetings(canon, cfg=cfg).select("a", "b", F.size("tail").alias("x"), F.size("ids").alias("y")).collect()
    handled = Counter()
    for r in met:
        handled[r.a, r.b] += r.x + r.y
    # P + Q meetings of two blocks each; blocks have at least the root of their list's length
    for (a, b), n in handled.items():
        width = max(wide, *(int(out[x] ** 0.5 + 1) for x in (a, b)))
        assert n <= 2 * (out[a] + out[b]) + 4 * width
    if wide == 4096:
        assert max(Counter((r.a, r.b) for r in met).values()) == 1 and all(n <= out[a] + out[b] for (a, b), n in handled.items())


@pytest.mark.parametrize("wide", [2, 4096])
def test_multiplicities_come_with_the_triangles(spark, wide):
    raw = [(a, b) for a, b in PAIRS for _ in range(1 + (a * b) % 3)] + [(b, a) for a, b in PAIRS if a % 4 == 1]
    count = Counter((min(p), max(p)) for p in raw)
    *_, adj = brute(raw)
    weighted = spark.createDataFrame([(u, v, n) for (u, v), n in count.items()], "u bigint, v bigint, w bigint")
    n_of = lambda x, y: count[min(x, y), max(x, y)]
    found = closing_with_multiplicity(weighted, cfg=SkewConfig(wide=wide)).collect()
    assert sum(len(r.common) for r in found) == len(brute(raw)[1])
    assert all((r.ab, x.ac, x.bc) == (n_of(r.a, r.b), n_of(r.a, x.c), n_of(r.b, x.c)) for r in found for x in r.common)
    df = common_neighbours_multiset(edges_df(spark, raw))
    got = {(r.u, r.v): r.n_common for r in df.collect()}
    assert got == {(u, v): sum(min(n_of(u, w), n_of(v, w)) for w in adj[u] & adj[v]) for u, v in count}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # on each side of the closing join, the lists' two degree look-ups with their hub tables; no join after it
    assert plan.count("Join ") == 2 * 4 + 1


@pytest.mark.parametrize("split_rows", [2, 16])
def test_sets_travel_as_blocks_not_as_rows(spark, split_rows):
    import closure_engine.operators.sets as module

    *_, adj = brute(PAIRS)
    canon = canonical_edges(edges_df(spark, PAIRS))
    met = module._meetings(canon, neighbour_sets(canon, "u", "v"), False, "u", "v", split_rows)
    rows = met.select("_less", "_more", F.size("_sent").alias("n")).collect()
    ends = {(min(p), max(p)) for p in PAIRS}
    # every row has a part of the smaller set; parts are disjoint, and one where a set is one block
    assert all(r.n > 0 for r in rows) and Counter((min(r._less, r._more), max(r._less, r._more)) for r in rows).keys() <= ends
    total = Counter()
    for r in rows:
        total[min(r._less, r._more), max(r._less, r._more)] += r.n
    assert all(total[u, v] <= min(len(adj[u]), len(adj[v])) for u, v in ends)
    if split_rows == 16:
        assert len(rows) < sum(total.values()) / 3
    sums = {r.id: r.n_common_sum for r in common_element_sums(canon, neighbour_sets(canon, "u", "v"), "u", "v", split_rows).collect()}
    assert sums == {v: sum(len(adj[v] & adj[w]) for w in ws) for v, ws in adj.items()}


@pytest.mark.parametrize("split_rows", [1, 1 << 10])
def test_repeated_and_null_elements_of_sets(spark, split_rows):
    edges = edges_df(spark, [(1, 2), (3, 2), (2, 2), (2, 9)])
    held = [(1, 7, 3), (1, 7, 1), (1, 8, 1), (1, None, 1), (2, 7, 5), (2, 9, 1), (2, 9, 2), (2, None, 1), (3, 9, 4), (None, 7, 1)]
    sets = spark.createDataFrame(held, "id bigint, element bigint, count bigint")
    want = sorted((s, d, e, m, n) for s, d in [(1, 2), (3, 2), (2, 2), (2, 9)] for i, e, m in held for j, f, n in held
                  if (i, j) == (s, d) and e is not None and e == f)
    assert sorted(map(tuple, intersect_sets(edges, sets, split_rows=split_rows).collect())) == want
    sums = Counter({1: 0, 2: 0, 3: 0, 9: 0})
    for s, d, *_ in want:
        sums.update([s, d])
    assert dict(map(tuple, common_element_sums(edges, sets, split_rows=split_rows).collect())) == dict(sums)


def test_what_is_sent_lies_on_disk_a_slice_at_a_time(spark, monkeypatch):
    import os

    import closure_engine.operators.sets as module
    from closure_engine.session import ensure_checkpoint_dir

    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    spill_dirs = [d.toString() for d in env.blockManager().diskBlockManager().localDirs()]
    kept_dir = ensure_checkpoint_dir(spark).removeprefix("file:")
    under = lambda top: {os.path.join(d, x) for d, _, names in os.walk(top) for x in names}
    shuffles = lambda: {f for d in spill_dirs for f in under(d) if f.endswith(".data") and "/shuffle_" in f}
    *_, adj = brute(PAIRS)
    canon = canonical_edges(edges_df(spark, PAIRS))
    sets = neighbour_sets(canon, "u", "v")
    rows, slices, sent = sum(map(len, adj.values())), [], module._sent

    def watched(*args):
        found = sent(*args)
        slices.append(found.agg(F.coalesce(F.sum(F.size("_sent")), F.lit(0))).first()[0])
        return found

    monkeypatch.setattr(module, "_sent", watched)
    before, tables = shuffles(), under(kept_dir)
    sums = common_element_sums(canon, sets, "u", "v", slice_rows=rows)
    monkeypatch.undo()
    assert {r.id: r.n_common_sum for r in sums.collect()} == {v: sum(len(adj[v] & adj[w]) for w in ws) for v, ws in adj.items()}
    total = sum(min(len(adj[v]), len(adj[w])) for v, ws in adj.items() for w in ws if v < w)
    assert sum(slices) == total and len(slices) == -(-total // rows) > 2 and max(slices) <= 2 * rows
    # only the watched counts, which ran without removal, may leave shuffles; of the tables, the sums are left
    assert {f.split("/")[-2] for f in under(kept_dir) - tables} == {"found"}
    again = shuffles()
    common_element_sums(canon, sets, "u", "v", slice_rows=rows)
    assert shuffles() <= again


def test_wide_ids_and_edges_without_sets(spark):
    far = 1 << 40
    edges = edges_df(spark, [(far, 2), (2, 3), (None, 2), (4, 5)])
    held = [(far, x, 1) for x in range(far, far + 100)] + [(2, x, 1) for x in range(far + 50, far + 120)] + [(3, far + 60, 2)]
    sets = spark.createDataFrame(held, "id bigint, element bigint, count bigint")
    assert dict(map(tuple, common_element_sums(edges, sets).collect())) == {far: 50, 2: 51, 3: 1, 4: 0, 5: 0, None: 0}
    named = sets.withColumn("element", F.col("element").cast("string"))
    assert dict(map(tuple, common_element_sums(edges, named, split_rows=16, slice_rows=20).collect())) == {far: 50, 2: 51, 3: 1, 4: 0, 5: 0, None: 0}
