"""Stored graphs, rounds on them, results that are whole or absent, means that don't depend on order."""

import itertools
import os
import random

import numpy as np
import pytest
from graph_helpers import as_dict, edges_df
from pyspark.sql import functions as F
from test_properties import brute, gnp

from closure_engine import (
    SkewConfig,
    closure,
    common_neighbour_counts,
    local_closure,
    open_graph,
    read_closure,
    store_graph,
    stored_messages,
    stored_rounds,
    transitivity,
    triangle_list,
    triangles_per_vertex,
    write_closure,
)
from closure_engine.functions import exact_mean
from closure_engine.sources import manifest
from tools.event_log import measure

PAIRS = gnp(40, 0.25, 31) + [(0, i) for i in range(1, 40)] + [(3, 3), (5, 4), (4, 5)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("graphs"))
    return store_graph(edges_df(spark, PAIRS), folder + "/g", cfg=SkewConfig(max_hot=50, min_hot_rows=20), buckets=4)


def test_measures_on_a_handle(spark, stored):
    per, triangles, glob, _, adj = brute(PAIRS)
    assert (stored.n_vertices, stored.n_edges) == (len(per), sum(map(len, adj.values())) // 2)
    assert stored.hubs.count() >= 1
    again = open_graph(spark.newSession(), stored.path)  # a session whose catalog is empty
    assert {tuple(r) for r in triangle_list(again).collect()} == triangles
    rows = as_dict(closure(again).per_vertex)
    assert {k: (r["degree"], r["triangles"], r["triplets"], r["local"]) for k, r in rows.items()} == per
    assert transitivity(again).first().transitivity == glob
    assert {r.id: r.triangles for r in triangles_per_vertex(again).collect()} == {k: v[1] for k, v in per.items()}
    assert all(r.n_common == len(adj[r.u] & adj[r.v]) for r in common_neighbour_counts(again).collect())
    with pytest.raises(ValueError):
        closure(again, materialize="persist")


def test_measures_on_a_handle_read_lists_instead_of_making_them(spark, stored):
    plan = local_closure(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "/lists" in "".join(local_closure(stored).inputFiles())
    again = local_closure(edges_df(spark, PAIRS).selectExpr("least(src, dst) u", "greatest(src, dst) v").where("u <> v").distinct())
    assert "collect_list" in again._jdf.queryExecution().optimizedPlan().toString()


def test_rounds_on_a_handle(stored):
    per, _, _, _, adj = brute(PAIRS)
    n = max(adj) + 1
    a = np.zeros((n, n), dtype=np.int64)
    for x, others in adj.items():
        a[x, list(others)] = 1
    start = stored.degrees.select("id", F.lit(1).cast("bigint").alias("w"))
    for rounds in (0, 1, 4):
        want = np.linalg.matrix_power(a, rounds) @ np.ones(n, dtype=np.int64)
        got = {r.id: r.w for r in stored_rounds(stored, start, "w", rounds, F.col("v_w"), F.col("u_w")).collect()}
        assert got == {i: int(want[i]) for i in adj}


def test_messages_one_way_and_with_wide_states(stored):
    _, _, _, _, adj = brute(PAIRS)
    state = stored.degrees.select("id", F.col("degree").alias("x"), F.concat(F.lit("v"), "id").alias("name"))
    got = {r.id: r.best for r in stored_messages(stored, state, None, F.concat("u_name", F.lit(":"), "u_x"), F.max, "best").collect()}
    want = {}
    for v, others in adj.items():
        found = [f"v{u}:{len(adj[u])}" for u in others if u < v]
        if found:
            want[v] = max(found)
    assert got == want
    with pytest.raises(ValueError, match="may read"):
        stored_messages(stored, state, None, F.col("u_x") + F.col("v_x"))


def test_layouts_leave_the_catalog_and_come_back(spark, tmp_path):
    graph = store_graph(edges_df(spark, PAIRS), str(tmp_path / "g"), buckets=2)
    assert graph.layout("u").count() == graph.n_edges == graph.layout("v").count()
    graph.forget()
    assert not [t.name for t in spark.catalog.listTables() if graph.mark in t.name]
    assert graph.layout("u").count() == graph.n_edges


def test_edges_are_not_shuffled_by_rounds(spark, tmp_path):
    pairs = gnp(300, 0.2, 5)
    graph = store_graph(edges_df(spark, pairs), str(tmp_path / "g"), buckets=8)
    assert graph.n_edges == len(pairs) > 8000
    start = graph.degrees.select("id", F.lit(1.0).alias("w"))
    seen = {}
    for rounds in (1, 2, 6):
        run = lambda: stored_rounds(graph, start, "w", rounds, F.col("v_w"), F.col("u_w")).collect()  # noqa: E731, B023
        seen[rounds] = measure(spark, run)["shuffle_records"]
    # states and merged messages only: at most a row a vertex and task, far fewer than the edges
    assert seen[6] - seen[2] <= 4 * 300 * 30 and seen[2] - seen[1] < len(pairs)


def test_edges_are_not_sorted_by_rounds(spark, tmp_path):
    graph = store_graph(edges_df(spark, PAIRS), str(tmp_path / "g"), buckets=4)
    start = graph.degrees.select("id", F.lit(1.0).alias("w"))
    plan = stored_messages(graph, start, F.col("v_w"), F.col("u_w"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ShuffledHashJoin") >= 2 and "SortMergeJoin" not in plan and "Sort [" not in plan


def test_a_folder_is_whole_or_absent(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "res")
    old = closure(edges_df(spark, [(1, 2), (2, 3), (1, 3)]))
    write_closure(old, path)
    with pytest.raises(FileExistsError):
        write_closure(old, path)
    new = closure(edges_df(spark, PAIRS))
    monkeypatch.setattr("closure_engine.sources.sinks.summarize", lambda *a: new.summary.select(F.raise_error(F.lit("no space left")).alias("x")))
    with pytest.raises(Exception, match="no space left"):
        write_closure(new, path, mode="overwrite")
    assert read_closure(spark, path)[1].first().triangles == 1  # the old result, whole
    monkeypatch.undo()

    def refuse(self, a, b):
        if "-staging-" in a:
            raise OSError("rename failed")
        return rename(self, a, b)

    rename = manifest._Files.rename
    monkeypatch.setattr(manifest._Files, "rename", refuse)
    with pytest.raises(OSError):
        write_closure(new, path, mode="overwrite")
    monkeypatch.undo()
    assert read_closure(spark, path)[0].count() == 3
    assert write_closure(new, path, mode="ignore").first().triangles == 1
    write_closure(new, path, mode="overwrite")
    per, summary = read_closure(spark, path)
    assert per.count() == 40 and summary.first().triangles == len(brute(PAIRS)[1])
    assert os.listdir(tmp_path) == ["res"]  # neither staged nor replaced folders are left
    with pytest.raises(ValueError):
        write_closure(new, path, mode="append")


def test_damaged_folders_are_noticed(spark, tmp_path):
    path = str(tmp_path / "res")
    write_closure(closure(edges_df(spark, PAIRS)), path)
    part = next(f for f in sorted(os.listdir(path + "/per_vertex")) if f.endswith(".parquet"))
    os.rename(f"{path}/per_vertex/{part}", f"{path}/{part}")
    with pytest.raises(ValueError, match="not the table"):
        read_closure(spark, path)
    with pytest.raises(FileNotFoundError):
        read_closure(spark, str(tmp_path / "none"))
    with pytest.raises(Exception):
        open_graph(spark, path)


def test_the_mean_has_the_same_bits_in_any_order(spark):
    r = random.Random(3)
    values = [r.random() ** 9 for _ in range(3000)] + [0.0, 1.0, 1e-300, 2.0**-62, 1 / 3]
    seen = set()
    for parts, seed in itertools.product((1, 3, 17), (1, 2)):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
        seen.add(df.agg(exact_mean("x", F.count("x")).alias("m")).first().m)
    assert len(seen) == 1
    from fractions import Fraction
    exact = sum(map(Fraction, values)) / len(values)
    assert abs(Fraction(seen.pop()) - exact) <= Fraction(1, 2**62) + exact / 2**52
    empty = spark.createDataFrame([], "x double").agg(exact_mean("x", F.count("x")).alias("m")).first().m
    assert empty != empty


def test_averages_do_not_depend_on_the_partitioning(spark):
    seen = {closure(edges_df(spark, PAIRS).repartition(n)).summary.first().average for n in (1, 5, 11)}
    assert len(seen) == 1
