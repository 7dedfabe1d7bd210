"""Golden values on the two hand-checked graphs (see FIXTURES.md)."""

import math

from graph_helpers import as_dict, edges_df

from closure_engine import closure, example_graph
from closure_engine.operators import compat

F1_DEGREE = [5, 6, 2, 2, 3, 4, 3, 3, 3, 2, 3, 2, 1, 1, 3, 1]
F1_TRIANGLES = [2, 2, 1, 1, 1, 2, 2, 2, 2, 1, 2, 0, 0, 0, 0, 0]
F1_TRIPLETS = [10, 15, 1, 1, 3, 6, 3, 3, 3, 1, 3, 1, 0, 0, 3, 0]

F2 = [(1, 2), (2, 1), (1, 2), (2, 3), (1, 3), (3, 3), (3, 4), (5, 5), (6, 7), (8, 7)]


def test_f1_per_vertex(spark):
    _, e = example_graph(spark)
    rows = as_dict(closure(e).per_vertex)
    assert sorted(rows) == list(range(1, 17))
    for i in range(16):
        r = rows[i + 1]
        assert (r["degree"], r["triangles"], r["triplets"]) == (F1_DEGREE[i], F1_TRIANGLES[i], F1_TRIPLETS[i])
        expect = 0.0 if F1_TRIPLETS[i] == 0 else F1_TRIANGLES[i] / F1_TRIPLETS[i]
        assert r["local"] == expect


def test_f1_summary(spark):
    _, e = example_graph(spark)
    s = closure(e).summary.collect()[0]
    assert (s.n_vertices, s.n_edges, s.triangles, s.triplets) == (16, 22, 6, 53)
    assert s.transitivity == 18 / 53
    assert math.isclose(s.average, 5 / 12, rel_tol=1e-12)


def test_f1_report_has_globals_on_every_row(spark):
    _, e = example_graph(spark)
    rows = closure(e).report().collect()
    assert len(rows) == 16
    assert {r.transitivity for r in rows} == {18 / 53}


def test_f1_with_declared_vertices_keeps_isolated(spark):
    v, e = example_graph(spark)
    extra = v.unionByName(spark.createDataFrame([(99, "z")], "id bigint, label string"))
    c = closure(e, vertices=extra)
    rows = as_dict(c.per_vertex)
    assert rows[99]["degree"] == 0 and rows[99]["local"] == 0.0
    s = c.summary.collect()[0]
    assert s.n_vertices == 17
    assert math.isclose(s.average, (5 / 12) * 16 / 17, rel_tol=1e-12)


def test_f2_documented(spark):
    c = closure(edges_df(spark, F2))
    rows = as_dict(c.per_vertex)
    assert sorted(rows) == [1, 2, 3, 4, 6, 7, 8]  # loop-only vertex 5 has no row
    got = {i: (r["degree"], r["triangles"], r["triplets"]) for i, r in rows.items()}
    assert got == {1: (2, 1, 1), 2: (2, 1, 1), 3: (3, 1, 3), 4: (1, 0, 0), 6: (1, 0, 0), 7: (2, 0, 1), 8: (1, 0, 0)}
    s = c.summary.collect()[0]
    assert (s.triangles, s.triplets, s.transitivity) == (1, 6, 0.5)
    assert math.isclose(s.average, 1 / 3, rel_tol=1e-12)


def test_compat_versions_on_f2(spark):
    raw = edges_df(spark, F2)
    v20 = compat.v20_summary(raw).collect()[0]
    assert (v20.triangles, v20.triplets) == (3, 10)
    assert math.isclose(v20.transitivity, 0.9) and math.isclose(v20.average, 1 / 7, abs_tol=1e-9)
    v25 = compat.v25_summary(raw).collect()[0]
    assert (v25.triangles, v25.triplets, v25.transitivity) == (8, 24, 1.0)
    assert math.isclose(v25.average, 113 / 240, abs_tol=1e-9)
    v11 = compat.v11_transitivity(raw).collect()[0]
    assert (v11.triangles, v11.triplets) == (11, 24)
    assert math.isclose(v11.transitivity, 11 / 24)


def test_compat_versions_on_f1(spark):
    _, e = example_graph(spark)
    v20 = compat.v20_summary(e).collect()[0]
    assert (v20.triangles, v20.triplets) == (18, 53) and math.isclose(v20.transitivity, 54 / 53)
    assert math.isclose(v20.average, 5 / 12, abs_tol=1e-9)
    v25 = compat.v25_summary(e).collect()[0]
    assert (v25.triangles, v25.triplets) == (17, 53) and math.isclose(v25.transitivity, 51 / 53)
    assert math.isclose(v25.average, 101 / 240, abs_tol=1e-9)
    v11 = compat.v11_transitivity(e).collect()[0]
    assert (v11.triangles, v11.triplets) == (18, 53) and math.isclose(v11.transitivity, 18 / 53)


def test_closure_custom_columns_and_rounding(spark):
    df = spark.createDataFrame([(a, b, "x") for a, b in F2], "p int, q int, tag string")
    s = closure(df, src="p", dst="q", average_digits=3).summary.collect()[0]
    assert (s.triangles, s.triplets, s.transitivity) == (1, 6, 0.5)
    assert s.average == 0.333
