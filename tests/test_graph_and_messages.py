"""Graph views, vertex joins and message passing."""

from graph_helpers import as_dict, edges_df
from pyspark.sql import functions as F

from closure_engine import (
    aggregate_messages,
    canonical_edges,
    degree,
    drop_exact_duplicates,
    drop_loops,
    join_vertices,
    message_rounds,
    neighbour_list,
    neighbour_set,
    triplet_view,
    vertices_from_edges,
    with_vertices,
)

F2 = [(1, 2), (2, 1), (1, 2), (2, 3), (1, 3), (3, 3), (3, 4), (5, 5), (6, 7), (8, 7)]


def test_cleaning(spark):
    raw = edges_df(spark, F2)
    assert drop_loops(raw).count() == 8
    assert drop_exact_duplicates(raw).count() == 9
    assert sorted(tuple(r) for r in canonical_edges(raw).collect()) == [(1, 2), (1, 3), (2, 3), (3, 4), (6, 7), (7, 8)]


def test_multigraph_degree_counts_loops_twice(spark):
    d = {r.id: r.degree for r in degree(edges_df(spark, F2)).collect()}
    assert d == {1: 4, 2: 4, 3: 5, 4: 1, 5: 2, 6: 1, 7: 2, 8: 1}


def test_degree_by_messages_equals_degree(spark):
    raw = edges_df(spark, F2)
    one = F.lit(1).cast("bigint")
    m = {r.id: r.degree for r in aggregate_messages(raw, None, one, one, F.sum, "degree").collect()}
    assert m == {r.id: r.degree for r in degree(raw).collect()}


def test_neighbour_list_and_set(spark):
    raw = edges_df(spark, F2)
    nl = {(r.id, r.neighbour): r.multiplicity for r in neighbour_list(raw).collect()}
    assert nl[(1, 2)] == 3 and nl[(3, 3)] == 2 and nl[(7, 8)] == 1
    ns = sorted((r.id, r.neighbour) for r in neighbour_set(canonical_edges(raw)).collect())
    assert ns == sorted([(1, 2), (2, 1), (1, 3), (3, 1), (2, 3), (3, 2), (3, 4), (4, 3),
                         (6, 7), (7, 6), (7, 8), (8, 7)])


def test_vertices_from_edges_and_with_vertices(spark):
    raw = edges_df(spark, F2)
    v = vertices_from_edges(drop_loops(raw), default=0)
    assert sorted((r.id, r.attr) for r in v.collect()) == [(i, 0) for i in (1, 2, 3, 4, 6, 7, 8)]
    labels = spark.createDataFrame([(1, "a"), (99, "z")], "id bigint, label string")
    g = {r.id: r.label for r in with_vertices(raw, labels).collect()}
    assert g[1] == "a" and g[99] == "z" and g[5] is None and len(g) == 9


def test_join_vertices_keeps_unmatched(spark):
    left = spark.createDataFrame([(1, 10), (2, 20)], "id bigint, x bigint")
    right = spark.createDataFrame([(2, 5), (3, 7)], "id bigint, y bigint")
    out = as_dict(join_vertices(left, right, "x", "y"))
    assert out[1]["merged"] == 10 and out[1]["new"] is None
    assert out[2]["merged"] == 5
    assert 3 not in out
    summed = as_dict(join_vertices(left, right, "x", "y", merge=lambda a, b: a + b))
    assert summed[2]["merged"] == 25


def test_triplet_view(spark):
    canon = canonical_edges(edges_df(spark, F2))
    tv = triplet_view(canon, degree(canon, "u", "v"), "u", "v")
    assert set(tv.columns) == {"u", "v", "u_degree", "v_degree"}
    rows = {(r.u, r.v): (r.u_degree, r.v_degree) for r in tv.collect()}
    assert rows[(3, 4)] == (3, 1) and rows[(7, 8)] == (2, 1)


def test_message_rounds_walks_and_checkpoint(spark):
    pairs = [(1, 2), (2, 3), (3, 1), (3, 4)]
    canon = canonical_edges(edges_df(spark, pairs))
    start = vertices_from_edges(canon, 1, "u", "v", attr="w", attr_type="bigint")
    two = {r.id: r.w for r in message_rounds(canon, start, "w", 2, F.col("v_w"), F.col("u_w"),
                                              F.sum, src="u", dst="v").collect()}
    # walks of length 2 ending at each vertex = sum of neighbours' degree
    assert two == {1: 2 + 3, 2: 2 + 3, 3: 2 + 2 + 1, 4: 3}
    five = message_rounds(canon, start, "w", 5, F.col("v_w"), F.col("u_w"), F.sum,
                          src="u", dst="v", checkpoint_every=2)
    # A^5 * 1 by hand
    import numpy as np
    a = np.zeros((4, 4), dtype=np.int64)
    for x, y in pairs:
        a[x - 1, y - 1] = a[y - 1, x - 1] = 1
    expect = np.linalg.matrix_power(a, 5) @ np.ones(4, dtype=np.int64)
    assert {r.id: r.w for r in five.collect()} == {i + 1: int(expect[i]) for i in range(4)}


def test_message_update_function(spark):
    canon = canonical_edges(edges_df(spark, [(1, 2), (2, 3)]))
    start = vertices_from_edges(canon, 10, "u", "v", attr="s", attr_type="bigint")
    got = message_rounds(canon, start, "s", 1, F.col("v_s"), None, F.max,
                         update=lambda old, msg: old + msg, src="u", dst="v")
    assert {r.id: r.s for r in got.collect()} == {1: 20, 2: 20, 3: 10}


def test_triplet_view_hot_path_equals_plain(spark):
    pairs = [(0, i) for i in range(1, 30)] + [(i, i + 1) for i in range(1, 29)] + [(5, 99)]
    edges = edges_df(spark, pairs)
    verts = spark.createDataFrame([(i, i * 3) for i in range(0, 30)], "id bigint, x bigint")  # 99 undeclared
    hubs = spark.createDataFrame([(0,), (5,), (99,)], "id bigint")
    cols = ["src", "dst", "src_x", "dst_x"]
    hot = sorted(map(tuple, triplet_view(edges, verts, hubs=hubs).select(*cols).collect()), key=repr)
    plain = sorted(map(tuple, triplet_view(edges, verts, skew_safe=False).select(*cols).collect()), key=repr)
    auto = sorted(map(tuple, triplet_view(edges, verts).select(*cols).collect()), key=repr)
    assert hot == plain == auto
    assert (5, 99, 15, None) in hot
