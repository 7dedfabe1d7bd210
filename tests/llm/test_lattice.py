"""Lattice hashing against all cosines."""

import math

import numpy as np
import pytest

from closure_engine.llm.lattice import Cells, decode_e8, e8_roots, near_duplicate_vectors, tables_for


def plain(rows, least=0.95):
    units = {}
    for i, v in rows:
        ok = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        units[i] = None
        if ok:
            x = np.array(v, float) / max(map(abs, v))
            units[i] = x / np.linalg.norm(x)
    ids = sorted(units)
    links = {i: {j for j in ids if j != i and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j])
                 and units[i] @ units[j] >= least} for i in ids}
    low, seen = {}, set()
    for i in ids:
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in seen:
                seen.add(j)
                low[j] = i
                todo += links[j]
    return {i: (len(links[i]), low[i]) for i in ids}


def check(spark, rows, recall=1.0):
    want = plain(rows)
    got = near_duplicate_vectors(spark.createDataFrame([(i, v, 1, "x", "x") for i, v in rows], "vec_id long, embedding array<double>, label int, id string, unit string"))
    got = {r["vec_id"]: r for r in got.collect()}
    assert set(got) == set(want)
    assert all(r["n_links"] <= want[i][0] for i, r in got.items())
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())
    if recall == 1.0:
        assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == want
    else:
        assert sum(r["n_links"] for r in got.values()) >= recall * sum(n for n, _ in want.values())


def clustered(n, spread, seed, copies=3):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(n, 24))
    return [(k * n + i, (centres[i] + r.normal(size=24) * spread * r.random()).tolist()) for k in range(copies) for i in range(n)]


def test_close_groups(spark):
    check(spark, clustered(60, 0.12, 1, 6))


def test_borderline_recall(spark):
    check(spark, clustered(150, 0.3, 2), 0.9)


def test_awkward_vectors(spark):
    v = [0.3, -0.2, 0.9]
    check(spark, [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 0.0]), (5, [1.0, float("nan"), 0.0]), (6, [float("inf"), 0.0, 0.0]),
                  (7, v), (8, [2 * x for x in v]), (9, v), (10, v + [0.0]), (11, [-x for x in v]), (12, [1e-300, 0.0, 0.0]), (13, [1e300, 0.0, 0.0])])


def test_many_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr("closure_engine.llm.lattice.CHUNK", 16)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(40)] + [(100 + i, [1.0, 2.0, 3.0 + i / 1000]) for i in range(60)]
    check(spark, rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_duplicate_vectors(empty).count() == 0


def test_given_vectors(spark, sf):
    given = spark.read.parquet(f"{sf}/embeddings.parquet")
    want = plain([(r["vec_id"], r["embedding"]) for r in given.collect()])
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_duplicate_vectors(given).collect()}
    assert got == want


@pytest.mark.parametrize("seed", [0, 1])
def test_decoding_gives_the_nearest_point(seed):
    roots = e8_roots()
    assert len({tuple(x) for x in roots}) == 240 and set((roots ** 2).sum(1)) == {8}
    y = np.random.default_rng(seed).normal(0, 2, (500, 8))
    point = decode_e8(y)
    halves = point % 2
    assert (halves.min(1) == halves.max(1)).all() and (point.sum(1) % 4 == 0).all()  # points of E8, doubled
    near = ((y - point / 2) ** 2).sum(1)
    assert near.max() <= 1 + 1e-9  # the covering radius
    assert all((((y - (point + r) / 2) ** 2).sum(1) >= near - 1e-9).all() for r in roots)


def test_repeated_and_missing_ids(spark):
    """Rows are vectors: an id that holds two vectors loses neither, one without an id links with nothing."""
    rows = [(5, [1.0, 0.0, 0.0]), (5, [0.0, 1.0, 0.0]), (6, [1.0, 0.01, 0.0]), (7, [0.0, 1.0, 0.01]), (None, [1.0, 0.0, 0.0]),
            (9, [0.0, 0.0, 1.0]), (9, [0.0, 0.0, 1.0])]
    got = near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(5, 1, 5, True), (5, 1, 5, True), (6, 1, 5, False), (7, 1, 5, False),
                                                       (None, 0, None, False), (9, 1, 9, True), (9, 1, 9, True)], key=str)


@pytest.mark.parametrize("blocks", [2, 3, 4])
def test_recall_of_the_weakest_links_by_blocks(blocks):
    """Pairs of 64 dimensions at a cosine of 0.95: one's home cell is among the other's cells in some table."""
    r = np.random.default_rng(blocks)
    n, dim = 400, 64
    x, y = r.normal(size=(2, n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= (x * y).sum(1)[:, None] * x
    y = 0.95 * x + math.sqrt(1 - 0.95**2) * y / np.linalg.norm(y, axis=1)[:, None]
    met = np.zeros(n, bool)
    tables = tables_for(blocks)
    cells = Cells(dim, tables, blocks, 8)
    for t in range(tables):
        of_x, of_y = cells.of(x, t), cells.of(y, t)
        met |= np.any([of_x[0] == k for k in of_y], axis=0) | np.any([of_y[0] == k for k in of_x], axis=0)
    assert met.mean() >= 0.95
