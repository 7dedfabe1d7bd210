import pytest

import closure_engine.llm.components as module
from closure_engine.llm.components import components


@pytest.fixture
def look_ups(monkeypatch):
    """The joins by a table of ids with many links."""
    seen = []
    join = module.split_join
    monkeypatch.setattr(module, "split_join", lambda *a, **b: seen.append(a) or join(*a, **b))
    return seen


def _found(spark, links):
    return {x["id"]: x["component"] for x in components(spark.createDataFrame(links, "a long, b long"), "test").collect()}


def test_few_links_meet_by_their_key(spark, look_ups):
    links = [(i, i + 1) for i in range(20)] + [(31, 30), (30, 31), (32, 31), (40, 40)] + [(50, i) for i in range(60, 80)]
    want = {i: 0 for i in range(1, 21)} | {31: 30, 32: 30} | {i: 50 for i in range(60, 80)}
    assert _found(spark, links) == want
    assert not look_ups


def test_many_links_are_looked_up(spark, look_ups):
    links = [(1000, i) for i in range(2000, 2000 + module._MANY + 40)] + [(2000 + i, 3000 + i) for i in range(30)] + [(3005, 7)]
    want = {i: 7 for i in [1000, *range(2000, 2000 + module._MANY + 40), *range(3000, 3030)]}
    assert _found(spark, links) == want
    assert look_ups


def test_no_links(spark, look_ups):
    assert _found(spark, []) == {}
    assert not look_ups
