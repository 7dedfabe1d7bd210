"""Text edge lists and column sources."""

import os
import tempfile

import pytest
from graph_helpers import edges_df

from closure_engine import closure, edges_from_columns, parse_edge_lines, read_edge_text
from closure_engine.session import ensure_checkpoint_dir
from closure_engine.sources.text import rejected_edge_lines

F2_TEXT = """# dirty graph: reciprocal, repeat, loops, leaf, in-star
1 2
2\t1
1 2 extra columns are ignored

2   3
1 3
3 3
3 4
5 5
6 7
  8 7
"""


def _write(text: str) -> str:
    d = tempfile.mkdtemp(prefix="closure-test-")
    p = os.path.join(d, "edges.txt")
    with open(p, "w") as fh:
        fh.write(text)
    return p


def test_read_edge_text_skips_comments_and_blanks(spark):
    e = read_edge_text(spark, _write(F2_TEXT))
    assert e.schema.simpleString() == "struct<src:bigint,dst:bigint,attr:int>"
    rows = sorted((r.src, r.dst, r.attr) for r in e.collect())
    assert rows == sorted([(1, 2, 1), (2, 1, 1), (1, 2, 1), (2, 3, 1), (1, 3, 1), (3, 3, 1),
                           (3, 4, 1), (5, 5, 1), (6, 7, 1), (8, 7, 1)])
    s = closure(e).summary.collect()[0]
    assert (s.triangles, s.triplets, s.transitivity) == (1, 6, 0.5)


def test_read_edge_text_repartition(spark):
    e = read_edge_text(spark, _write(F2_TEXT), num_partitions=3)
    assert e.rdd.getNumPartitions() == 3
    assert e.count() == 10


def test_strict_mode_fails_on_bad_id(spark):
    lines = spark.createDataFrame([("1 2",), ("3 x",)], "value string")
    with pytest.raises(Exception, match="malformed edge line"):
        parse_edge_lines(lines).collect()


def test_strict_mode_fails_on_single_token(spark):
    lines = spark.createDataFrame([("1 2",), ("7",)], "value string")
    with pytest.raises(Exception, match="malformed edge line"):
        parse_edge_lines(lines).collect()


def test_permissive_mode_drops_bad_lines(spark):
    lines = spark.createDataFrame([("1 2",), ("3 x",), ("7",), ("# c",), ("",), ("4,5",)], "value string")
    rows = [(r.src, r.dst) for r in parse_edge_lines(lines, mode="permissive").collect()]
    assert rows == [(1, 2)]


def test_white_space_of_any_kind_around_lines(spark):
    lines = spark.createDataFrame([("\t1 2",), ("3 4\t\r",), (" \t\x0b# c",), ("\t",), (" \x0c ",), ("# 1 2",)], "value string")
    for mode in ("strict", "permissive"):
        assert sorted((r.src, r.dst) for r in parse_edge_lines(lines, mode=mode).collect()) == [(1, 2), (3, 4)]
    assert rejected_edge_lines(lines).count() == 0


def test_rejected_lines_can_be_seen(spark):
    lines = spark.createDataFrame([("1 2",), ("3 x",), ("\t7",), ("# c",), ("",), ("4,5",)], "value string")
    assert sorted(r.line for r in rejected_edge_lines(lines).collect()) == ["3 x", "4,5", "7"]


def test_custom_separator(spark):
    lines = spark.createDataFrame([("1,2",), ("2,3,9",)], "value string")
    rows = sorted((r.src, r.dst) for r in parse_edge_lines(lines, sep_regex=",").collect())
    assert rows == [(1, 2), (2, 3)]


def test_large_ids_stay_bigint(spark):
    big = 2**40
    lines = spark.createDataFrame([(f"{big} {big + 1}",)], "value string")
    r = parse_edge_lines(lines).collect()[0]
    assert (r.src, r.dst) == (big, big + 1)


def test_edges_from_columns_with_offset(spark):
    df = spark.createDataFrame([(1, 2, "x"), (3, 2, "y")], "a int, b int, lab string")
    e = edges_from_columns(df, "a", "b", attr="lab", dst_offset=1000)
    assert e.schema.simpleString() == "struct<src:bigint,dst:bigint,attr:string>"
    assert sorted((r.src, r.dst, r.attr) for r in e.collect()) == [(1, 1002, "x"), (3, 1002, "y")]


def test_edges_df_helper_roundtrip(spark):
    assert edges_df(spark, [(1, 2)]).count() == 1


def test_write_closure_and_read_back(spark):
    from closure_engine import write_closure
    out = tempfile.mkdtemp(prefix="closure-out-")
    s = write_closure(closure(read_edge_text(spark, _write(F2_TEXT))), out + "/res").collect()[0]
    assert (s.triangles, s.triplets, s.transitivity) == (1, 6, 0.5)
    per_vertex = spark.read.parquet(out + "/res/per_vertex")
    assert per_vertex.count() == 7


def test_closure_from_text_and_materialize(spark):
    from closure_engine import closure_from_text, global_coefficient
    p = _write(F2_TEXT)
    for how in (None, "persist", "checkpoint"):
        c = closure_from_text(spark, p, materialize=how)
        assert c.summary.collect()[0].transitivity == 0.5
        if how == "persist":
            c.unpersist()
    g = global_coefficient(read_edge_text(spark, p)).collect()[0]
    assert (g.triangles, g.triplets, g.transitivity) == (1, 6, 0.5)
    with pytest.raises(ValueError):
        closure_from_text(spark, p, materialize="bogus")


def test_command_line(spark, capsys):
    from closure_engine.__main__ import main
    out = tempfile.mkdtemp(prefix="closure-cli-")
    row = main([_write(F2_TEXT), out + "/res"])
    assert (row["triangles"], row["triplets"], row["transitivity"]) == (1, 6, 0.5)
    assert '"transitivity": 0.5' in capsys.readouterr().out
    assert spark.read.parquet(out + "/res/per_vertex").count() == 7


def test_a_cluster_needs_a_shared_checkpoint_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
