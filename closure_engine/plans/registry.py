"""Registered queries: each runs an operator on a whole graph read from the tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` is the
same result in plain SQL (DuckDB dialect) over the same tables.  Column names
match on both sides; every mean is rounded to 9 places on both sides because
floating-point sums depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closure_engine.operators import compat
from closure_engine.operators.adjacency import degree, neighbour_list, neighbour_set
from closure_engine.operators.clean import canonical_edges, drop_exact_duplicates, drop_loops
from closure_engine.operators.graph import join_vertices, triplet_view, vertices_from_edges, with_vertices
from closure_engine.operators.measures import closure, local_closure, summarize, transitivity, triplets_per_vertex, triplets_total
from closure_engine.operators.messages import aggregate_messages, message_rounds
from closure_engine.operators.triangles import (
    common_neighbour_counts,
    common_neighbour_sums,
    common_neighbours,
    triangle_counts,
    triangle_list,
    triangles_by_intersect,
    triangles_per_vertex,
    triangles_total,
)
from closure_engine.plans.graphs import RAW_SQL, raw_edges, sql_prefix
from closure_engine.sources.tables import table
from closure_engine.sources.text import parse_edge_lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

AVG_DIGITS = 9


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def _long_triplets(df: DataFrame) -> DataFrame:
    """The exact decimal ``triplets`` as bigint, which is wide enough for the given tables."""
    return df.withColumn("triplets", F.col("triplets").cast("bigint"))


def _k(spark, sf_dir):
    return raw_edges(spark, sf_dir, "K")


def _kc(spark, sf_dir):
    return canonical_edges(_k(spark, sf_dir))


K = sql_prefix("K")

# ---------------------------------------------------------------- sources (A)


@register("edge_lines_parse", f"SELECT src, dst, 1 AS attr FROM ({RAW_SQL['K']})")
def q_edge_lines_parse(spark, sf_dir):
    """Each line item rendered as a text line (varying separators, an ignored
    third column, white space before some lines), each followed by a comment,
    a line of white space or a blank line; then parsed."""
    return parse_edge_lines(_rendered_lines(spark, sf_dir))


def _rendered_lines(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    sep = F.element_at(F.array(F.lit(" "), F.lit("\t"), F.lit("  \t ")), (F.pmod("l_linenumber", F.lit(3)) + 1).cast("int"))
    lead = F.element_at(F.array(F.lit(""), F.lit("\t"), F.lit(" \t\x0b ")), (F.pmod("l_orderkey", F.lit(3)) + 1).cast("int"))
    data = F.concat_ws("", lead, F.col("l_partkey").cast("string"), sep, F.col("l_suppkey").cast("string"),
                       sep, F.col("l_linenumber").cast("string"), lead)
    extra = F.when(F.col("l_linenumber") == 1, F.concat(lead, F.lit("# order "), F.col("l_orderkey").cast("string"))) \
             .otherwise(lead)
    return li.select(F.explode(F.array(data, extra)).alias("value"))


@register("edge_text_file", f"SELECT src, dst, 1 AS attr FROM ({RAW_SQL['K']})")
def q_edge_text_file(spark, sf_dir):
    """The same rendered lines written as a text edge list under the
    checkpoint folder (shared storage on a cluster), then read back with the
    file reader and its optional partition count."""
    import uuid

    from closure_engine.session import ensure_checkpoint_dir
    from closure_engine.sources.text import read_edge_text

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/edge-text-{uuid.uuid4().hex}"
    _rendered_lines(spark, sf_dir).write.text(path)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_edge_text(spark, path, num_partitions=n)


@register("vertices_from_edges", f"""WITH raw AS ({RAW_SQL['K']})
SELECT DISTINCT id, 0 AS attr FROM (SELECT src AS id FROM raw WHERE src <> dst
                                    UNION ALL SELECT dst FROM raw WHERE src <> dst)""")
def q_vertices_from_edges(spark, sf_dir):
    return vertices_from_edges(drop_loops(_k(spark, sf_dir)), default=0)


@register("graph_with_labels", f"""WITH raw AS ({RAW_SQL['K']}),
ends AS (SELECT DISTINCT id FROM (SELECT src AS id FROM raw UNION ALL SELECT dst FROM raw)),
p AS (SELECT p_partkey AS id, p_name AS label FROM part)
SELECT coalesce(p.id, ends.id) AS id, p.label FROM p FULL OUTER JOIN ends ON p.id = ends.id""")
def q_graph_with_labels(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("label"))
    return with_vertices(_k(spark, sf_dir), parts)


# ------------------------------------------------------------- cleaning (B)


@register("edges_no_loops", f"SELECT src, dst FROM ({RAW_SQL['K']}) WHERE src <> dst")
def q_edges_no_loops(spark, sf_dir):
    return drop_loops(_k(spark, sf_dir))


@register("edges_distinct", f"SELECT DISTINCT src, dst FROM ({RAW_SQL['K']})")
def q_edges_distinct(spark, sf_dir):
    return drop_exact_duplicates(_k(spark, sf_dir))


@register("edges_canonical", K + "SELECT u, v FROM e")
def q_edges_canonical(spark, sf_dir):
    return _kc(spark, sf_dir)


# ------------------------------------------------------------ degrees (D1-D5)

_MULTI_DEGREE_SQL = f"""WITH raw AS ({RAW_SQL['K']})
SELECT id, count(*) AS degree FROM (SELECT src AS id FROM raw UNION ALL SELECT dst FROM raw) GROUP BY id"""


@register("degree_multigraph", _MULTI_DEGREE_SQL)
def q_degree_multigraph(spark, sf_dir):
    return degree(_k(spark, sf_dir))


@register("degree_by_messages", _MULTI_DEGREE_SQL)
def q_degree_by_messages(spark, sf_dir):
    one = F.lit(1).cast("bigint")
    return aggregate_messages(_k(spark, sf_dir), None, to_src=one, to_dst=one, merge=F.sum, name="degree")


@register("degree_simple", K + "SELECT id, degree FROM d")
def q_degree_simple(spark, sf_dir):
    return degree(_kc(spark, sf_dir), "u", "v")


@register("neighbour_list", f"""WITH raw AS ({RAW_SQL['K']})
SELECT id, neighbour, count(*) AS multiplicity
FROM (SELECT src AS id, dst AS neighbour FROM raw UNION ALL SELECT dst, src FROM raw) GROUP BY id, neighbour""")
def q_neighbour_list(spark, sf_dir):
    return neighbour_list(_k(spark, sf_dir))


@register("neighbour_set", K + "SELECT u AS id, v AS neighbour FROM e UNION ALL SELECT v, u FROM e")
def q_neighbour_set(spark, sf_dir):
    return neighbour_set(_kc(spark, sf_dir))


# ---------------------------------------------------------------- joins (C)


@register("triplet_view", K + """SELECT e.u, e.v, du.degree AS u_degree, dv.degree AS v_degree
FROM e JOIN d du ON du.id = e.u JOIN d dv ON dv.id = e.v""")
def q_triplet_view(spark, sf_dir):
    canon = _kc(spark, sf_dir)
    return triplet_view(canon, degree(canon, "u", "v"), "u", "v")


@register("join_vertices", K + """SELECT d.id, d.degree AS old, tv.triangles AS new,
       coalesce(tv.triangles, d.degree) AS merged FROM d LEFT JOIN tv ON d.id = tv.id""")
def q_join_vertices(spark, sf_dir):
    canon = _kc(spark, sf_dir)
    deg = degree(canon, "u", "v")
    return join_vertices(deg, triangle_counts(canon, deg), value="degree", new_value="triangles")


# ------------------------------------------------ common neighbours (D6-D9)


@register("common_neighbours_edge", K + "SELECT u, v, n_common FROM cn")
def q_common_neighbours_edge(spark, sf_dir):
    return common_neighbour_counts(_kc(spark, sf_dir))


@register("common_neighbours_list", K + """SELECT a AS u, b AS v, c AS w FROM t
UNION ALL SELECT a, c, b FROM t UNION ALL SELECT b, c, a FROM t""")
def q_common_neighbours_list(spark, sf_dir):
    return common_neighbours(_kc(spark, sf_dir))


_CN_SUM = """ns AS (SELECT id, CAST(sum(n_common) AS BIGINT) AS n_common_sum
       FROM (SELECT u AS id, n_common FROM cn UNION ALL SELECT v, n_common FROM cn) GROUP BY id)
"""


@register("common_neighbours_vertex", K + ", " + _CN_SUM + "SELECT id, n_common_sum FROM ns")
def q_common_neighbours_vertex(spark, sf_dir):
    return common_neighbour_sums(_kc(spark, sf_dir))


# ------------------------------------------------------ triangles (C3, D10-12)


@register("triangles_list", K + "SELECT a, b, c FROM t")
def q_triangles_list(spark, sf_dir):
    return triangle_list(_kc(spark, sf_dir))


@register("triangles_per_vertex", K + "SELECT id, triangles FROM lc")
def q_triangles_per_vertex(spark, sf_dir):
    return triangles_per_vertex(_kc(spark, sf_dir))


@register("triangles_by_intersect", K + ", " + _CN_SUM + "SELECT id, n_common_sum // 2 AS triangles FROM ns")
def q_triangles_by_intersect(spark, sf_dir):
    return triangles_by_intersect(_kc(spark, sf_dir))


@register("triangles_total", K + "SELECT count(*) AS triangles FROM t")
def q_triangles_total(spark, sf_dir):
    return triangles_total(_kc(spark, sf_dir))


# -------------------------------------------------------- measures (D13-D21)


@register("triplets_per_vertex", K + "SELECT id, triplets FROM lc")
def q_triplets_per_vertex(spark, sf_dir):
    return _long_triplets(triplets_per_vertex(degree(_kc(spark, sf_dir), "u", "v")))


@register("triplets_total", K + "SELECT CAST(sum(triplets) AS BIGINT) AS triplets FROM lc")
def q_triplets_total(spark, sf_dir):
    return _long_triplets(triplets_total(degree(_kc(spark, sf_dir), "u", "v")))


@register("local_closure", K + "SELECT id, degree, triangles, triplets, local FROM lcl")
def q_local_closure(spark, sf_dir):
    return _long_triplets(local_closure(_kc(spark, sf_dir)))


@register("transitivity", K + """SELECT CAST(sum(triangles) // 3 AS BIGINT) AS triangles,
       CAST(sum(triplets) AS BIGINT) AS triplets,
       sum(triangles)::DOUBLE / sum(triplets)::DOUBLE AS transitivity FROM lc""")
def q_transitivity(spark, sf_dir):
    return _long_triplets(transitivity(_kc(spark, sf_dir)))


@register("average_closure", K + f"""SELECT count(*) AS n_vertices,
       round(sum(local) / count(*), {AVG_DIGITS}) AS average FROM lcl""")
def q_average_closure(spark, sf_dir):
    return summarize(local_closure(_kc(spark, sf_dir)), AVG_DIGITS).select("n_vertices", "average")


def _summary_sql(graph: str) -> str:
    return sql_prefix(graph) + f"""SELECT count(*) AS n_vertices, CAST(sum(degree) // 2 AS BIGINT) AS n_edges,
       CAST(sum(triangles) // 3 AS BIGINT) AS triangles, CAST(sum(triplets) AS BIGINT) AS triplets,
       sum(triangles)::DOUBLE / sum(triplets)::DOUBLE AS transitivity,
       round(sum(local) / count(*), {AVG_DIGITS}) AS average FROM lcl"""


@register("closure_summary", _summary_sql("K"))
def q_closure_summary(spark, sf_dir):
    return _long_triplets(closure(_k(spark, sf_dir), average_digits=AVG_DIGITS).summary)


@register("closure_summary_bipartite", _summary_sql("B"))
def q_closure_summary_bipartite(spark, sf_dir):
    return _long_triplets(closure(raw_edges(spark, sf_dir, "B"), average_digits=AVG_DIGITS).summary)


@register("closure_declared_vertices", sql_prefix("B") + f""", dv AS (SELECT c_custkey AS id FROM customer UNION SELECT id FROM d),
pv AS (SELECT dv.id, coalesce(lcl.degree, 0) AS degree, coalesce(lcl.triplets, 0) AS triplets, coalesce(lcl.local, 0.0::DOUBLE) AS local
       FROM dv LEFT JOIN lcl ON lcl.id = dv.id)
SELECT id, CAST(degree AS BIGINT) AS degree, CAST(triplets AS BIGINT) AS triplets, local,
       (SELECT count(*) FROM pv) AS n_vertices, (SELECT round(sum(local) / count(*), {AVG_DIGITS}) FROM pv) AS average FROM pv""")
def q_closure_declared_vertices(spark, sf_dir):
    """Customers without an order are isolated vertices: degree and local 0, and they count in the average."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    found = closure(raw_edges(spark, sf_dir, "B"), vertices=customers, average_digits=AVG_DIGITS)
    one = found.summary.select(F.lit(0).alias("_k"), "n_vertices", "average")  # a single row
    rows = _long_triplets(found.per_vertex).select("id", "degree", "triplets", "local", F.lit(0).alias("_k"))
    return rows.join(F.broadcast(one), "_k").drop("_k")


@register("closure_report", K + f""", s AS (SELECT sum(triangles)::DOUBLE / sum(triplets)::DOUBLE AS transitivity,
       round(sum(local) / count(*), {AVG_DIGITS}) AS average FROM lcl)
SELECT id, degree, triangles, triplets, local, s.transitivity, s.average FROM lcl, s""")
def q_closure_report(spark, sf_dir):
    return _long_triplets(closure(_k(spark, sf_dir), average_digits=AVG_DIGITS).report())


# ------------------------------------------------------------ messages (E)


@register("neighbour_value_sum", K + """SELECT id, count(*) AS n_messages, round(sum(price), 2) AS value_sum
FROM (SELECT e.u AS id, p.p_retailprice AS price FROM e JOIN part p ON p.p_partkey = e.v
      UNION ALL SELECT e.v, p.p_retailprice FROM e JOIN part p ON p.p_partkey = e.u) GROUP BY id""")
def q_neighbour_value_sum(spark, sf_dir):
    prices = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"))
    got = aggregate_messages(_kc(spark, sf_dir), prices, to_src=F.col("v_price"), to_dst=F.col("u_price"),
                             merge=F.sum, name="value_sum", src="u", dst="v", count_name="n_messages")
    return got.select("id", "n_messages", F.round("value_sum", 2).alias("value_sum"))


@register("message_rounds_walks", K + """SELECT h.id, CAST(sum(d.degree) AS BIGINT) AS walks2
FROM (SELECT u AS id, v AS nb FROM e UNION ALL SELECT v, u FROM e) h JOIN d ON d.id = h.nb GROUP BY h.id""")
def q_message_rounds_walks(spark, sf_dir):
    def start(edges):
        return vertices_from_edges(edges, default=1, src="u", dst="v", attr="walks2", attr_type="bigint")

    return message_rounds(_kc(spark, sf_dir), start, "walks2", 2, to_src=F.col("v_walks2"), to_dst=F.col("u_walks2"),
                          merge=F.sum, src="u", dst="v")


# ------------------------------------- stored graph, set messages (A9, E, J3)


def _stored(spark, sf_dir):
    import uuid

    from closure_engine.operators.stored import store_graph
    from closure_engine.session import ensure_checkpoint_dir

    return store_graph(_k(spark, sf_dir), f"{ensure_checkpoint_dir(spark).rstrip('/')}/graph-{uuid.uuid4().hex}")


@register("stored_graph_summary", _summary_sql("K"))
def q_stored_graph_summary(spark, sf_dir):
    """The whole summary of a graph that was prepared, stored and opened again."""
    from closure_engine.operators.stored import open_graph

    return _long_triplets(closure(open_graph(spark, _stored(spark, sf_dir).path), average_digits=AVG_DIGITS).summary)


@register("stored_rounds_walks", K + """, h AS (SELECT u AS id, v AS nb FROM e UNION ALL SELECT v, u FROM e),
w2 AS (SELECT h.id, sum(d.degree) AS w FROM h JOIN d ON d.id = h.nb GROUP BY h.id),
w3 AS (SELECT h.id, sum(w2.w) AS w FROM h JOIN w2 ON w2.id = h.nb GROUP BY h.id)
SELECT h.id, CAST(sum(w3.w) AS BIGINT) AS walks4 FROM h JOIN w3 ON w3.id = h.nb GROUP BY h.id""")
def q_stored_rounds_walks(spark, sf_dir):
    """Walks of four steps that end at each vertex: four rounds over edges that stay where they are."""
    from closure_engine.operators.stored import stored_rounds

    graph = _stored(spark, sf_dir)
    start = graph.degrees.select("id", F.lit(1).cast("bigint").alias("walks4"))
    return stored_rounds(graph, start, "walks4", 4, to_u=F.col("v_walks4"), to_v=F.col("u_walks4"))


@register("set_messages_intersect", K + ", " + _CN_SUM + "SELECT id, n_common_sum FROM ns")
def q_set_messages_intersect(spark, sf_dir):
    """Two rounds of set-valued messages: neighbour sets, then their intersections, as rows."""
    from closure_engine.operators.sets import common_element_sums, neighbour_sets

    canon = _kc(spark, sf_dir)
    return common_element_sums(canon, neighbour_sets(canon, "u", "v"), "u", "v")


@register("graph_with_repeated_vertices", f"""WITH raw AS ({RAW_SQL['B']}),
ends AS (SELECT DISTINCT id FROM (SELECT src AS id FROM raw UNION ALL SELECT dst FROM raw)),
p AS (SELECT o_custkey AS id, max(o_orderstatus) AS status, min(o_orderkey) AS first_order, count(o_orderkey) AS n_orders
      FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey)
SELECT coalesce(p.id, ends.id) AS id, p.status, p.first_order, p.n_orders FROM p FULL OUTER JOIN ends ON p.id = ends.id""")
def q_graph_with_repeated_vertices(spark, sf_dir):
    """Every order declares its customer again; a vertex is one row with merged attributes."""
    declared = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status"),
                                                     F.col("o_orderkey").alias("first_order"), F.col("o_orderkey").alias("n_orders"))
    return with_vertices(raw_edges(spark, sf_dir, "B"), declared, merge={"first_order": F.min, "n_orders": F.count})


# ------------------------------------------------------------- compat (L)

_COMPAT_ROWS = "SELECT id, degree, triangles, triplets, local FROM pl"
_COMPAT_SUMMARY = f"""SELECT count(*) AS n_vertices, CAST(sum(triangles) AS BIGINT) AS triangles, CAST(sum(triplets) AS BIGINT) AS triplets,
       (3 * sum(triangles))::DOUBLE / sum(triplets)::DOUBLE AS transitivity,
       round(sum(local) / count(*), {AVG_DIGITS}) AS average FROM pl"""

_V20_SQL = f"""WITH raw AS ({RAW_SQL['K']}),
e1 AS (SELECT DISTINCT src, dst FROM raw WHERE src <> dst),
e AS (SELECT DISTINCT least(src, dst) AS u, greatest(src, dst) AS v FROM e1),
t AS (SELECT x.u AS a, x.v AS b, y.v AS c FROM e x JOIN e y ON x.u = y.u AND x.v < y.v
      JOIN e z ON z.u = x.v AND z.v = y.v),
cn AS (SELECT e.u, e.v, coalesce(k.n, 0) AS n_common FROM e LEFT JOIN
         (SELECT u, v, count(*) AS n FROM (SELECT a AS u, b AS v FROM t UNION ALL SELECT a, c FROM t
                                           UNION ALL SELECT b, c FROM t) GROUP BY u, v) k
         ON e.u = k.u AND e.v = k.v),
ev AS (SELECT e1.src, e1.dst, cn.n_common FROM e1 JOIN cn ON cn.u = least(e1.src, e1.dst) AND cn.v = greatest(e1.src, e1.dst)),
x AS (SELECT id, sum(n_common) AS x FROM (SELECT src AS id, n_common FROM ev UNION ALL SELECT dst, n_common FROM ev) GROUP BY id),
d1 AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM e1 UNION ALL SELECT dst FROM e1) GROUP BY id),
pv AS (SELECT d1.id, d1.degree, CAST(coalesce(x.x, 0) // 2 AS BIGINT) AS triangles, d1.degree * (d1.degree - 1) // 2 AS triplets
       FROM d1 LEFT JOIN x ON x.id = d1.id),
pl AS (SELECT *, CASE WHEN triplets = 0 THEN 0.0::DOUBLE ELSE triangles::DOUBLE / triplets END AS local FROM pv)
"""


@register("compat_v20_summary", _V20_SQL + _COMPAT_SUMMARY)
def q_compat_v20(spark, sf_dir):
    return _long_triplets(compat.v20_summary(_k(spark, sf_dir)))


@register("compat_v20_per_vertex", _V20_SQL + _COMPAT_ROWS)
def q_compat_v20_per_vertex(spark, sf_dir):
    return _long_triplets(compat.v20_per_vertex(_k(spark, sf_dir)))


_V25_SQL = f"""WITH raw AS ({RAW_SQL['K']}),
dr AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM raw UNION ALL SELECT dst FROM raw) GROUP BY id),
df AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM raw WHERE src <> dst
                                           UNION ALL SELECT dst FROM raw WHERE src <> dst) GROUP BY id),
pv AS (SELECT dr.id, dr.degree, CASE WHEN df.degree IS NULL THEN dr.degree ELSE df.degree // 2 END AS triangles,
              dr.degree * (dr.degree - 1) // 2 AS triplets FROM dr LEFT JOIN df ON df.id = dr.id),
pl AS (SELECT *, CASE WHEN triplets = 0 THEN 0.0::DOUBLE ELSE triangles::DOUBLE / triplets END AS local FROM pv)
"""


@register("compat_v25_summary", _V25_SQL + _COMPAT_SUMMARY)
def q_compat_v25(spark, sf_dir):
    return _long_triplets(compat.v25_summary(_k(spark, sf_dir)))


@register("compat_v25_per_vertex", _V25_SQL + _COMPAT_ROWS)
def q_compat_v25_per_vertex(spark, sf_dir):
    return _long_triplets(compat.v25_per_vertex(_k(spark, sf_dir)))


_V11_SQL = K + """, loops AS (SELECT DISTINCT src AS id FROM raw WHERE src = dst),
fl AS (SELECT coalesce(d.id, l.id) AS id, coalesce(d.degree, 0) AS sdeg,
              CASE WHEN l.id IS NULL THEN 0 ELSE 1 END AS loop FROM d FULL OUTER JOIN loops l ON d.id = l.id),
ev AS (SELECT r.src, r.dst, CASE WHEN r.src = r.dst THEN fs.sdeg + 1
                                 ELSE coalesce(cn.n_common, 0) + fs.loop + fd.loop END AS val
       FROM raw r JOIN fl fs ON fs.id = r.src JOIN fl fd ON fd.id = r.dst
       LEFT JOIN cn ON cn.u = least(r.src, r.dst) AND cn.v = greatest(r.src, r.dst)),
x AS (SELECT id, sum(val) AS x FROM (SELECT src AS id, val FROM ev UNION ALL SELECT dst, val FROM ev) GROUP BY id),
dr AS (SELECT id, count(*) AS degree FROM (SELECT src AS id FROM raw UNION ALL SELECT dst FROM raw) GROUP BY id),
pv AS (SELECT coalesce(x.x, 0) // 2 AS triangles, dr.degree * (dr.degree - 1) // 2 AS triplets
       FROM dr LEFT JOIN x ON x.id = dr.id)
SELECT CAST(sum(triangles) AS BIGINT) AS triangles, CAST(sum(triplets) AS BIGINT) AS triplets,
       sum(triangles)::DOUBLE / sum(triplets)::DOUBLE AS transitivity FROM pv"""


@register("compat_v11_transitivity", _V11_SQL)
def q_compat_v11(spark, sf_dir):
    return _long_triplets(compat.v11_transitivity(_k(spark, sf_dir)))


@register("common_neighbours_multiset", K + """, m AS (SELECT least(src, dst) AS u, greatest(src, dst) AS v, count(*) AS n
       FROM raw WHERE src <> dst GROUP BY 1, 2),
tm AS (SELECT t.a, t.b, t.c, ab.n AS ab, ac.n AS ac, bc.n AS bc FROM t JOIN m ab ON ab.u = t.a AND ab.v = t.b
       JOIN m ac ON ac.u = t.a AND ac.v = t.c JOIN m bc ON bc.u = t.b AND bc.v = t.c)
SELECT e.u, e.v, CAST(coalesce(k.n, 0) AS BIGINT) AS n_common FROM e LEFT JOIN
  (SELECT u, v, sum(n) AS n FROM (SELECT a AS u, b AS v, least(ac, bc) AS n FROM tm UNION ALL SELECT a, c, least(ab, bc) FROM tm
                                  UNION ALL SELECT b, c, least(ab, ac) FROM tm) GROUP BY u, v) k ON e.u = k.u AND e.v = k.v""")
def q_common_neighbours_multiset(spark, sf_dir):
    return compat.common_neighbours_multiset(_k(spark, sf_dir))
