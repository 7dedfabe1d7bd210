"""Named graphs over the driver tables, for Spark and for the SQL oracle.

Each graph is a raw edge relation ``(src, dst)`` read from the tables; the
SQL text is the same relation for DuckDB, so oracle and Spark agree on the
input by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from closure_engine.sources.tables import SUPPLIER_OFFSET, customer_supplier_edges, supply_edges

RAW_SQL = {
    # K: one dirty edge per line item, part key -> supplier key, one id space
    "K": "SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem",
    # B: customer -> supplier (offset), bipartite, no triangle
    "B": ("SELECT o.o_custkey AS src, l.l_suppkey + " + str(SUPPLIER_OFFSET) + " AS dst "
          "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"),
}


def raw_edges(spark: SparkSession, sf_dir: str, graph: str) -> DataFrame:
    if graph == "K":
        return supply_edges(spark, sf_dir)
    if graph == "B":
        return customer_supplier_edges(spark, sf_dir)
    raise KeyError(graph)


def sql_prefix(graph: str) -> str:
    """CTEs shared by the oracles: raw, e (canonical), d (degree), t (triangles a<b<c),
    tv (triangles per vertex), lc (per-vertex local), cn (common neighbours per edge)."""
    return f"""WITH raw AS ({RAW_SQL[graph]}),
e AS (SELECT DISTINCT least(src, dst) AS u, greatest(src, dst) AS v FROM raw
      WHERE src IS NOT NULL AND dst IS NOT NULL AND src <> dst),
d AS (SELECT id, count(*) AS degree FROM (SELECT u AS id FROM e UNION ALL SELECT v AS id FROM e) GROUP BY id),
t AS (SELECT x.u AS a, x.v AS b, y.v AS c FROM e x JOIN e y ON x.u = y.u AND x.v < y.v
      JOIN e z ON z.u = x.v AND z.v = y.v),
tv AS (SELECT id, count(*) AS triangles
       FROM (SELECT a AS id FROM t UNION ALL SELECT b FROM t UNION ALL SELECT c FROM t) GROUP BY id),
lc AS (SELECT d.id, d.degree, coalesce(tv.triangles, 0) AS triangles,
              d.degree * (d.degree - 1) // 2 AS triplets
       FROM d LEFT JOIN tv ON d.id = tv.id),
lcl AS (SELECT *, CASE WHEN triplets = 0 THEN 0.0::DOUBLE ELSE triangles::DOUBLE / triplets END AS local
        FROM lc),
cn AS (SELECT e.u, e.v, coalesce(k.n, 0) AS n_common FROM e LEFT JOIN
         (SELECT u, v, count(*) AS n FROM (SELECT a AS u, b AS v FROM t UNION ALL SELECT a, c FROM t
                                           UNION ALL SELECT b, c FROM t) GROUP BY u, v) k
         ON e.u = k.u AND e.v = k.v)
"""
