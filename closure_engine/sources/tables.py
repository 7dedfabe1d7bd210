"""Graphs read from the driver's Parquet tables.

* ``supply_edges`` (graph K): one raw edge per line item,
  ``l_partkey -> l_suppkey``, both keys read as one id space.  It is dirty on
  purpose: exact repeats, reciprocal pairs and self-loops.
* ``customer_supplier_edges`` (graph B): ``o_custkey -> 1000000 + l_suppkey``
  through ``orders``; bipartite, so it must have no triangle.  ``orders`` is
  keyed by ``o_orderkey``, so the join is one-to-many and its output is
  exactly one edge per line item.  Both sides come straight from a scan, so
  AQE's skew join splits an order with a huge share of the line items; order
  keys are near-unique, so looking for hot ones first would shuffle as much
  as the join itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closure_engine.sources.columns import edges_from_columns

SUPPLIER_OFFSET = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def supply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges_from_columns(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


def customer_supplier_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey")
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_suppkey")
    return edges_from_columns(items.join(orders, "k"), "o_custkey", "l_suppkey", dst_offset=SUPPLIER_OFFSET)
