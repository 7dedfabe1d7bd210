"""The original programs' jobs as library calls (no hard-coded paths).

* ``global_coefficient``: global coefficient only, from an edge table
  (the two 1.x programs on their inline graph).
* ``closure_from_text``: text edge list -> per-vertex local values, global
  and average (the 2.x programs and the final version).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from closure_engine.operators.clean import canonical_edges
from closure_engine.operators.measures import Closure, closure, transitivity
from closure_engine.sources.text import read_edge_text


def global_coefficient(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """One row ``triangles, triplets, transitivity``."""
    return transitivity(canonical_edges(edges, src, dst))


def closure_from_text(spark: SparkSession, path: str, sep_regex: str = r"\s+", mode: str = "strict",
                      num_partitions: int | None = None, **kwargs) -> Closure:
    """Read a text edge list and compute every measure (lazy :class:`Closure`)."""
    return closure(read_edge_text(spark, path, sep_regex, mode, num_partitions), **kwargs)
