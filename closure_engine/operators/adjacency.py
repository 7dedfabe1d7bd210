"""Degrees and neighbourhoods.

Neighbourhoods are returned in long form, one row per (vertex, neighbour):
a hub's neighbourhood is then spread over many rows and partitions instead of
being one array that grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def half_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Both directions of every edge as ``(id, neighbour)``; a loop yields (v, v) twice."""
    s, d = F.col(src), F.col(dst)
    return edges.select(F.explode(F.array(F.struct(s.alias("id"), d.alias("neighbour")),
                                          F.struct(d.alias("id"), s.alias("neighbour")))).alias("h")
                        ).select("h.id", "h.neighbour")


def degree(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Total degree ``(id, degree)``; on a multigraph a loop adds 2, as each end counts.

    Partial aggregation counts inside each task before the shuffle, so a hub
    vertex costs one row per task, not one per edge.
    """
    return (edges.select(F.explode(F.array(F.col(src), F.col(dst))).alias("id"))
            .groupBy("id").agg(F.count(F.lit(1)).alias("degree")))


def neighbour_list(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Neighbour multiset of a raw multigraph: ``(id, neighbour, multiplicity)``.

    Repeats are kept as a multiplicity (pre-aggregated before the shuffle),
    so the list length of a vertex is ``sum(multiplicity)``.
    """
    return (half_edges(edges, src, dst).groupBy("id", "neighbour")
            .agg(F.count(F.lit(1)).alias("multiplicity")))


def neighbour_set(canonical: DataFrame) -> DataFrame:
    """Neighbour set of the simple graph: ``(id, neighbour)``, no aggregation needed."""
    return half_edges(canonical, "u", "v")
