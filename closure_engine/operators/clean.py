"""Edge cleaning: loops, exact repeats, and the undirected canonical edge set.

Every documented measure is defined on the simple undirected graph, so all of
them go through ``canonical_edges`` once.  ``distinct`` runs as a partial
(map-side) aggregate before its shuffle, so a pair repeated millions of times
is collapsed inside each task before anything moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_loops(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    return edges.where(F.col(src) != F.col(dst))


def drop_exact_duplicates(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Remove repeats of the same directed ``(src, dst)``; (a,b) and (b,a) both stay."""
    return edges.select(src, dst).distinct()


def canonical_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Simple undirected edge set ``(u, v)`` with ``u < v``: no loop, no repeat, no null id.

    Ids are compared as ``bigint``, so text ids like ``"1"`` and ``"01"`` are the same vertex.
    """
    s, d = F.col(src).cast("bigint"), F.col(dst).cast("bigint")
    # Ids are never null past the filter; the coalesce only tells the planner
    # so (non-nullable columns), which keeps it from inferring different
    # isnotnull filters in each branch that reuses this set; identical
    # branches then share one shuffle instead of rescanning the input.
    zero = F.lit(0).cast("bigint")
    return (edges.where(s.isNotNull() & d.isNotNull() & (s != d))
            .select(F.coalesce(F.least(s, d), zero).alias("u"),
                    F.coalesce(F.greatest(s, d), zero).alias("v"))
            .distinct())
