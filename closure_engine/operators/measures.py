"""Clustering measures: triplets, local, global (transitivity) and average.

Definitions on the simple undirected graph, degree d(v), T(v) triangles on v:

* triplets(v) = d(v)(d(v)-1)/2
* local(v)    = T(v) / triplets(v), 0 when triplets(v) = 0
* global      = sum T(v) / sum triplets(v)  (= 3 * #triangles / #connected triplets)
* average     = sum local(v) / #vertices    (vertices with d < 2 count as 0)

An empty graph (no triplet, no vertex) gives NaN, never a division error.
The average adds up fixed-point values, whose sum doesn't depend on the order of
addition, so reruns and other partitionings give the same bits (its error is
stated at :func:`closure_engine.functions.exprs.exact_mean`).
``triplets`` is a ``decimal(38,0)`` everywhere, as it passes 64 bits at a
degree of about 4.3 billion; sums of it stay exact.
All global values come from one final aggregate over the per-vertex table;
nothing is collected to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closure_engine.functions.exprs import exact_mean, guarded_ratio, int_div, local_ratio, triplets_of, zero
from closure_engine.operators.clean import canonical_edges
from closure_engine.operators.triangles import SkewConfig, prepared, triangle_counts
from closure_engine.operators.triangles import triangles_total as _triangles_total


def _whole(x):
    """A sum of decimals as decimal(38,0), 0 for none."""
    return F.coalesce(x, F.lit(0)).cast("decimal(38,0)")


def triplets_per_vertex(degrees: DataFrame) -> DataFrame:
    return degrees.select("id", triplets_of("degree").alias("triplets"))


def triplets_total(degrees: DataFrame) -> DataFrame:
    return triplets_per_vertex(degrees).agg(_whole(F.sum("triplets")).alias("triplets"))


def _graph_vertices(degrees: DataFrame, vertices: DataFrame | None) -> DataFrame:
    """``(id, degree)`` over endpoints, plus declared vertices (isolated: degree 0)."""
    if vertices is None:
        return degrees
    declared = vertices.select("id").distinct()
    return (declared.join(degrees, "id", "full_outer")
            .select("id", F.coalesce("degree", zero()).alias("degree")))


def local_closure(canonical, vertices: DataFrame | None = None,
                  degrees: DataFrame | None = None, cfg: SkewConfig | None = None) -> DataFrame:
    """Per vertex ``(id, degree, triangles, triplets, local)``.

    ``degrees`` and the triangle counts are both aggregated by ``id``, so the
    final join reuses that hash partitioning instead of shuffling again.
    """
    _, deg, _ = prepared(canonical, degrees)
    tri = triangle_counts(canonical, deg, cfg)
    base = _graph_vertices(deg, vertices)
    j = base.join(tri, "id", "left")
    t = F.coalesce("triangles", zero())
    trip = triplets_of("degree")
    return j.select("id", F.col("degree").cast("bigint").alias("degree"), t.alias("triangles"),
                    trip.alias("triplets"), local_ratio(t, trip).alias("local"))


def summarize(local: DataFrame, average_digits: int | None = None) -> DataFrame:
    """One row: ``n_vertices, n_edges, triangles, triplets, transitivity, average``."""
    n = F.count(F.lit(1))
    sum_t = F.coalesce(F.sum("triangles"), zero())
    sum_p = _whole(F.sum("triplets"))
    avg = exact_mean("local", n)
    if average_digits is not None:
        avg = F.round(avg, average_digits)
    return local.agg(
        n.alias("n_vertices"),
        F.shiftright(F.coalesce(F.sum("degree"), zero()), 1).alias("n_edges"),
        int_div(sum_t, 3).alias("triangles"),
        sum_p.alias("triplets"),
        guarded_ratio(sum_t, sum_p).alias("transitivity"),
        avg.alias("average"),
    )


def transitivity(canonical, degrees: DataFrame | None = None, cfg: SkewConfig | None = None) -> DataFrame:
    """One row ``triangles, triplets, transitivity`` (the global coefficient).

    Needs no per-vertex counts: one sum over the closing step and one over the
    degrees, added up in a single final row.
    """
    _, deg, _ = prepared(canonical, degrees)
    found = _triangles_total(canonical, deg, cfg).select("triangles", F.lit(0).cast("decimal(38,0)").alias("triplets"))
    both = found.unionByName(triplets_total(deg).select(zero().alias("triangles"), "triplets"))
    t, p = F.sum("triangles"), _whole(F.sum("triplets"))
    return both.agg(t.alias("triangles"), p.alias("triplets"), guarded_ratio(3 * t, p).alias("transitivity"))


def average_closure(canonical, vertices: DataFrame | None = None,
                    average_digits: int | None = None) -> DataFrame:
    """One row ``n_vertices, average`` (the mean of the local coefficients)."""
    s = summarize(local_closure(canonical, vertices), average_digits)
    return s.select("n_vertices", "average")


@dataclass
class Closure:
    """Lazy result of :func:`closure`: nothing runs until an action."""

    canonical: DataFrame
    per_vertex: DataFrame
    summary: DataFrame

    def report(self) -> DataFrame:
        """Per-vertex rows with the two global values attached.

        The summary is exactly one row, so broadcasting it is size-bounded by
        construction; it is attached by an equi-join on a constant key, which
        keeps one plan whose shuffles the summary branch reuses (scalar
        subqueries here measured 2x slower: they re-plan the whole graph).
        """
        s = self.summary.select(F.lit(0).alias("_k"), "transitivity", "average")
        return (self.per_vertex.withColumn("_k", F.lit(0))
                .join(F.broadcast(s), "_k").drop("_k"))

    def unpersist(self) -> None:
        self.canonical.unpersist()


def closure(edges, vertices: DataFrame | None = None, src: str = "src", dst: str = "dst",
            materialize: str | None = None, average_digits: int | None = None,
            cfg: SkewConfig | None = None) -> Closure:
    """Everything from a raw edge table: clean once, then local, global and average.

    ``edges`` may also be a stored graph (:mod:`closure_engine.operators.stored`),
    which is already clean and ranked; it takes no ``materialize``.

    Within one action the plan reuses its shuffles, so the edge table is
    read once.  For several actions on the result, ``materialize`` keeps the
    canonical edge set:

    * ``"persist"``: MEMORY_AND_DISK cache; a lost executor's blocks are
      rebuilt from lineage (scan + distinct).  Call ``unpersist()`` after.
    * ``"checkpoint"``: written now (eager) to ``spark.checkpoint.dir``, a
      shared reliable folder on a cluster; the lineage is cut, so later
      jobs and retries start from the written edge set.
    """
    if not isinstance(edges, DataFrame):
        if materialize is not None:
            raise ValueError("a stored graph is kept already")
        per_vertex = local_closure(edges, vertices, cfg=cfg)
        return Closure(edges.canonical, per_vertex, summarize(per_vertex, average_digits))
    canon = canonical_edges(edges, src, dst)
    if materialize == "persist":
        from pyspark import StorageLevel
        canon = canon.persist(StorageLevel.MEMORY_AND_DISK)
    elif materialize == "checkpoint":
        from closure_engine.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(canon.sparkSession)
        canon = canon.checkpoint(eager=True)
    elif materialize is not None:
        raise ValueError("materialize must be None, 'persist' or 'checkpoint'")
    per_vertex = local_closure(canon, vertices, cfg=cfg)
    return Closure(canon, per_vertex, summarize(per_vertex, average_digits))
