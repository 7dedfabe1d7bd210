"""As-coded numbers of the earlier program versions (opt-in ``compat`` mode).

These reproduce what each historical version printed on a dirty multigraph,
as closed forms over DataFrames, for users reconciling old reports.  The
documented measures live in :mod:`closure_engine.operators.measures`.

Every per-edge set intersection below equals the number of triangles on
that edge in the simple graph (plus loop terms), so they reuse
``common_neighbour_counts``, with the raw multiplicity of each undirected
pair summed in the same aggregate: no neighbour arrays and no join of raw
edges back to the pair counts (a repeated hot pair is one row per task
before any shuffle).

* ``v20_summary``: exact-distinct, loop-free edges; multigraph degree;
  T(v) = floor(sum over incident edges of |N(u) & N(v)| / 2);
  global = 3 * sum T / sum triplets; average over the edge endpoints.
* ``v25_summary`` (final version): triplets from the raw multigraph degree
  (a loop adds 2); T(v) = floor(loop-free multigraph degree / 2); a vertex
  with only loops takes T := its degree; global = 3 * sum T / sum triplets.
* ``v11_transitivity``: nothing cleaned; S(x) = neighbour set, with x in it
  when x has a loop; each raw edge sends |S(u) & S(v)| to both ends (a loop
  twice to its vertex); global = sum floor(x / 2) / sum triplets.

Everywhere: ids are cast to bigint before they are compared, and edges with
a null id are dropped.  ``triplets`` is decimal(38,0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closure_engine.functions.exprs import guarded_ratio, local_ratio, triplets_of, zero
from closure_engine.operators.adjacency import degree
from closure_engine.operators.skew import hot_keys, hot_lookup, split_join
from closure_engine.operators.triangles import closing_with_multiplicity, common_neighbour_counts


def _summary(per_vertex: DataFrame, triangle_factor: int, with_average: bool = True) -> DataFrame:
    n = F.count(F.lit(1))
    sum_t = F.coalesce(F.sum("triangles"), zero())
    sum_p = F.coalesce(F.sum("triplets"), F.lit(0)).cast("decimal(38,0)")
    cols = [n.alias("n_vertices"), sum_t.alias("triangles"), sum_p.alias("triplets"),
            guarded_ratio(sum_t * F.lit(triangle_factor), sum_p).alias("transitivity")]
    if with_average:
        cols.append(F.when(n > 0, F.round(F.sum("local") / n, 9)).otherwise(F.lit(float("nan"))).alias("average"))
    return per_vertex.agg(*cols)


def _whole_ids(raw: DataFrame, src: str, dst: str) -> DataFrame:
    """``(src, dst)`` as bigint, without edges that lack an id."""
    return raw.select(F.col(src).cast("bigint").alias("src"), F.col(dst).cast("bigint").alias("dst")).where(
        F.col("src").isNotNull() & F.col("dst").isNotNull())


def _undirected(raw: DataFrame, src: str, dst: str) -> DataFrame:
    """The raw multigraph by undirected pair, loops included: ``(u, v, n, directions)``.

    ``n`` counts the raw edges of the pair, ``directions`` the different
    directed pairs among them (1 for a loop).  Every branch of the compat
    numbers selects from this one aggregate and uses both of its values, which
    the planner then can't prune or push down differently, so all branches
    share one shuffle, the input is scanned once, and a hot repeated pair is
    one row per task before any shuffle.
    """
    s, d = F.col("src"), F.col("dst")
    forth, back = F.max((s <= d).cast("int")), F.max((s > d).cast("int"))
    return (_whole_ids(raw, src, dst)
            .groupBy(F.coalesce(F.least(s, d), zero()).alias("u"), F.coalesce(F.greatest(s, d), zero()).alias("v"))
            .agg(F.count(F.lit(1)).alias("n"), (forth + back).alias("directions"), F.max(s != d).alias("non_loop"))
            .where((F.col("n") > 0) & (F.col("directions") > 0)))


def _pair_sums(pairs: DataFrame) -> DataFrame:
    """Per vertex from ``(u, v, n_common, w)``: ``x`` = sum w * n_common,
    ``mdeg`` = sum w (multigraph degree), ``sdeg`` = simple degree."""
    one = F.lit(1).cast("bigint")
    ends = F.array(F.struct(F.col("u").alias("id"), (F.col("w") * F.col("n_common")).alias("x"), F.col("w").alias("w")),
                   F.struct(F.col("v").alias("id"), (F.col("w") * F.col("n_common")).alias("x"), F.col("w").alias("w")))
    return (pairs.select(F.explode(ends).alias("p")).select("p.id", "p.x", "p.w")
            .groupBy("id").agg(F.sum("x").alias("x"), F.sum("w").cast("bigint").alias("mdeg"), F.sum(one).alias("sdeg")))


def v20_per_vertex(raw: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    # each distinct direction of a pair is one multigraph edge: weight 1 or 2;
    # one aggregate gives |N(u) & N(v)| and that weight, no join back
    pairs = _undirected(raw, src, dst).where("non_loop")
    per = _pair_sums(common_neighbour_counts(pairs.select("u", "v"), weights=pairs.select("u", "v", F.col("directions").alias("w"))))
    t = F.shiftright(F.col("x"), 1)
    trip = triplets_of("mdeg")
    return per.select("id", F.col("mdeg").alias("degree"), t.alias("triangles"), trip.alias("triplets"),
                      local_ratio(t, trip).alias("local"))


def v20_summary(raw: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    return _summary(v20_per_vertex(raw, src, dst), 3)


def v25_per_vertex(raw: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    m = _whole_ids(raw, src, dst).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    free = (F.col("src") != F.col("dst")).cast("int")
    ends = F.array(F.struct(F.col("src").alias("id"), F.col("n").alias("n"), free.alias("free")),
                   F.struct(F.col("dst").alias("id"), F.col("n").alias("n"), free.alias("free")))
    j = (m.select(F.explode(ends).alias("e")).select("e.id", "e.n", "e.free").groupBy("id")
         .agg(F.sum("n").alias("degree"), F.sum(F.col("n") * F.col("free")).alias("free_degree"),
              F.max("free").alias("in_free")))
    # a vertex with only loops is absent from the loop-free graph: T := its degree
    t = F.when(F.col("in_free") == 0, F.col("degree")).otherwise(F.shiftright("free_degree", 1))
    trip = triplets_of("degree")
    return j.select("id", "degree", t.alias("triangles"), trip.alias("triplets"),
                    local_ratio(t, trip).alias("local"))


def v25_summary(raw: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    return _summary(v25_per_vertex(raw, src, dst), 3)


def v11_transitivity(raw: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Closed form of the per-vertex sums (S(x) includes x when x has a loop):

    x(v) = sum_y M(v,y) |N(v) & N(y)|         (M = raw multiplicity of the pair)
         + L(v) * loop-free degree(v)          (v in S(v), and v in N(y))
         + sum_y M(v,y) L(y)                   (y in S(y), and y in N(v))
         + 2 * loops(v) * (simple degree(v) + 1)   (a loop edge sends |S(v)| twice)
    """
    undirected = _undirected(raw, src, dst)
    pairs = undirected.where("non_loop").select("u", "v", F.col("n").alias("w"))
    canon = pairs.select("u", "v")
    per = _pair_sums(common_neighbour_counts(canon, weights=pairs))
    loops = undirected.where("not non_loop").select(F.col("u").alias("id"), F.col("n").alias("n_loop"))
    # sum_y M(v,y) L(y): half-pairs meet the loop table on y (hub y split off)
    half = pairs.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.col("v").alias("y"), "w"),
                                          F.struct(F.col("v").alias("id"), F.col("u").alias("y"), "w"))).alias("h")
                        ).select("h.id", "h.y", "h.w")
    loop_y = loops.select(F.col("id").alias("y"), F.lit(1).alias("is_loop"))
    # y's frequency among half-pairs is its simple degree (same plan as the triangle step's)
    hubs = hot_keys(degree(canon, "u", "v"), "id", "degree").select(F.col("id").alias("y"))
    near_loop = (split_join(half, loop_y, "y", hot_lookup(loop_y, "y", hubs))
                 .groupBy("id").agg(F.sum("w").alias("c")))
    v = (per.join(loops, "id", "full_outer").join(near_loop, "id", "left")
         .select(F.coalesce("x", zero()).alias("x"), F.coalesce("mdeg", zero()).alias("mdeg"),
                 F.coalesce("sdeg", zero()).alias("sdeg"), F.coalesce("n_loop", zero()).alias("n_loop"),
                 F.coalesce("c", zero()).alias("c")))
    has_loop = F.when(F.col("n_loop") > 0, 1).otherwise(0)
    total = (F.col("x") + has_loop * F.col("mdeg") + F.col("c")
             + F.lit(2) * F.col("n_loop") * (F.col("sdeg") + 1))
    raw_degree = F.col("mdeg") + F.lit(2) * F.col("n_loop")
    per_vertex = v.select(F.shiftright(total, 1).alias("triangles"), triplets_of(raw_degree).alias("triplets"))
    return _summary(per_vertex, 1, with_average=False).select("triangles", "triplets", "transitivity")


def common_neighbours_multiset(raw: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(u, v, n_common)`` per simple edge: the size of the multiset intersection of both neighbour lists.

    The lists are those of the loop-free multigraph, so a common neighbour w
    counts min(multiplicity of u-w, multiplicity of v-w) times.  The closing
    step's list entries carry the multiplicities, so a triangle comes with the
    three of its pairs and nothing is looked up afterwards.
    """
    pairs = _undirected(raw, src, dst).where("non_loop").select("u", "v", F.col("n").alias("w"))
    found = closing_with_multiplicity(pairs)

    def edge(u, v, n):
        return F.struct(F.least(u, v).alias("u"), F.greatest(u, v).alias("v"), n.alias("n"))

    a, b, ab = F.col("a"), F.col("b"), F.col("ab")
    own = F.array(edge(a, b, F.aggregate("common", zero(), lambda s, x: s + F.least(x["ac"], x["bc"]))))
    via_a = F.transform("common", lambda x: edge(a, x["c"], F.least(ab, x["bc"])))
    via_b = F.transform("common", lambda x: edge(b, x["c"], F.least(ab, x["ac"])))
    counts = found.select(F.explode(F.concat(own, via_a, via_b)).alias("e")).select("e.u", "e.v", "e.n")
    none = pairs.select("u", "v", F.when(F.col("w") > 0, zero()).alias("n"))
    return none.unionByName(counts).groupBy("u", "v").agg(F.sum("n").alias("n_common"))
