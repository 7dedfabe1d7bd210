"""Triangles on the simple undirected graph, by degree orientation.

Plan (all built-in DataFrame operators):

1. ``orient``: each canonical edge points from the endpoint of lower rank to
   the higher, rank = ``(degree, id)``.  A vertex with out-degree k has k
   out-neighbours of degree >= k, so ``k * k <= 2m``: every out-list is at
   most ``sqrt(2m)`` ids, however skewed the degrees are.  Hubs have large
   *in*-degree and a short out-list.
2. ``closing``: out-lists are kept in rank order and cut into blocks of at
   least ``wide`` ids and at least the square root of the list's length, each
   with the ranks of its first and last id as fences.  Short runs of a list,
   each with a block that comes after it, are spread over the tasks; there, each
   edge ``a -> b`` of a run carries the part of the block that comes after
   ``b``.  That part meets those blocks of ``N+(b)`` whose fences overlap its
   own, and ``array_intersect`` gives every ``c`` with ``a -> c`` and
   ``b -> c``, so each triangle is found exactly once, at the edge joining its
   two lowest-ranked vertices.
3. Per-vertex and per-edge counts come from ``size(common)`` for the two
   edge ends plus one row per closing vertex, summed with partial
   (map-side) aggregation.

Cost: the parts shipped to ``b`` add up to the sum of out(a)^2 / 2 ids,
O(m^1.5) in the worst case, which is the known bound of listing triangles;
they travel as arrays of one block.  The blocks of one list have disjoint
ranges of ranks, so the P parts of an edge overlap the Q blocks of ``N+(b)`` in
fewer than P + Q places: an edge hashes and probes O(out(a) + out(b)) ids, and
where both lists have one block it does so once.  It compares P * Q pairs of
fences, and as a block has at least the square root of its list's length, that
is O(out(a) + out(b)) as well.

Edges may carry a multiplicity; the list entries then carry it too, and the
closing step yields every triangle with its three multiplicities, without a
look-up afterwards.

Skew: a hub may touch a third of all edges.  The degree lookups of the
orientation are split joins (hub rows read a broadcast hub table whose size
is bounded by construction).  A long out-list is spread by its runs, so that no
row of the spread makes more than ``max(block^2, wide)`` ids.  The join that
brings the blocks of ``N+(b)`` to the in-edges of ``b`` is salted by ``b``'s
degree, which every edge carries.  Every group-by is a partial aggregate, so
hot ids are combined map-side before any shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closure_engine.functions.exprs import sort3
from closure_engine.operators import skew
from closure_engine.operators.adjacency import degree as _degree


@dataclass(frozen=True)
class SkewConfig:
    """Hot-vertex handling (see :mod:`closure_engine.operators.skew`).

    ``max_hot`` bounds the broadcast hub table of the degree lookups,
    ``min_hot_rows`` is the smallest degree that can make a hub,
    ``split_rows`` is the number of in-edges of one vertex handled per salted
    group in the closing join, ``block`` is the most ids of a run of an
    out-list that are dealt out together (fewer where the list is long), and
    ``wide`` the ids of a block of an out-list (longer lists have blocks of the
    square root of their length).
    """

    max_hot: int = skew.MAX_HOT_KEYS
    min_hot_rows: int = skew.MIN_HOT_ROWS
    split_rows: int = skew.SPLIT_ROWS
    block: int = 64
    wide: int = 1 << 12


def hub_vertices(degrees: DataFrame, cfg: SkewConfig | None = None) -> DataFrame:
    """``(id, degree)`` of hubs: at most ``cfg.max_hot`` rows, chosen lazily."""
    cfg = cfg or SkewConfig()
    return skew.hot_keys(degrees, "id", "degree", cfg.max_hot, cfg.min_hot_rows)


def orient(canonical: DataFrame, degrees: DataFrame | None = None, cfg: SkewConfig | None = None,
           hubs: DataFrame | None = None) -> DataFrame:
    """Oriented edges ``(a, b, da, db)``: ``a`` precedes ``b`` in ``(degree, id)`` order.

    A column ``w`` of ``canonical`` (an edge's multiplicity) is kept.  Both degree lookups are split joins: edges of hub endpoints read the
    broadcast hub table, all others shuffle-join the degree table.
    """
    deg = degrees if degrees is not None else _degree(canonical, "u", "v")
    hubs = hubs if hubs is not None else hub_vertices(deg, cfg)

    def side(name: str, deg_name: str) -> tuple[DataFrame, DataFrame]:
        cols = [F.col("id").alias(name), F.col("degree").alias(deg_name)]
        return deg.select(*cols), hubs.select(*cols)

    du, hu = side("u", "du")
    dv, hv = side("v", "dv")
    j = skew.split_join(skew.split_join(canonical, du, "u", hu), dv, "v", hv)
    u_first = (F.col("du") < F.col("dv")) | ((F.col("du") == F.col("dv")) & (F.col("u") < F.col("v")))
    pick = lambda x, y: F.when(u_first, F.col(x)).otherwise(F.col(y))
    return j.select(pick("u", "v").alias("a"), pick("v", "u").alias("b"),
                    pick("du", "dv").alias("da"), pick("dv", "du").alias("db"), *[c for c in canonical.columns if c == "w"])


def _shuffle_width(spark) -> int:
    """Initial shuffle width: AQE's ``initialPartitionNum`` when the cluster
    sets one (it then coalesces from there), else ``spark.sql.shuffle.partitions``."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial) if initial else int(spark.conf.get("spark.sql.shuffle.partitions"))


def out_lists(oriented: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """``(a, da, out)``: out-neighbours ``(d, id[, w])`` of each vertex in rank order, at most sqrt(2m).

    Hash-partitioned by ``a`` into an explicit number of partitions (default:
    the session's initial shuffle width, see ``_shuffle_width``).  AQE would
    otherwise coalesce them by bytes, but the intersection work that follows
    grows with the square of the list lengths, not with their bytes.
    """
    n = num_partitions or _shuffle_width(oriented.sparkSession)
    entry = [F.col("db").alias("d"), F.col("b").alias("id"), *[F.col(c) for c in oriented.columns if c == "w"]]
    ranked = F.array_sort(F.collect_list(F.struct(*entry)))
    return oriented.repartition(n, "a").groupBy("a").agg(F.max("da").alias("da"), ranked.alias("out"))


def _weighted(lists: DataFrame) -> bool:
    return "w" in lists.schema["out"].dataType.elementType.names


def _with_blocks(lists: DataFrame, wide: int) -> DataFrame:
    """``lists`` with ``blocks`` of ``width`` entries: the list cut in rank order, at least ``wide`` and sqrt(length) each."""
    cut = lists.withColumn("width", F.greatest(F.lit(wide), F.ceil(F.sqrt(F.size("out"))).cast("int")))
    last = F.floor((F.size("out") - 1) / F.col("width")).cast("int")
    return cut.withColumn("blocks", F.transform(F.sequence(F.lit(0), last), lambda q: F.slice("out", q * F.col("width") + 1, F.col("width"))))


def _fenced(entries, weighted: bool):
    """``(ids[, ws], lo, hi)`` of a block: its ids and the ranks of the first and the last one."""
    first, last = F.element_at(entries, 1), F.element_at(entries, -1)
    rank = lambda e: F.struct(e["d"].alias("d"), e["id"].alias("id"))
    ws = [F.transform(entries, lambda x: x["w"]).alias("ws")] * weighted
    return F.struct(F.transform(entries, lambda x: x["id"]).alias("ids"), *ws, rank(first).alias("lo"), rank(last).alias("hi"))


def list_tails(lists: DataFrame, block: int, num_partitions: int, wide: int | None = None) -> DataFrame:
    """``(a, b, db, tail, lo, hi[, w, ws])``: for each edge, the ids after ``b`` in ``a``'s list, at most a block of it a row.

    ``lo`` and ``hi`` are ranks that enclose the tail's; ``w`` is the edge's
    multiplicity, ``ws`` those of the tail's edges.  Blocks have ``wide`` ids
    (default: ``block``).  Runs of at most ``block`` edges, fewer where the list
    is long, are dealt out with each block that holds an id after them, by ``(a,
    run, block)``, before any edge is made of them.
    """
    weighted = _weighted(lists)
    wide = wide or block
    most = F.floor(F.lit(block * block) / F.least(F.size("out"), F.lit(wide))).cast("int")
    cut = _with_blocks(lists, wide).withColumn("run", F.greatest(F.lit(1), F.least(F.lit(block), most)))
    starts = F.sequence(F.lit(0), F.size("out") - 1, F.col("run"))
    firsts = cut.select("a", "out", "blocks", "width", "run", F.explode(starts).alias("start"))
    own = F.floor(F.col("start") / F.col("width")).cast("int")
    rights = F.transform(F.slice("blocks", own + 1, F.size("blocks")), lambda part: _fenced(part, weighted))
    runs = firsts.select("a", "start", "width", own.alias("own"), F.slice("out", F.col("start") + 1, F.col("run")).alias("left"), rights.alias("rights"))
    pairs = runs.select("a", "start", "width", "own", "left", F.posexplode("rights").alias("step", "right")).repartition(num_partitions, "a", "start", "step")
    edges = pairs.select("a", ((F.col("own") + F.col("step")) * F.col("width")).alias("begin"), "start", "right", F.posexplode("left").alias("pos", "e"))
    skip = F.col("start") + F.col("pos") + 1 - F.col("begin")  # ids of the block up to b
    after = lambda x: F.when(skip > 0, F.slice(x, skip + 1, F.size(x))).otherwise(x)
    b_rank = F.struct(F.col("e.d").alias("d"), F.col("e.id").alias("id"))
    tails = edges.select("a", F.col("e.id").alias("b"), F.col("e.d").alias("db"), after(F.col("right.ids")).alias("tail"),
                         F.when(skip > 0, b_rank).otherwise(F.col("right.lo")).alias("lo"), F.col("right.hi").alias("hi"),
                         *[F.col("e.w").alias("w"), after(F.col("right.ws")).alias("ws")] * weighted)
    return tails.where(F.size("tail") > 0)


def _not_before(x, y):
    """Rank ``x`` is ``y`` or comes after it; compared field by field, which the join's generated code does without objects."""
    return (x["d"] > y["d"]) | ((x["d"] == y["d"]) & (x["id"] >= y["id"]))


def prepared(canonical, degrees: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(canonical edges, degrees, out-lists) of canonical edges, or of a stored graph, which has all three.

    The out-lists of plain edges are None: they are made where they are needed.
    """
    if isinstance(canonical, DataFrame):
        return canonical, degrees if degrees is not None else _degree(canonical, "u", "v"), None
    return canonical.canonical, canonical.degrees, canonical.lists


def block_meetings(canonical, degrees: DataFrame | None = None, cfg: SkewConfig | None = None,
                   num_partitions: int | None = None) -> DataFrame:
    """``(a, b, tail, ids[, w, ws, block_ws])``: parts of ``a``'s list after ``b`` with the blocks of ``N+(b)`` whose ranks overlap.

    They meet on ``(b, salt)``: ``b`` has ``1 + degree // split_rows`` salts, its
    in-edges are spread over that many groups by a hash of ``a``, and its blocks
    are copied once per salt.
    """
    cfg = cfg or SkewConfig()
    edges, deg, lists = prepared(canonical, degrees)
    n = num_partitions or _shuffle_width(edges.sparkSession)
    if lists is None:
        lists = out_lists(orient(edges, deg, cfg), n)
    weighted = _weighted(lists)
    tails = list_tails(lists, cfg.block, n, cfg.wide).withColumn(
        "salt", F.pmod(F.xxhash64("a"), skew.n_salts(F.col("db"), cfg.split_rows)).cast("int")).drop("db")
    salted = _with_blocks(lists, cfg.wide).select(
        F.col("a").alias("b"), "blocks", F.explode(F.sequence(F.lit(0), skew.n_salts(F.col("da"), cfg.split_rows) - 1)).alias("salt"))
    cut = salted.select("b", "salt", F.explode(F.transform("blocks", lambda part: _fenced(part, weighted))).alias("block"))
    blocks = cut.select("b", "salt", "block.ids", F.col("block.lo").alias("first"), F.col("block.hi").alias("last"),
                        *[F.col("block.ws").alias("block_ws")] * weighted)
    # Sort-merge, never broadcast: the planner sizes the edge side from the
    # out-list stage *before* the explode, which underestimates it by the
    # mean tail length, so an automatic broadcast here would be unbounded.
    x, y = tails.alias("x"), blocks.hint("merge").alias("y")
    overlap = _not_before(F.col("hi"), F.col("first")) & _not_before(F.col("last"), F.col("lo"))
    met = x.join(y, (F.col("x.b") == F.col("y.b")) & (F.col("x.salt") == F.col("y.salt")) & overlap)
    return met.select("a", "x.b", "tail", "ids", *["w", "ws", "block_ws"] * weighted)


def closing(canonical, degrees: DataFrame | None = None, cfg: SkewConfig | None = None,
            num_partitions: int | None = None) -> DataFrame:
    """``(a, b, common)``: the vertices ``common`` close a triangle with the oriented edge a->b.

    ``canonical``, here and below: canonical edges, or a stored graph
    (:mod:`closure_engine.operators.stored`), whose out-lists are then read.

    An edge has a row for each pair of overlapping blocks that share such a
    vertex, and each vertex stands in one of them.
    """
    met = block_meetings(canonical, degrees, cfg, num_partitions)
    return met.select("a", "b", F.array_intersect("tail", "ids").alias("common")).where(F.size("common") > 0)


def closing_with_multiplicity(pairs: DataFrame, degrees: DataFrame | None = None, cfg: SkewConfig | None = None,
                              num_partitions: int | None = None) -> DataFrame:
    """``(a, b, ab, common)`` from canonical edges ``(u, v, w)``: as :func:`closing`, with multiplicities.

    ``ab`` is that of the edge a->b, an element of ``common`` is ``(c, ac, bc)``.
    A found vertex reads its two multiplicities at its place in the two blocks.
    """
    met = block_meetings(pairs, degrees, cfg, num_partitions)
    found = met.withColumn("common", F.array_intersect("tail", "ids")).where(F.size("common") > 0)

    def at(weights: str, ids: str, c):
        return F.element_at(F.col(weights), F.array_position(F.col(ids), c).cast("int"))

    return found.select("a", "b", F.col("w").alias("ab"), F.transform("common", lambda c: F.struct(
        c.alias("c"), at("ws", "tail", c).alias("ac"), at("block_ws", "ids", c).alias("bc"))).alias("common"))


def triangle_list(canonical, degrees: DataFrame | None = None,
                  cfg: SkewConfig | None = None) -> DataFrame:
    """Every triangle once, as ``(a, b, c)`` with ``a < b < c``."""
    t = closing(canonical, degrees, cfg).select("a", "b", F.explode("common").alias("c"))
    x, y, z = sort3("a", "b", "c")
    return t.select(x.alias("a"), y.alias("b"), z.alias("c"))


def _vertex_contributions(close: DataFrame) -> DataFrame:
    k = F.size("common").cast("bigint")
    ends = F.array(F.struct(F.col("a").alias("id"), k.alias("n")),
                   F.struct(F.col("b").alias("id"), k.alias("n")))
    thirds = F.transform("common", lambda c: F.struct(c.alias("id"), F.lit(1).cast("bigint").alias("n")))
    return close.select(F.explode(F.concat(ends, thirds)).alias("m")).select("m.id", "m.n")


def triangle_counts(canonical, degrees: DataFrame | None = None,
                    cfg: SkewConfig | None = None) -> DataFrame:
    """``(id, triangles)`` for vertices on at least one triangle (no zero rows)."""
    return (_vertex_contributions(closing(canonical, degrees, cfg))
            .groupBy("id").agg(F.sum("n").alias("triangles")))


def triangles_per_vertex(canonical, degrees: DataFrame | None = None,
                         cfg: SkewConfig | None = None) -> DataFrame:
    """``(id, triangles)`` for every vertex of the graph, 0 when on no triangle."""
    _, deg, _ = prepared(canonical, degrees)
    t = triangle_counts(canonical, deg, cfg)
    return (deg.select("id").join(t, "id", "left")
            .select("id", F.coalesce("triangles", F.lit(0).cast("bigint")).alias("triangles")))


def triangles_total(canonical, degrees: DataFrame | None = None,
                    cfg: SkewConfig | None = None) -> DataFrame:
    """One row ``triangles``: the number of distinct triangles (sum of intersection sizes)."""
    return (closing(canonical, degrees, cfg)
            .agg(F.coalesce(F.sum(F.size("common").cast("bigint")), F.lit(0).cast("bigint")).alias("triangles")))


def common_neighbours(canonical, degrees: DataFrame | None = None,
                      cfg: SkewConfig | None = None) -> DataFrame:
    """Long form of ``N(u) & N(v)`` per edge: ``(u, v, w)`` for each common neighbour w.

    Each triangle ``a<b<c`` gives its three edges their third vertex.
    """
    t = triangle_list(canonical, degrees, cfg)
    rows = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v"), F.col("c").alias("w")),
                   F.struct(F.col("a").alias("u"), F.col("c").alias("v"), F.col("b").alias("w")),
                   F.struct(F.col("b").alias("u"), F.col("c").alias("v"), F.col("a").alias("w")))
    return t.select(F.explode(rows).alias("r")).select("r.u", "r.v", "r.w")


def common_neighbour_counts(canonical, degrees: DataFrame | None = None,
                            cfg: SkewConfig | None = None, weights: DataFrame | None = None) -> DataFrame:
    """``(u, v, n_common)`` = |N(u) & N(v)| for every canonical edge, 0 included.

    The edge ``a->b`` holds ``size(common)``; each closing ``c`` adds 1 to
    ``(a,c)`` and ``(b,c)``.  Union with all edges at 0, then one partial
    aggregate: no join back to the edge set.

    ``weights`` (rows ``u, v, w`` with ``u < v``, covering every canonical
    edge, repeats allowed) replaces the zero rows; the result then also has
    ``w`` summed per edge, from the same aggregate.
    """
    close = closing(canonical, degrees, cfg)
    k = F.size("common").cast("bigint")
    one = F.lit(1).cast("bigint")

    def edge(x, y, n):
        return F.struct(F.least(x, y).alias("u"), F.greatest(x, y).alias("v"), n.alias("n"))

    own = F.array(edge(F.col("a"), F.col("b"), k))
    via_a = F.transform("common", lambda c: edge(F.col("a"), c, one))
    via_b = F.transform("common", lambda c: edge(F.col("b"), c, one))
    contrib = close.select(F.explode(F.concat(own, via_a, via_b)).alias("e")).select("e.u", "e.v", "e.n")
    zero = F.lit(0).cast("bigint")
    if weights is None:
        zeros = prepared(canonical, degrees)[0].select("u", "v", zero.alias("n"))
        return zeros.unionByName(contrib).groupBy("u", "v").agg(F.sum("n").alias("n_common"))
    base = weights.select("u", "v", zero.alias("n"), F.col("w").cast("bigint").alias("w"))
    return (base.unionByName(contrib.withColumn("w", zero)).groupBy("u", "v")
            .agg(F.sum("n").alias("n_common"), F.sum("w").alias("w")))


def common_neighbour_sums(canonical, degrees: DataFrame | None = None,
                          cfg: SkewConfig | None = None) -> DataFrame:
    """``(id, n_common_sum)``: sum over a vertex's edges of |N(u) & N(v)| (= 2 T(v))."""
    per_edge = common_neighbour_counts(canonical, degrees, cfg)
    ends = F.array(F.col("u"), F.col("v"))
    return (per_edge.select(F.explode(ends).alias("id"), "n_common")
            .groupBy("id").agg(F.sum("n_common").alias("n_common_sum")))


def triangles_by_intersect(canonical, degrees: DataFrame | None = None,
                           cfg: SkewConfig | None = None) -> DataFrame:
    """``(id, triangles)`` as half the common-neighbour sum (must equal triangles_per_vertex)."""
    return common_neighbour_sums(canonical, degrees, cfg).select(
        "id", F.shiftright(F.col("n_common_sum"), 1).alias("triangles"))
