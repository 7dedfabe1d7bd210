"""Property-graph views over a pair of DataFrames ``vertices(id, ...)`` and ``edges``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def endpoints(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct vertex ids touched by an edge (``id``); partial-aggregated distinct."""
    return edges.select(F.explode(F.array(F.col(src), F.col(dst))).alias("id")).distinct()


def vertices_from_edges(edges: DataFrame, default=None, src: str = "src", dst: str = "dst",
                        attr: str = "attr", attr_type: str | None = None) -> DataFrame:
    """Vertex table of a graph built from edges only: every endpoint with a default attr."""
    value = F.lit(default)
    if attr_type:
        value = value.cast(attr_type)
    return endpoints(edges, src, dst).select("id", value.alias(attr))


def repeated_ids(vertices: DataFrame, id: str = "id") -> DataFrame:
    """``(id, rows)`` of the ids that stand in more than one row; ``.isEmpty()`` of it is the uniqueness check.

    One partial aggregate over the id column only.
    """
    return vertices.groupBy(id).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def one_per_id(vertices: DataFrame, id: str = "id", merge: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """The vertex table with one row an id: a graph holds one value a vertex.

    ``merge`` names a built-in aggregate for an attribute (``{"seen": F.max,
    "total": F.sum}``).  An attribute it doesn't name takes its largest value
    that isn't null, so the result doesn't depend on the order of rows; as that is taken
    attribute by attribute, it may come from different rows.  Rows without an id are
    dropped, as no edge can reach them.  One partial aggregate: an id
    repeated a billion times is one row per task before the shuffle.
    """
    merge = merge or {}
    unknown = set(merge) - set(vertices.columns)
    if unknown:
        raise ValueError(f"no such attributes: {sorted(unknown)}")
    attrs = [c for c in vertices.columns if c != id]
    known = vertices.where(F.col(id).isNotNull())
    if not attrs:
        return known.select(id).distinct()
    return known.groupBy(id).agg(*[merge.get(c, F.max)(F.col(c)).alias(c) for c in attrs])


def with_vertices(edges: DataFrame, vertices: DataFrame, src: str = "src", dst: str = "dst",
                  id: str = "id", merge: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Vertex set of ``Graph(vertices, edges)``: declared vertices plus every endpoint, one row an id.

    Declared vertices keep their attributes (isolated ones too); repeated ones
    are merged by :func:`one_per_id`.  Endpoints that were not declared get null
    attributes.
    """
    ends = endpoints(edges, src, dst).withColumnRenamed("id", id)
    return one_per_id(vertices, id, merge).join(ends, id, "full_outer").select(*vertices.columns)


def join_vertices(left: DataFrame, right: DataFrame, value: str, new_value: str | None = None,
                  merge=None, id: str = "id") -> DataFrame:
    """Update ``left.value`` from ``right``; vertices without a match keep the old value.

    ``merge(old, new)`` combines matched values (default: take the new one).
    Output: ``id, old, new, merged`` plus nothing else, so callers project.
    """
    new_value = new_value or value
    r = right.select(F.col(id), F.col(new_value).alias("new"))
    j = left.select(F.col(id), F.col(value).alias("old")).join(r, id, "left")
    matched = F.col("new") if merge is None else merge(F.col("old"), F.col("new"))
    merged = F.when(F.col("new").isNull(), F.col("old")).otherwise(matched)
    return j.select(id, "old", "new", merged.alias("merged"))


# Attribute types whose values have a bounded width, so that a table of at most MAX_HOT_KEYS rows is small.
_NARROW = ("bigint", "int", "smallint", "tinyint", "double", "float", "boolean", "date", "timestamp")


def triplet_view(edges: DataFrame, vertices: DataFrame, src: str = "src", dst: str = "dst",
                 id: str = "id", attrs: list[str] | None = None, skew_safe: bool = True,
                 hubs: DataFrame | None = None, unique: bool = False,
                 merge: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Each edge with both endpoints' attributes as ``src_<attr>`` / ``dst_<attr>``.

    Two equi-joins on the vertex id; edges whose endpoint has no row keep null
    attributes.  Repeated ids are merged by :func:`one_per_id` first, so an edge
    stays one row; ``unique=True`` says that there are none and saves the step.  With ``skew_safe`` and
    attributes of bounded width, the hub endpoints (bounded set, from the
    edge degrees) read a broadcast copy of their rows.  Wider attributes
    (text, arrays) are never broadcast: each hub's row is copied once per
    salt and its edges are spread over the salts.  ``hubs`` (``id`` column,
    bounded) may be passed in when the same edges are viewed repeatedly.
    """
    from closure_engine.operators import skew
    from closure_engine.operators.adjacency import degree

    attrs = attrs if attrs is not None else [c for c in vertices.columns if c != id]
    if not unique:
        vertices = one_per_id(vertices.select(id, *attrs), id, {k: f for k, f in (merge or {}).items() if k in attrs})
    sv = vertices.select(F.col(id).alias(src), *[F.col(a).alias(f"{src}_{a}") for a in attrs])
    dv = vertices.select(F.col(id).alias(dst), *[F.col(a).alias(f"{dst}_{a}") for a in attrs])
    if not skew_safe:
        return edges.join(sv, src, "left").join(dv, dst, "left")
    kinds = dict(vertices.dtypes)
    if not all(kinds[a] in _NARROW for a in attrs):
        salts = degree(edges, src, dst).select("id", skew.n_salts(F.col("degree")).alias("_salts")).where("_salts > 1")
        return skew.salted_join(skew.salted_join(edges, sv, src, salts), dv, dst, salts)
    if hubs is None:
        hubs = skew.hot_keys(degree(edges, src, dst), "id", "degree")
    hot_s = skew.hot_lookup(sv, src, hubs.select(F.col("id").alias(src)))
    hot_d = skew.hot_lookup(dv, dst, hubs.select(F.col("id").alias(dst)))
    j = skew.split_join(edges, sv, src, hot_s, "left")
    return skew.split_join(j, dv, dst, hot_d, "left")
