"""Edges from existing DataFrames, and the small inline example graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def edges_from_columns(df: DataFrame, src: str, dst: str, attr: str | None = None,
                       src_offset: int = 0, dst_offset: int = 0) -> DataFrame:
    """Read two key columns of any table as directed ``src, dst`` (bigint) edges.

    The offsets put two key spaces apart (e.g. customers and suppliers),
    which keeps a bipartite relation bipartite.  Only the named columns are
    selected, so a Parquet scan reads just those.
    """
    cols = [
        (F.col(src).cast("bigint") + F.lit(src_offset)).alias("src") if src_offset else F.col(src).cast("bigint").alias("src"),
        (F.col(dst).cast("bigint") + F.lit(dst_offset)).alias("dst") if dst_offset else F.col(dst).cast("bigint").alias("dst"),
    ]
    if attr is not None:
        cols.append(F.col(attr).alias("attr"))
    return df.select(*cols)


# The 16-vertex, 22-edge example graph of the original programs
# (vertex i is labelled with the i-th letter, an edge with its two letters).
EXAMPLE_VERTICES = [
    (1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e"), (6, "f"), (7, "g"), (8, "h"),
    (9, "i"), (10, "j"), (11, "k"), (12, "l"), (13, "m"), (14, "n"), (15, "o"), (16, "p"),
]
EXAMPLE_EDGES = [
    (1, 2, "ab"), (1, 3, "ac"), (1, 5, "ae"), (1, 8, "ah"), (1, 7, "ag"),
    (2, 3, "bc"), (2, 9, "bi"), (2, 11, "bk"), (2, 12, "bl"), (2, 15, "bo"),
    (4, 5, "de"), (4, 6, "df"),
    (5, 6, "ef"),
    (6, 8, "fh"), (6, 7, "fg"),
    (7, 8, "gh"),
    (9, 10, "ij"), (9, 11, "ik"),
    (10, 11, "jk"),
    (12, 13, "lm"),
    (14, 15, "no"),
    (15, 16, "op"),
]


def example_graph(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The inline labelled example as ``(vertices(id, label), edges(src, dst, label))``."""
    vertices = spark.createDataFrame(EXAMPLE_VERTICES, "id bigint, label string")
    edges = spark.createDataFrame(EXAMPLE_EDGES, "src bigint, dst bigint, label string")
    return vertices, edges
