"""Text edge lists: one edge per line, ``src dst [ignored ...]``.

White space at both ends of a line is ignored, whatever its kind.  Lines
that are blank or start with ``#`` are skipped; the first two tokens (split
on a regex, whitespace by default) become ``bigint`` ids and every edge
carries ``attr = 1``.  In ``strict`` mode a line with fewer than two tokens
or a non-integer id fails the job (as a hand-rolled ``toLong`` would);
``permissive`` drops such lines, and ``rejected_edge_lines`` returns them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EDGE_SCHEMA = "src bigint, dst bigint, attr int"


def _token_rows(lines: DataFrame, column: str, sep_regex: str) -> DataFrame:
    """``_line, src, dst`` of the lines that should hold an edge; an id that is none is null."""
    text = F.regexp_replace(F.col(column), r"^\s+|\s+$", "")
    kept = lines.select(text.alias("_line")).where((F.col("_line") != "") & ~F.col("_line").startswith("#"))
    parts = kept.select("_line", F.split("_line", sep_regex).alias("_p"))
    return parts.select("_line", F.expr("try_cast(get(_p, 0) AS BIGINT)").alias("src"),
                        F.expr("try_cast(get(_p, 1) AS BIGINT)").alias("dst"))


def rejected_edge_lines(lines: DataFrame, column: str = "value", sep_regex: str = r"\s+") -> DataFrame:
    """The lines, stripped, that ``permissive`` mode drops: fewer than two tokens or a non-integer id (column ``line``)."""
    rows = _token_rows(lines, column, sep_regex)
    return rows.where(F.col("src").isNull() | F.col("dst").isNull()).select(F.col("_line").alias("line"))


def parse_edge_lines(lines: DataFrame, column: str = "value", sep_regex: str = r"\s+",
                     mode: str = "strict") -> DataFrame:
    if mode not in ("strict", "permissive"):
        raise ValueError(f"mode must be 'strict' or 'permissive', not {mode!r}")
    rows = _token_rows(lines, column, sep_regex)
    src, dst = F.col("src"), F.col("dst")
    if mode == "permissive":
        return rows.where(src.isNotNull() & dst.isNotNull()).select("src", "dst", F.lit(1).alias("attr"))
    # coalesce only evaluates raise_error when the id did not parse
    bad = F.concat(F.lit("malformed edge line: "), F.col("_line"))
    return rows.select(
        F.coalesce(src, F.raise_error(bad).cast("bigint")).alias("src"),
        F.coalesce(dst, F.raise_error(bad).cast("bigint")).alias("dst"),
        F.lit(1).alias("attr"),
    )


def read_edge_text(spark: SparkSession, path: str, sep_regex: str = r"\s+", mode: str = "strict",
                   num_partitions: int | None = None) -> DataFrame:
    """Read a text edge list (files or a directory) into ``src, dst, attr``.

    ``num_partitions`` is optional: input splits already parallelise the
    scan, so a repartition (one shuffle) is only added when asked for.
    """
    edges = parse_edge_lines(spark.read.text(path), "value", sep_regex, mode)
    if num_partitions:
        edges = edges.repartition(num_partitions)
    return edges
