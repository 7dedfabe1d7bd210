"""Result sinks: Parquet tables, never a collect to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from closure_engine.operators.measures import Closure, summarize
from closure_engine.sources.manifest import read_manifest, write_folder


def write_closure(result: Closure, path: str, mode: str = "errorifexists",
                  average_digits: int | None = None) -> DataFrame:
    """Write ``<path>/per_vertex`` and ``<path>/summary`` as Parquet, both or none.

    The per-vertex table is written first; the summary is then computed from
    that written table, so the graph work runs once and the second job reads
    a small table instead of recomputing the lineage.  Both are written aside and
    take their place together (see :mod:`closure_engine.sources.manifest`), so a
    failure leaves an older result as it was.  Returns the summary read back (one
    row).
    """
    base = path.rstrip("/")
    spark = result.per_vertex.sparkSession

    def write(folder: str) -> dict:
        result.per_vertex.write.parquet(f"{folder}/per_vertex")
        summary = summarize(spark.read.schema(result.per_vertex.schema).parquet(f"{folder}/per_vertex"), average_digits)
        summary.write.parquet(f"{folder}/summary")
        return {"kind": "closure"}

    write_folder(spark, base, write, mode)
    return spark.read.parquet(f"{base}/summary")


def read_closure(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(per vertex, summary) of a result that ``write_closure`` wrote; an error if it is not whole."""
    base = path.rstrip("/")
    if read_manifest(spark, base).get("kind") != "closure":
        raise ValueError(f"{base} is no closure result")
    return spark.read.parquet(f"{base}/per_vertex"), spark.read.parquet(f"{base}/summary")
