"""Labelled examples of a whole table, dealt into blocks of bounded size on which models are fitted.

A block is one row whose columns hold its examples as numpy buffers.  Blocks are
dealt by a hash of the example and its number among equal ones, so that neither
many copies nor the cluster's partitions change them.  A pass over all examples
is a job that makes a vector of each block; the vectors are added up in the order
of the blocks, so reruns agree.  The driver holds vectors and models, never
examples, unless there is one block only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, discard, shuffle_partitions, sparing, written

#: Blocks whose vectors are added up in one task before the driver gets them.
_TOGETHER = 64


class Blocks:
    """``rows``: (block and the buffers that ``pack`` makes), one row a block; ``n``: examples, ``count``: blocks."""

    def __init__(self, examples: DataFrame, size: int, pack: Callable[[pa.Table], dict[str, bytes]], columns: tuple[str, ...], name: str):
        """``examples``: x, y and more; ``pack`` gets those of a block, ordered by a hash of x and y."""
        alike = written(examples.groupBy(*examples.columns).agg(F.count("*").alias("n")), f"{name}-examples", compression="zstd")
        self.n, low, high = alike.agg(F.coalesce(F.sum("n"), F.lit(0)), F.min("y"), F.max("y")).first()
        self.both, self.count, self.name = low != high, max(1, -(-self.n // size)), name
        of = F.pmod(F.xxhash64("x", "y", "k", F.lit("block")), F.lit(self.count))
        each = alike.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select(
            *examples.columns, F.xxhash64("x", "y").alias("h"), of.alias("block"))
        more = [c for c in examples.columns if c not in ("x", "y")]

        def block(t: pa.Table) -> pa.Table:
            keys = [t.column(c).to_numpy(zero_copy_only=False) for c in (*more, "y", "h")]
            made = pack(t.take(pa.array(np.lexsort(keys))))
            return pa.table([pa.array([t.column("block")[0].as_py()], pa.int64()), *(pa.array([made[c]], pa.binary()) for c in columns)], ["block", *columns])

        self.rows = written(each.groupBy("block").applyInArrow(block, "block long, " + ", ".join(f"{c} binary" for c in columns)), f"{name}-blocks")
        discard(alike)

    def map(self, make: Callable[..., dict[str, bytes]], columns: tuple[str, ...], name: str) -> Blocks:
        """Blocks of other buffers, made of each one's buffers."""
        out = object.__new__(Blocks)
        out.n, out.both, out.count, out.name = self.n, self.both, self.count, self.name
        out.rows = written(_over(self.rows, lambda b, *x: [b, *(make(*x)[c] for c in columns)], [("block", "long"), *((c, "binary") for c in columns)]), name)
        return out

    def only(self) -> tuple[bytes, ...]:
        """The buffers of the only block."""
        return tuple(map(bytes, self.rows.first()[1:]))

    def summed(self, vector: Callable[..., np.ndarray]) -> np.ndarray:
        """The sum of the vectors that ``vector(block, *buffers)`` makes of the blocks."""
        made = _over(self.rows, lambda b, *x: [b, np.asarray(vector(b, *x), float).tobytes()], [("block", "long"), ("v", "binary")])
        if self.count > _TOGETHER:

            def add(t: pa.Table) -> pa.Table:
                got = sorted(zip(t.column("block").to_pylist(), t.column("v").to_pylist()))
                return pa.table([pa.array([got[0][0]], pa.int64()), pa.array([sum(np.frombuffer(v) for _, v in got).tobytes()])], ["block", "v"])

            made = made.groupBy(F.floor(F.col("block") / _TOGETHER)).applyInArrow(add, "block long, v binary")
        return sum(np.frombuffer(v) for _, v in sorted((r["block"], bytes(r["v"])) for r in made.collect()))


def _over(rows: DataFrame, make: Callable[..., list], columns: list[tuple[str, str]]) -> DataFrame:
    kinds = {"long": pa.int64(), "binary": pa.binary()}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, *buffers = (c[i] for c in batch.columns)
                made = make(block.as_py(), *(b.as_py() for b in buffers))
                yield pa.RecordBatch.from_arrays([pa.array([x], kinds[k]) for x, (_, k) in zip(made, columns)], [c for c, _ in columns])

    return rows.mapInArrow(sparing(each), ", ".join(f"{c} {k}" for c, k in columns))


def scored(blocks: Blocks, score: Callable[..., tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """score, label: what ``score(block, *buffers)`` gives for the rows of all blocks."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                values, labels = score(*(c[i].as_py() for c in batch.columns))
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.float64()), pa.array(labels, pa.float64())], ["score", "label"])

    return blocks.rows.mapInArrow(sparing(each), "score double, label double")


def running(rows: DataFrame, name: str) -> DataFrame:
    """score, n, good, one row a score: rows with at least this score, and those of them labelled 1; ``rows``: score, label.

    Scores are dealt by ranges; sums of the ranges, then within each.
    """
    alike = rows.groupBy("score").agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("good"))
    alike = written(alike.repartitionByRange(shuffle_partitions(rows.sparkSession), F.desc("score")).withColumn("part", F.spark_partition_id()), name)
    parts = alike.groupBy("part").agg(F.sum("n").alias("part_n"), F.sum("good").alias("part_good"))
    upto = Window.orderBy("part")  # one row a shuffle partition
    parts = parts.select("part", *((F.sum(f"part_{c}").over(upto) - F.col(f"part_{c}")).alias(f"before_{c}") for c in ("n", "good")))
    within = Window.partitionBy("part").orderBy(F.desc("score"))
    sums = alike.select("part", "score", *(F.sum(c).over(within).alias(c) for c in ("n", "good")))
    return sums.join(parts, "part").select("score", *((F.col(c) + F.col(f"before_{c}")).alias(c) for c in ("n", "good")))
