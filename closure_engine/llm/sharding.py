"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Rows with equal texts form a group that stays in one shard.  A partial
partition is a list of ``shards`` byte sums.  Differencing repeatedly takes the
two partial partitions with the largest spread (largest minus smallest sum) and
adds them oppositely ordered, the largest sums of one to the smallest of the
other, so that the spreads cancel; one partition is left in the end.

On Spark: every task differences the groups of one hash bucket, each group
being a partial partition at first, which leaves one partial partition a
bucket; these are differenced again, at most ``FAN`` in a task, level by level.
There are as many buckets as give ``LEAF`` groups each, so what a task holds is
bounded and the result depends on the data alone.

Sizes: UTF-8 bytes plus ``row_bytes``; a null text has none.  Null texts are
one group, apart from empty ones.  A group larger than an even share fills its
shard beyond it, as groups are indivisible.  Rows are numbered within each
shard from 0 without gaps; equal rows get different numbers.  Only id and text
are read, so other columns can't clash.  An empty table gives an empty table.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closure_engine.operators.skew import hot_keys, split_join

from .common import utf8_bytes, written

#: Partial partitions differenced in one task of the upper levels.
FAN = 256
#: Groups differenced in one task of the lowest level, and rows numbered in one.
LEAF = 20_000


def difference(sums: np.ndarray) -> np.ndarray:
    """Where each entry of each partial partition ends.

    ``sums``: one partial partition a row.  Returns an array of the same shape:
    the part of the final partition that entry (i, j) went into.
    """
    n, k = sums.shape
    state = {i: sums[i].copy() for i in range(n)}
    heap = [(-int(x.max() - x.min()), i) for i, x in state.items()]
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        x, y = state[a], state.pop(b)
        to = np.empty(k, np.int64)  # entry j of b is added to entry to[j] of a
        to[np.argsort(y, kind="stable")] = np.argsort(-x, kind="stable")
        x[to] += y
        merges.append((a, b, to))
        heapq.heappush(heap, (-int(x.max() - x.min()), a))
    where = np.tile(np.arange(k), (n, 1))
    for a, b, to in reversed(merges):  # a's own entries are settled by now
        where[b] = where[a][to]
    return where


def difference_groups(sizes: np.ndarray, k: int) -> np.ndarray:
    """The part of ``k`` that each indivisible group goes into.

    A group alone is a partial partition with one sum; its list is only made
    when it is combined.
    """
    heap = [(-int(x), i) for i, x in enumerate(sizes)]
    heapq.heapify(heap)
    state: dict[int, np.ndarray] = {}
    merges: list[tuple[int, int, np.ndarray]] = []

    def sums(i: int) -> np.ndarray:
        if i in state:
            return state.pop(i)
        out = np.zeros(k, np.int64)
        out[0] = sizes[i]
        return out

    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        x, y = sums(a), sums(b)
        to = np.empty(k, np.int32)
        to[np.argsort(y, kind="stable")] = np.argsort(-x, kind="stable")
        x[to] += y
        state[a] = x
        merges.append((a, b, to))
        heapq.heappush(heap, (-int(x.max() - x.min()), a))
    where = np.tile(np.arange(k, dtype=np.int32), (len(sizes), 1))
    for a, b, to in reversed(merges):
        where[b] = where[a][to]
    return where[:, 0]


def _leaf(shards: int):
    def assign(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["bytes", "grp"], ascending=[False, True], kind="stable").reset_index(drop=True)
        return pd.DataFrame({"grp": g["grp"], "bytes": g["bytes"], "bucket": g["bucket"],
                             "part": difference_groups(g["bytes"].to_numpy(), shards).astype(np.int64)})
    return assign


def _level(shards: int):
    def assign(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["bucket", "part"], kind="stable")
        names, at = np.unique(f["bucket"], return_inverse=True)
        sums = np.zeros((len(names), shards), np.int64)
        sums[at, f["part"]] = f["bytes"]
        where = difference(sums)
        return pd.DataFrame({"bucket": np.repeat(names, shards), "part": np.tile(np.arange(shards), len(names)),
                             "parent": np.int64(key[0]), "to": where.reshape(-1)})
    return assign


def _buckets_to_shards(sums: DataFrame, shards: int, buckets: int) -> DataFrame:
    """(bucket, part) -> shard, from the byte sums (bucket, part, bytes) of all buckets."""
    schema = "bucket long, part long, parent long, to long"
    place = None
    while True:
        up = written(sums.groupBy(F.floor(F.col("bucket") / FAN).cast("long").alias("g"))
                     .applyInPandas(_level(shards), schema), "shard-level")
        place = up if place is None else place.alias("p").join(
            up.alias("u"), (F.col("p.parent") == F.col("u.bucket")) & (F.col("p.to") == F.col("u.part"))
        ).select("p.bucket", "p.part", "u.parent", "u.to")
        buckets = -(-buckets // FAN)
        if buckets <= 1:
            return place.select("bucket", "part", F.col("to").cast("int").alias("shard"))
        sums = sums.join(up, ["bucket", "part"]).groupBy(F.col("parent").alias("bucket"), F.col("to").alias("part")).agg(
            F.sum("bytes").alias("bytes"))


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
                    row_bytes: int = 16) -> DataFrame:
    """id, size, text_crc32, shard, slot for every row of ``docs``."""
    text = F.col(text_col)
    rows = written(docs.select(
        F.col(id_col).alias("id"), (utf8_bytes(text) + row_bytes).alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.coalesce(F.md5(text.cast("binary")), F.lit("null")).alias("grp")), "shard-rows")
    groups = written(rows.groupBy("grp").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "shard-sizes")
    held = groups.agg(F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    buckets = max(1, -(-held["groups"] // LEAF))
    placed = written(groups.withColumn("bucket", F.pmod(F.xxhash64("grp"), F.lit(buckets))).groupBy("bucket").applyInPandas(
        _leaf(shards), "grp string, bytes long, bucket long, part long"), "shard-groups")
    sums = placed.groupBy("bucket", "part").agg(F.sum("bytes").alias("bytes"))
    to = _buckets_to_shards(sums, shards, buckets)
    of = written(placed.join(to, ["bucket", "part"]).select("grp", "shard"), "shard-of-group")
    # a text that many rows share is looked up in a table of 2^18 groups at most
    hot = of.join(hot_keys(groups, "grp", "n").select("grp"), "grp", "left_semi")
    out = split_join(rows, of, "grp", hot).select("id", "size", "text_crc32", "shard")
    return _numbered(written(out, "shard-placed"), max(1, -(-held["rows"] // (shards * LEAF)))).withColumnRenamed("id", id_col)


def _numbered(rows: DataFrame, pieces: int) -> DataFrame:
    """Adds slot: 0, 1, ... within each shard, counted piece by piece so that no shard is one task.

    Equal rows are one row with a count until their numbers are told.
    """
    keys = ["id", "size", "text_crc32", "shard"]
    cut = rows.groupBy(*keys).agg(F.count("*").alias("n")).withColumn("piece", F.pmod(F.xxhash64("id", "size", "text_crc32"), F.lit(pieces)))
    held = cut.groupBy("shard", "piece").agg(F.sum("n").alias("n"))
    before = held.select("shard", "piece", (F.sum("n").over(Window.partitionBy("shard").orderBy("piece")) - F.col("n")).alias("before"))
    order = Window.partitionBy("shard", "piece").orderBy("id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = cut.withColumn("own", F.sum("n").over(order) - F.col("n")).join(before, ["shard", "piece"])
    return first.select("id", "size", "text_crc32", "shard", F.explode(F.sequence(
        F.col("before") + F.col("own"), F.col("before") + F.col("own") + F.col("n") - 1)).alias("slot"))
