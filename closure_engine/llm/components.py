"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closure_engine.operators.skew import hot_keys, split_join

from .common import discard, written

#: Links of one id that are worth a look-up of its own.
_MANY = 256


def _least_joined(links: DataFrame, key: str, value: str, hot: bool) -> DataFrame:
    """``links`` with m, the least ``value`` of their ``key``; ids with many links read it from a bounded table.

    An id is in that table if it has at least the 2^18th part of all links, so
    they are 2^18 ids at most; the links of the others fit a task.  If no id is
    ``hot``, that table would be empty and the links meet by their key alone.
    """
    if not hot:
        return links.withColumn("m", F.min(value).over(Window.partitionBy(key)))
    least = links.groupBy(key).agg(F.min(value).alias("m"), F.count("*").alias("n"))
    return split_join(links, least.select(key, "m"), key, hot_keys(least, key, "n", min_rows=_MANY).select(key, "m"))


def components(links: DataFrame, name: str) -> DataFrame:
    """(id, component) of every linked id that is not the smallest of its component.

    ``links``: columns a and b, whole numbers.  A large-star step links the
    larger neighbours of an id to the smallest one, a small-star step the
    smaller ones; each step is a partial aggregate and a join in which the links of
    an id that holds many stay where they are, or one exchange where no id holds
    many.  Every round is written, the one before is deleted, and the rounds grow
    with the logarithm of the longest path.
    """
    now = written(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), f"{name}-links")
    state = None
    while True:
        both = now.select(F.explode(F.array(F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")),
                                            F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))).alias("x")).select("x.u", "x.v")
        of_id = both.groupBy("u").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h"))
        n, h, most = of_id.agg(F.sum("n"), F.bit_xor("h"), F.max("n")).first()
        if state == (n, h):
            return now.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
        state = (n, h)
        hot = (most or 0) >= _MANY
        # an id has at most as many rows in the second step as it has links
        large = _least_joined(both, "u", "v", hot).where("v > u").select(F.col("v").alias("hi"), F.least("u", "m").alias("lo"))
        pair = lambda hi: F.struct(F.col(hi).alias("hi"), F.col("m").alias("lo"))
        small = _least_joined(large, "hi", "lo", hot).select(
            F.explode(F.array_compact(F.array(pair("hi"), F.when(F.col("lo") != F.col("m"), pair("lo"))))).alias("x")).select("x.hi", "x.lo")
        before, now = now, written(small.distinct(), f"{name}-round")
        discard(before)
