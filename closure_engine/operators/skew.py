"""Hot keys: joins whose key may hold a large share of all rows.

A vertex may touch a third of all edges.  Two tools keep such a key from
landing in one task:

* ``split_join`` for "many rows per key" joined to "one row per key"
  (edges to vertex values).  The hot keys are found from a frequency table
  with a threshold of at least ``total / max_hot``; since the frequencies
  sum to ``total``, at most ``max_hot`` keys can reach it, so the hot side
  that is broadcast has a proven size bound whatever the data size.  The
  threshold is a lazy scalar subquery, so nothing runs on the driver.
  Every row probes the broadcast copy in place; rows that found their key
  there go through the shuffle join dealt out by a hash and matching
  nothing, so one branch holds all rows and the input is read once.
* salting (``n_salts``) for joins where the one-row side is too large to
  broadcast (vertex out-lists): the rows of every key are spread over
  ``1 + degree // split_rows`` salts by a hash of their other column, and
  the one row is copied once per salt, so each (key, salt) group holds
  about ``split_rows`` rows at most.  The degree travels with the edges, so
  no table of hot keys decides who is salted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed defaults: hot keys need at least this many rows, and at most this
# many hot rows are ever broadcast.  They choose a route, never a result.
MIN_HOT_ROWS = 1 << 16
MAX_HOT_KEYS = 1 << 18
# salted joins: target rows of one key per (key, salt) group
SPLIT_ROWS = 1 << 16


def hot_keys(freq: DataFrame, key: str, count_col: str, max_hot: int = MAX_HOT_KEYS,
             min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Keys of ``freq`` whose count reaches ``max(min_rows, ceil(total / max_hot))``.

    At most ``max_hot`` keys qualify (counts sum to ``total``).
    """
    total = freq.agg(F.coalesce(F.sum(count_col), F.lit(0)).cast("bigint").alias("t")).scalar()
    threshold = F.greatest(F.lit(min_rows).cast("bigint"), F.ceil(total / F.lit(max_hot)).cast("bigint"))
    return freq.where(F.col(count_col) >= threshold)


def split_join(big: DataFrame, small: DataFrame, key: str, hot_small: DataFrame,
               how: str = "inner") -> DataFrame:
    """``big`` joined to ``small`` (at most one row per ``key``) on ``key``.

    ``hot_small`` holds the ``small`` rows of the keys that may be heavy in
    ``big`` (at most ``MAX_HOT_KEYS`` rows when chosen by :func:`hot_keys`;
    their columns should be of bounded width, as they are broadcast).
    """
    if how not in ("inner", "left"):
        raise ValueError("split_join supports inner and left joins")
    values = [c for c in small.columns if c != key]
    hot = hot_small.select(key, *[F.col(c).alias(f"_hot_{c}") for c in values], F.lit(True).alias("_hot"))
    probed = big.join(F.broadcast(hot), key, "left")
    is_hot = F.col("_hot").isNotNull()
    spread = F.xxhash64(*[F.col(c) for c in big.columns])
    # a row that is settled has no key, which matches nothing, and a hash that deals it out
    probed = probed.withColumn("_key", F.when(~is_hot, F.col(key))).withColumn("_side", F.when(is_hot, spread).otherwise(F.lit(0)))
    cold = small.select(F.col(key).alias("_key"), F.lit(0).cast("bigint").alias("_side"), F.lit(True).alias("_cold"),
                        *[F.col(c).alias(f"_cold_{c}") for c in values])
    joined = probed.join(cold, ["_key", "_side"], "left")
    if how == "inner":
        joined = joined.where(F.col("_hot").isNotNull() | F.col("_cold").isNotNull())
    pick = [F.when(is_hot, F.col(f"_hot_{c}")).otherwise(F.col(f"_cold_{c}")).alias(c) for c in values]
    return joined.select(*[F.col(c) for c in big.columns], *pick)


def n_salts(degree: Column, split_rows: int = SPLIT_ROWS) -> Column:
    return (F.lit(1) + F.floor(degree.cast("bigint") / F.lit(split_rows))).cast("int")


def salted_join(big: DataFrame, small: DataFrame, key: str, salts: DataFrame) -> DataFrame:
    """``big`` left-joined to ``small`` (one row per ``key``, of any width) without a broadcast of ``small``.

    ``salts`` (``id, _salts``) lists the keys with more than ``SPLIT_ROWS``
    rows: at most rows / SPLIT_ROWS of them, two numbers each, which both
    sides look up through :func:`split_join`.
    """
    hot = hot_keys(salts, "id", "_salts", min_rows=2).withColumnRenamed("id", key)
    wide = salts.withColumnRenamed("id", key)
    n = F.coalesce("_salts", F.lit(1))
    left = split_join(big, wide, key, hot, "left").withColumn("_salt", F.pmod(F.xxhash64(*big.columns), n).cast("int")).drop("_salts")
    right = small.join(wide, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1))).drop("_salts")
    return left.join(right, [key, "_salt"], "left").drop("_salt").select(*big.columns, *[c for c in small.columns if c != key])


def hot_lookup(small: DataFrame, key: str, hot_ids: DataFrame) -> DataFrame:
    """Rows of ``small`` (one per key) whose key is in the bounded ``hot_ids``."""
    return small.join(F.broadcast(hot_ids.select(key)), key, "left_semi")


def skew_safe_lookup(big: DataFrame, small: DataFrame, key: str, how: str = "inner",
                     max_hot: int = MAX_HOT_KEYS, min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """``split_join`` with the hot keys measured on ``big`` itself.

    The key frequencies are one partial (map-side) aggregate over ``big``.
    """
    freq = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = hot_keys(freq, key, "_n", max_hot, min_rows)
    return split_join(big, small, key, hot_lookup(small, key, hot), how)
