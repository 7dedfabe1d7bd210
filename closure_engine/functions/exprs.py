"""Scalar Column expressions.

Counts of rows are ``bigint``; connected triplets, which pass 64 bits at a
degree of about 4.3 billion, are ``decimal(38,0)``.  A ratio is formed by
exactly one division of doubles at the end, so Spark and any SQL engine
produce the same IEEE double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan() -> Column:
    return F.lit(float("nan")).cast("double")


def triplets_of(degree) -> Column:
    """Connected triplets centred on a vertex: d(d-1)/2 as decimal(38,0).

    The even one of d and d-1 is halved first, which keeps the product exact
    for every bigint degree, with ANSI mode on or off.
    """
    d = _c(degree).cast("bigint")
    even = F.pmod(d, F.lit(2)) == 0
    half = F.when(even, F.shiftright(d, 1)).otherwise(F.shiftright(d - 1, 1))
    other = F.when(even, d - 1).otherwise(d)
    return (half.cast("decimal(19,0)") * other.cast("decimal(19,0)")).cast("decimal(38,0)")


def zero() -> Column:
    return F.lit(0).cast("bigint")


def int_div(num, k: int) -> Column:
    """Exact floor division of a non-negative bigint by a small constant."""
    n = _c(num).cast("bigint")
    return ((n - F.pmod(n, F.lit(k).cast("bigint"))).cast("decimal(38,0)") / F.lit(k)).cast("bigint")


def local_ratio(triangles, triplets) -> Column:
    """T(v) / triplets(v), and 0.0 when the vertex has no triplet."""
    t, p = _c(triangles), _c(triplets)
    return F.when(p == 0, F.lit(0.0)).otherwise(t.cast("double") / p.cast("double"))


def guarded_ratio(num, den) -> Column:
    """num / den as double, NaN when den is 0 (never raises under ANSI)."""
    n, d = _c(num), _c(den)
    return F.when(d > 0, n.cast("double") / d.cast("double")).otherwise(nan())


def exact_mean(value, n) -> Column:
    """Aggregate: the mean over ``n`` rows of doubles between 0 and 1; the same bits in every order of addition.

    A value becomes a whole number of 2^-62 (values of 2^-9 and above exactly,
    smaller ones rounded down by less than 2^-62), cut into parts of 20, 21 and
    21 bits whose sums are whole numbers and fit 64 bits up to 2^42 rows.  The
    sum is put together as a decimal and rounded to a double once; dividing by
    ``n`` and by 2^62 rounds once more.  So the result is off by less than 2^-62
    plus 2^-52 of its size.  NaN for no rows; nulls count as 0.
    """
    whole = F.floor(_c(value) * F.lit(float(1 << 62))).cast("bigint")
    low = (1 << 21) - 1
    parts = (F.shiftright(whole, 42), F.shiftright(whole, 21).bitwiseAND(F.lit(low)), whole.bitwiseAND(F.lit(low)))
    total = F.lit(0).cast("decimal(38,0)")
    for part in parts:
        held = F.coalesce(F.sum(part), zero()).cast("decimal(20,0)")
        total = (total * F.lit(1 << 21).cast("decimal(8,0)")).cast("decimal(38,0)") + held
    mean = total.cast("decimal(38,0)").cast("double") / n.cast("double") / F.lit(float(1 << 62))
    return F.when(n > 0, mean).otherwise(nan())


def sort3(a, b, c) -> list[Column]:
    """The three ids in ascending order (no arithmetic, safe for any bigint)."""
    arr = F.sort_array(F.array(_c(a), _c(b), _c(c)))
    return [arr.getItem(0), arr.getItem(1), arr.getItem(2)]
