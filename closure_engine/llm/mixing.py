"""Mixing sources to target weights by pivotal dependent rounding (built-in functions only).

A document of a source with ratio r = target words / source words should be
taken r times.  It is taken floor(r) times for sure and once more with a copy
probability p = r - floor(r).  Pivotal rounding settles the probabilities in
duels: of two unsettled documents, words move from one's expectation to the
other's, in a random direction chosen so that each expectation keeps its mean,
until one probability becomes 0 or 1.  The sum of p x words never changes, so a
source's taken words miss its target by one document at most.

On Spark: a reduction tree.  A level deals the unsettled documents of each
source into cells of about ``CELL``; one higher-order ``aggregate`` over a
cell's array runs its duels and leaves at most one document unsettled, which
goes to the next level; the last one of a source is settled by its
probability.  The levels grow with the logarithm of the rows, and a hot source
has more cells, not larger ones.  Random numbers are hashes of the rows and
``seed``, so reruns agree.

A null text has no words; documents without words are never taken.  A null
source is a source of its own, after all others.  Repeated rows take part one
by one.  With no words at all, targets are 0.  Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

#: Documents of a cell, on average.
CELL = 64


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(rows: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """One row a source: source, source_size, target.

    ``rows``: source, size.  The sources in code point order, null last, weigh
    ``weights`` in turn and share the sum of all sizes; a target stops at
    ``most`` times its source's size and the excess goes to the others by
    weight.  In the order of cap / weight the capped sources come first, so the
    share of a unit of weight is known from running sums.  One row a source is
    ordered in one task; sources are named corpora, far fewer than documents.
    """
    listed = F.array(*[F.lit(float(w)) for w in weights])
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = by_source.withColumn("weight", F.get(listed, rank % len(weights))).withColumn(
        "cap", most * F.col("source_size").cast("double"))
    order = (F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    # what a unit of weight gets if the sources before this one are capped
    unit = (F.sum("source_size").over(whole) - (F.sum("cap").over(upto) - F.col("cap"))) / (
        F.sum("weight").over(whole) - F.sum("weight").over(upto) + F.col("weight"))
    shared = weighed.withColumn("unit", unit).withColumn("place", F.row_number().over(Window.orderBy(*order)))
    free = F.when(F.col("cap") > F.col("unit") * F.col("weight"), F.struct("place", "unit"))
    last = F.coalesce(F.min(free).over(whole)["unit"], F.lit(float("inf")))
    return shared.select("source", "source_size", F.least("cap", F.col("weight") * last).alias("target"))


def _duels(cell: Column, seed: int, level: int) -> Column:
    """All duels of a cell, one after the other: struct(open, done)."""
    unit = "large long, id long, size long, p double, h long"  # large documents are settled first
    nothing = F.lit(None).cast(f"struct<{unit}>")

    def moved(u: Column, p: Column) -> Column:
        return F.struct(u["large"].alias("large"), u["id"].alias("id"), u["size"].alias("size"), p.alias("p"), u["h"].alias("h"))

    def duel(state: Column, b: Column) -> Column:
        a = state["open"]
        up = F.least((1 - a["p"]) * a["size"], b["p"] * b["size"])  # words that can move from b to a
        down = F.least(a["p"] * a["size"], (1 - b["p"]) * b["size"])  # and from a to b
        chance = F.pmod(F.xxhash64(a["h"], b["h"], F.lit(seed), F.lit(level)), F.lit(1 << 52)) / float(1 << 52)
        rise = chance * (up + down) < down
        shift = F.when(rise, up).otherwise(-down)
        # whoever is settled is set to 0 or 1 exactly
        a_done = F.when(rise, (1 - a["p"]) * a["size"] <= b["p"] * b["size"]).otherwise(a["p"] * a["size"] <= (1 - b["p"]) * b["size"])
        a_new = moved(a, F.when(a_done, F.when(rise, 1.0).otherwise(0.0)).otherwise(a["p"] + shift / a["size"]))
        b_new = moved(b, F.when(a_done, F.least(F.greatest(b["p"] - shift / b["size"], F.lit(0.0)), F.lit(1.0)))
                      .otherwise(F.when(rise, 0.0).otherwise(1.0)))
        return F.when(a.isNull(), F.struct(b.alias("open"), state["done"].alias("done"))).otherwise(F.struct(
            F.when(a_done, b_new).otherwise(a_new).alias("open"),
            F.concat(state["done"], F.array(F.when(a_done, a_new).otherwise(b_new))).alias("done")))

    start = F.struct(nothing.alias("open"), F.array().cast(f"array<struct<{unit}>>").alias("done"))
    return F.aggregate(F.array_sort(cell), start, duel)


def _tree_rounding(units: DataFrame, seed: int) -> DataFrame:
    """source, id, size, extra (0 or 1) from source, id, size, p with 0 < p < 1 and size > 0."""
    settled = []
    # equal rows are one row with a count, then numbered, so that they fall in different cells
    alike = units.groupBy("source", "id", "size", "p").agg(F.count("*").alias("n"))
    numbered = alike.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    open_ = written(numbered.select("source", "id", "size", "p", F.xxhash64("id", "size", "k", F.lit(seed)).alias("h")), "mix-units")
    level = 0
    while True:
        counted = open_.groupBy("source").agg(F.ceil(F.count("*") / CELL).alias("cells"))
        most = counted.agg(F.max("cells")).first()[0]
        if most is None:
            break
        cells = open_.alias("u").join(counted.alias("c"), F.col("u.source").eqNullSafe(F.col("c.source"))).select(
            "u.*", F.pmod(F.xxhash64("h", F.lit(level)), F.col("cells")).alias("cell"))
        fought = cells.groupBy("source", "cell").agg(F.collect_list(F.struct((-F.col("size")).alias("large"), "id", "size", "p", "h")).alias("units"))
        fought = fought.select("source", _duels(F.col("units"), seed, level).alias("s"))
        out = written(fought.select("source", F.explode(F.concat("s.done", F.array("s.open"))).alias("one")).select("source", "one.id", "one.size", "one.p", "one.h"),
                      f"mix-level{level}")
        whole = (F.col("p") == 0.0) | (F.col("p") == 1.0)
        settled.append(out.where(whole).select("source", "id", "size", F.col("p").cast("long").alias("extra")))
        open_ = out.where(~whole)
        level += 1
        if most == 1:  # one document a source is left at most
            chance = F.pmod(F.xxhash64("h", F.lit(seed), F.lit("last")), F.lit(1 << 52)) / float(1 << 52)
            settled.append(open_.select("source", "id", "size", (chance < F.col("p")).cast("long").alias("extra")))
            break
    if not settled:
        return open_.select("source", "id", "size", F.lit(0).cast("long").alias("extra"))
    out = settled[0]
    for x in settled[1:]:
        out = out.unionByName(x)
    return out


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 20,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, source, size, source_size, target, copies for every row of ``docs``; ids are whole numbers."""
    rows = written(docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
                               word_count(F.col(text_col)).alias("size")), "mix-rows")
    targets = written(source_targets(rows, weights, most), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    with_p = targets.withColumn("base", F.floor(ratio)).withColumn("p", ratio - F.floor(ratio))
    planned = rows.alias("r").join(with_p.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source"))).select(
        "r.id", "r.source", "r.size", "base", "p")
    unsettled = (F.col("size") > 0) & (F.col("p") > 0)
    extra = _tree_rounding(planned.where(unsettled).select("source", "id", "size", "p"), seed)
    sure = planned.where(~unsettled).select("source", "id", "size", F.lit(0).cast("long").alias("extra"))
    every = extra.unionByName(sure)
    return every.alias("e").join(with_p.alias("t"), F.col("e.source").eqNullSafe(F.col("t.source"))).select(
        F.col("e.id").alias(id_col), F.col("e.source").alias(source_col), "size", "source_size", "target",
        F.when(F.col("size") > 0, F.col("base") + F.col("extra")).otherwise(0).cast("long").alias("copies"))


def take_copies(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, each as often as ``mixed`` takes its id (rows that share an id share the largest number)."""
    held = mixed.groupBy(F.col(id_col).alias("_mix_id")).agg(F.max("copies").alias("_mix_copies")).where("_mix_copies > 0")
    joined = docs.join(held, F.col(id_col).eqNullSafe(F.col("_mix_id")))
    return joined.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int")))).select(*docs.columns)
