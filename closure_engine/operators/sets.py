"""Messages that are sets: rows ``(id, element, count)`` instead of one array a vertex.

A round sends a vertex's elements over its edges; what a vertex receives is
merged by a partial aggregate of (id, element), so a hub's set is many rows
spread over many tasks and no row or task holds it whole.

For an intersection of two ends, every set is dealt by a hash of the element into
blocks of about ``split_rows`` elements, a power of two of them, and kept as an
array a block.  The blocks of the end with the smaller set travel along the edge,
cut into the parts that belong to one block of the other end each, and meet that
block in an equi-join on (id, block).  An array of a block is what a row holds.

Cost of an intersection: an edge sends the smaller of its two sets, for neighbour
sets at most sqrt(2m) elements an edge on average of the worst graph (the sum of the
smaller degrees over all edges is O(m^1.5)), eight bytes each before compression.
An element that is sent is compared with one block at most.  In the look-up a
block may be asked for by many edges; both its sides come straight from a shuffle
of written tables, which is what adaptive execution can split.

Disk: what is sent may be far more than the sets themselves, so sums over the
intersections are taken in slices of the edges, by a hash of the end that is sent
to.  As many slices are made as keep what one sends at a few times the elements of
all sets; of neighbour sets, one vertex gets no more than these elements once.
Every step ends in a written table, its shuffles are removed then, and a table
is dropped when its successors are written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closure_engine.operators import skew
from closure_engine.operators.adjacency import half_edges
from closure_engine.session import ensure_checkpoint_dir, shuffles_removed
from closure_engine.sources.manifest import _Files

#: Elements of a block of a set, about: sets of more are dealt into several.
BLOCK_ROWS = 1 << 10
#: Elements that a slice of the edges sends, about: a share of the elements of all sets, and so many at least.
SLICE_SHARE, SLICE_ROWS = 3, 1 << 23
#: Elements of a slot of a block, about.
SLOT_ROWS = 32


def neighbour_sets(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """First round: every vertex sends its id to its neighbours; ``(id, element, count)``, count > 1 for parallel edges."""
    return (half_edges(edges, src, dst).groupBy("id", F.col("neighbour").alias("element"))
            .agg(F.count(F.lit(1)).alias("count")))


def _sizes(sets: DataFrame) -> DataFrame:
    return sets.groupBy("id").agg(F.count(F.lit(1)).alias("size"))


def _salted(edges: DataFrame, sets: DataFrame, sizes: DataFrame, end: str, size: str, split_rows: int) -> DataFrame:
    """``edges`` (with ``size``, that of ``end``'s set) joined to the elements of ``end``; a large set is spread over salts."""
    asked = edges.withColumn("_salt", F.explode(F.sequence(F.lit(0), skew.n_salts(F.col(size), split_rows) - 1)))
    wide = sizes.select(F.col("id").alias(end), skew.n_salts(F.col("size"), split_rows).alias("_n"))
    # a set has as many rows as its size, so the sizes tell which ids are hot
    hot = skew.hot_keys(sizes, "id", "size", min_rows=split_rows).select(F.col("id").alias(end), skew.n_salts(F.col("size"), split_rows).alias("_n"))
    held = skew.split_join(sets.select(F.col("id").alias(end), "element", "count"), wide, end, hot)
    held = held.withColumn("_salt", F.pmod(F.xxhash64("element"), F.col("_n")).cast("int")).drop("_n")
    return asked.join(held, [end, "_salt"]).drop("_salt")


def send_sets(edges: DataFrame, sets: DataFrame, src: str = "src", dst: str = "dst", both: bool = True,
              split_rows: int = skew.SPLIT_ROWS) -> DataFrame:
    """A further round: every vertex gets its neighbours' elements, ``(id, element, count)`` with added counts.

    ``both=False`` sends along the direction of the edges only.
    """
    sizes = _sizes(sets)
    way = half_edges(edges, src, dst) if both else edges.select(F.col(dst).alias("id"), F.col(src).alias("neighbour"))
    sized = skew.skew_safe_lookup(way, sizes.select(F.col("id").alias("neighbour"), "size"), "neighbour")
    met = _salted(sized, sets, sizes, "neighbour", "size", split_rows)
    return met.groupBy("id", "element").agg(F.sum("count").alias("count"))


class _Tables:
    """Tables of one call in a folder under ``spark.checkpoint.dir``: written where a step ends, dropped when its successors are written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/sets-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` as a Parquet table, a third of a checkpoint's bytes and less; a name that is kept again gets more rows."""
        df.write.mode("append").option("compression", "zstd").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        files = _Files(self.spark, self.folder)
        for name in names:
            files.delete(f"{self.folder}/{name}")


def _place(element: Column, n: Column) -> Column:
    """The block of an element where its set has ``n`` of them, a power of two: that among fewer blocks follows from that among more."""
    return F.pmod(F.xxhash64(element), n.cast("bigint"))


def _power_of_two(x: Column) -> Column:
    """The least one that isn't below ``x``, 1 at least; never null, so that a join doesn't ask for it once more."""
    return F.coalesce(F.pow(F.lit(2), F.ceil(F.log2(F.greatest(x, F.lit(1.0))))).cast("int"), F.lit(1))


def _dealt(tables: _Tables, edges: DataFrame, sets: DataFrame, counted: bool, src: str, dst: str, split_rows: int) -> tuple[DataFrame, DataFrame, bool]:
    """``(_less, _more, _by_src, _size, _few, _many)`` of every edge and ``(id, _block, _entries)`` of the sets, both written; whether a set has several blocks.

    ``_less`` is the end with the smaller set, which has ``_size`` elements, 0 where it has no set.
    """
    known = sets.where(F.col("id").isNotNull() & F.col("element").isNotNull())
    held = tables.keep(known.select("id", "element", *["count"] * counted), "held")
    sizes = tables.keep(_sizes(held), "sizes")
    rows = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # sets of several blocks: at most MAX_HOT_KEYS ids, as their sizes add up to the rows
    threshold = max(split_rows + 1, -(-rows // skew.MAX_HOT_KEYS))
    n_blocks = lambda size: F.when(size >= threshold, _power_of_two(size / F.lit(split_rows))).otherwise(1)
    wide = sizes.where(F.col("size") >= threshold).select("id", n_blocks(F.col("size")).alias("_n"))
    if not counted and dict(held.dtypes)["element"] == "bigint":
        # elements only meet elements, so where all of them fit into four bytes they travel in four
        lo, hi = held.agg(F.min("element"), F.max("element")).first()
        if rows and -(1 << 31) <= lo and hi < 1 << 31:
            held = held.withColumn("element", F.col("element").cast("int"))
    n = F.coalesce("_n", F.lit(1))
    dealt = held.join(F.broadcast(wide), "id", "left").groupBy("id", _place(F.col("element"), n).alias("_block"))
    blocks = tables.keep(dealt.agg(F.collect_list(F.struct("element", "count") if counted else F.col("element")).alias("_entries")), "blocks")
    tables.drop("held")

    def with_size(df: DataFrame, end: str) -> DataFrame:
        hot = skew.hot_keys(df.groupBy(end).agg(F.count(F.lit(1)).alias("_rows")), end, "_rows")
        of_end = sizes.select(F.col("id").alias(end), F.col("size").alias(f"_size{end}"))
        sized = skew.split_join(df, of_end, end, skew.hot_lookup(of_end, end, hot), "left")
        return sized.withColumn(f"_size{end}", F.coalesce(f"_size{end}", F.lit(0).cast("bigint")))

    # a table between the two look-ups, so that the shuffles of only one of them lie on disk
    pairs = tables.keep(edges.select(F.col(src).alias("_s"), F.col(dst).alias("_d")), "pairs")
    half = tables.keep(with_size(pairs, "_s"), "half")
    tables.drop("pairs")
    by_src = F.col("_size_s") <= F.col("_size_d")
    pick = lambda x, y: F.when(by_src, F.col(x)).otherwise(F.col(y))
    chosen = tables.keep(with_size(half, "_d").select(
        pick("_s", "_d").alias("_less"), pick("_d", "_s").alias("_more"), by_src.alias("_by_src"), pick("_size_s", "_size_d").alias("_size"),
        n_blocks(pick("_size_s", "_size_d")).alias("_few"), n_blocks(pick("_size_d", "_size_s")).alias("_many")), "chosen")
    several = not wide.isEmpty()
    tables.drop("half", "sizes")
    return chosen, blocks, several


def _sent(chosen: DataFrame, blocks: DataFrame, several: bool, counted: bool) -> DataFrame:
    """``(_less, _more, _by_src, _to, _sent)``: for every edge, the smaller set in parts of one block ``_to`` of the larger one."""
    asked = chosen.where("_size > 0").withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_few").cast("bigint") - 1)))
    sent = asked.join(blocks.select(F.col("id").alias("_less"), "_block", F.col("_entries").alias("_sent")).hint("shuffle_hash"), ["_less", "_block"])
    if not several:
        return sent.select("_less", "_more", "_by_src", F.col("_block").alias("_to"), "_sent")
    whole = F.col("_few") == F.col("_many")
    place = lambda x: _place(x["element"] if counted else x, F.col("_many"))
    sent = sent.withColumn("_to", F.explode(F.when(whole, F.array("_block")).otherwise(F.array_distinct(F.transform("_sent", place)))))
    return sent.select("_less", "_more", "_by_src", "_to",
                       F.when(whole, F.col("_sent")).otherwise(F.filter("_sent", lambda x: place(x) == F.col("_to"))).alias("_sent"))


def _meetings(edges: DataFrame, sets: DataFrame, counted: bool, src: str, dst: str, split_rows: int) -> DataFrame:
    """``(_less, _more, _by_src, _sent, _held)``: for every edge, parts of the smaller set with the block of the larger one that they belong to.

    ``_sent`` and ``_held`` are arrays of elements, ``counted``: of (element, count); an element of both ends is in both arrays of exactly one row.
    """
    with shuffles_removed(edges.sparkSession):
        chosen, blocks, several = _dealt(_Tables(edges.sparkSession), edges, sets, counted, src, dst, split_rows)
    there = blocks.select(F.col("id").alias("_more"), F.col("_block").alias("_to"), F.col("_entries").alias("_held"))
    return _sent(chosen, blocks, several, counted).join(there.hint("shuffle_hash"), ["_more", "_to"]).drop("_to")


def intersect_sets(edges: DataFrame, sets: DataFrame, src: str = "src", dst: str = "dst",
                   split_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(src, dst, element, src_count, dst_count)``: the elements that the sets of both ends of an edge share, one row each.

    ``edges``: one row a pair.  ``sets`` are written to ``spark.checkpoint.dir`` first,
    a round's boundary.
    """
    met = _meetings(edges, sets, True, src, dst, split_rows)
    met = met.withColumn("_shared", F.array_intersect("_held.element", "_sent.element")).where(F.size("_shared") > 0)
    met = met.withColumn("_x", F.explode(F.filter("_sent", lambda x: F.array_contains("_shared", x["element"]))))
    met = met.withColumn("_y", F.explode(F.filter("_held", lambda y: y["element"] == F.col("_x.element"))))
    pick = lambda x, y: F.when(F.col("_by_src"), F.col(x)).otherwise(F.col(y))
    return met.select(pick("_less", "_more").alias(src), pick("_more", "_less").alias(dst), F.col("_x.element").alias("element"),
                      pick("_x.count", "_y.count").alias(f"{src}_count"), pick("_y.count", "_x.count").alias(f"{dst}_count"))


def _slot(element: Column, n: Column) -> Column:
    """The slot of an element among ``n``, a power of two, by other bits than those of its block."""
    return F.shiftrightunsigned(F.xxhash64(element), 32).bitwiseAND(n.cast("bigint") - 1).cast("int")


def _slots(blocks: DataFrame) -> DataFrame:
    """``(id, _block, _slots)``: a block's elements in arrays of about SLOT_ROWS by their hash, so that an element is looked for in one of them."""
    n = _power_of_two(F.size("_entries") / F.lit(SLOT_ROWS))
    # groups of slots first, then their slots: an element is asked for its slot about twice the root of their number of times
    sized = blocks.select("id", "_block", "_entries", n.alias("_n"), _power_of_two(F.sqrt(n)).alias("_groups"))
    sized = sized.withColumn("_each", (F.col("_n") / F.col("_groups")).cast("int"))

    def tag(x: Column) -> Column:
        at = _slot(x, F.col("_n"))
        return F.struct((at / F.col("_each")).cast("int").alias("group"), at.alias("at"), x.alias("x"))

    def dealt(tagged: Column) -> Column:
        groups = F.transform(F.sequence(F.lit(0), F.col("_groups") - 1), lambda g: F.filter(tagged, lambda y: y["group"] == g))
        own = lambda group, g: F.transform(F.sequence(g * F.col("_each"), (g + 1) * F.col("_each") - 1), lambda k: F.filter(group, lambda y: y["at"] == k)["x"])
        return F.flatten(F.transform(groups, own))

    # an array of one holds what is tagged, which is then done once and not for each group
    once = F.flatten(F.transform(F.array(F.transform("_entries", tag)), dealt))
    return sized.select("id", "_block", F.coalesce(once, F.array()).alias("_slots"))


def common_element_sums(edges: DataFrame, sets: DataFrame, src: str = "src", dst: str = "dst", split_rows: int = BLOCK_ROWS,
                        slice_rows: int | None = None) -> DataFrame:
    """``(id, n_common_sum)``: over a vertex's edges, the elements shared with the other end; 0 where there are none.

    Runs when it is called, in slices of the edges by a hash of the end with the
    larger set, which send about ``slice_rows`` elements each (default: SLICE_SHARE
    times the elements of all sets, SLICE_ROWS at least).
    """
    spark, zero = edges.sparkSession, F.lit(0).cast("bigint")
    tables = _Tables(spark)
    with shuffles_removed(spark):
        chosen, blocks, several = _dealt(tables, edges, sets, False, src, dst, split_rows)
        if slice_rows is None:
            slice_rows = max(SLICE_ROWS, int(SLICE_SHARE * (blocks.agg(F.sum(F.size("_entries"))).first()[0] or 0)))
        slices = max(1, -(-(chosen.agg(F.sum("_size")).first()[0] or 0) // slice_rows))
        ends = lambda df: df.select(F.explode(F.array("_less", "_more")).alias("id"), "n").groupBy("id").agg(F.sum("n").alias("n_common_sum"))
        sums = tables.keep(ends(chosen.select("_less", "_more", zero.alias("n"))), "sums")
        for k in range(slices):
            mine = lambda id: F.pmod(F.xxhash64(id), F.lit(slices)) == k  # noqa: B023, E731
            there = _slots(blocks.where(mine("id"))).select(F.col("id").alias("_more"), F.col("_block").alias("_to"), "_slots")
            met = _sent(chosen.where(mine("_more")), blocks, several, False).join(there.hint("shuffle_hash"), ["_more", "_to"])
            met = met.select("_less", "_more", "_slots", F.explode("_sent").alias("_x"))
            slot = F.get("_slots", _slot(F.col("_x"), F.size("_slots")))
            # an element that a set holds in several rows counts as often
            often = (F.size(slot) - F.size(F.array_remove(slot, F.col("_x")))).cast("bigint")
            sums = tables.keep(ends(met.where(F.array_contains(slot, F.col("_x"))).select("_less", "_more", often.alias("n"))), "sums")
        found = tables.keep(sums.groupBy("id").agg(F.sum("n_common_sum").alias("n_common_sum")), "found")
    tables.drop("chosen", "blocks", "sums")
    return found
