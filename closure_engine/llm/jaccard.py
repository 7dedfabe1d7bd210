"""N-gram Jaccard join with prefix, length, positional and suffix filters.

A text's set holds its distinct runs of ``k`` words (a shorter text: its whole
word sequence), as 64-bit hashes.  Two texts link when
100 * intersection >= percent * union.  All sets are ordered by the same rule,
rare n-grams first; then two linked sets must share an n-gram of their
prefixes, a fifth of a set at 80 percent.  Any order gives right results, so
the rareness comes from a table of counts by hash bucket: its size is fixed, it
counts every n-gram of every text, and it is sent to all tasks.

Steps on Spark:

1. Texts with equal sets form a class; its smallest id stands for it.
2. Prefix n-grams that two classes share are found by an aggregation, which
   combines a frequent n-gram on the map side.  A bitmap of their hashes, of a
   size proportional to their number and bounded, keeps all others from being
   shuffled again.
3. Within the classes of an n-gram, each is paired only with the one that has
   the fewest unshared n-grams before it, the centre of a group of near copies.
   Verified pairs give first components, which already unite most groups.
4. Of the n-grams whose classes still belong to different components, all pairs
   across components are formed (the shorter text by its shorter index prefix),
   each pair once.  Pairs inside a component can't change the result.

Before a pair is verified it must pass the length filter, the positional filter
(two sets that meet in an n-gram share at most the shared prefix n-grams up to
it and what follows it in both) and the suffix filter (the n-grams of either
set in each of 64 ranges of the hash bound the intersection).  Verification
intersects the whole sets, once a pair.

A null or empty text has no n-grams and no links.  Rows that share an id are
one document with the links of all its rows.  Only id and text are read, so
other columns can't clash.  An empty table gives an empty table.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_slices, column, sparing, string_buffers, written
from .components import components
from .rolling import Texts, mix

#: Hash buckets of the table of n-gram counts, and the slices in which tasks send it.
BUCKETS, SLICES = 1 << 18, 64
#: Ranges of the suffix filter.
RANGES = 64
#: Bits of a bitmap at most (64 MB).
MAX_BITS = 1 << 29
_U = np.uint64


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct n-grams of each text, in this order."""
    t = Texts(*string_buffers(texts), lower=True)
    words = t.words()
    grams, at = t.grams(words, k)
    doc, parts = [t.doc[at]], [grams]
    for n in range(1, k):
        short = np.flatnonzero(t.n_words == n)
        doc.append(short)
        parts.append(t.runs(words, t.first[short], n))
    doc, h = np.concatenate(doc), np.concatenate(parts)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h & _U(BUCKETS - 1)).astype(np.int64)


def _added(group: pa.Table) -> pa.Table:
    total = functools.reduce(np.add, (np.frombuffer(x.as_py(), np.int64) for x in group.column("counts")))
    return pa.table({"part": pa.array([group.column("part")[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def _first_pass(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """Rows of two kinds: (id, n, d1, d2), a hash of every row's set; (salt, part, counts), the n-grams of a task by hash bucket."""
    names = ["id", "n", "d1", "d2", "salt", "part", "counts"]
    types = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for a, b in byte_slices(column(batch, text_col), 1 << 20):
                rows, n_docs = batch.slice(a, b - a), b - a
                doc, h = shingles(column(rows, text_col), k)
                total += np.bincount(_bucket(h), minlength=BUCKETS)
                n = np.bincount(doc, minlength=n_docs)
                filled, start = np.flatnonzero(n), np.cumsum(n) - n
                d1, d2 = np.zeros(n_docs, _U), np.zeros(n_docs, _U)
                if len(filled):
                    d1[filled] = np.add.reduceat(mix(h), start[filled])
                    d2[filled] = np.bitwise_xor.reduceat(mix(h ^ _U(0x5851F42D4C957F2D)), start[filled])
                held = [column(rows, id_col).cast(pa.int64()), pa.array(n), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64))]
                yield pa.RecordBatch.from_arrays(held + [pa.nulls(n_docs, t) for t in types[4:]], names)
        salt = TaskContext.get().partitionId() % 64
        sent = [pa.array(np.full(SLICES, salt, np.int32)), pa.array(np.arange(SLICES, dtype=np.int32)),
                pa.array([x.tobytes() for x in np.split(total, SLICES)], pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.nulls(SLICES, t) for t in types[:4]] + sent, names)

    return docs.select(id_col, text_col).mapInArrow(sparing(read), "id long, n long, d1 long, d2 long, salt int, part int, counts binary")


def _bucket_counts(first: DataFrame) -> np.ndarray:
    """Number of n-grams in every hash bucket, over all tasks."""
    schema = "part int, counts binary"
    half = first.where("counts is not null").select("salt", "part", "counts").groupBy("salt", "part").applyInArrow(_added, schema)
    rows = half.groupBy("part").applyInArrow(_added, schema).collect()  # SLICES rows, BUCKETS numbers in all
    out = np.zeros((SLICES, BUCKETS // SLICES), np.int64)
    for r in rows:
        out[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return out.reshape(-1)


def _prefixes(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, counts: np.ndarray) -> DataFrame:
    """id, n, ranges (n-grams in each range of the hash), prefix (rare first) of every row with an n-gram."""
    rank = np.searchsorted(np.unique(counts), counts).astype(np.int32)  # of fixed size, so it travels with the function

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in byte_slices(column(batch, text_col), 1 << 20):
                rows, n_docs = batch.slice(a, b - a), b - a
                doc, h = shingles(column(rows, text_col), k)
                n = np.bincount(doc, minlength=n_docs)
                start = np.cumsum(n) - n
                spread = np.bincount(doc * RANGES + (h >> _U(58)).astype(np.int64), minlength=n_docs * RANGES).astype(np.int32)
                size = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
                order = np.lexsort((h, rank[_bucket(h)], doc))
                kept = h[order][np.arange(len(h)) - start[doc] < size[doc]]
                ends = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [column(rows, id_col).cast(pa.int64()), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(np.arange(n_docs + 1, dtype=np.int32) * RANGES), pa.array(spread)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(kept.view(np.int64)))],
                    ["id", "n", "ranges", "prefix"]).filter(pa.array(n > 0))

    return docs.select(id_col, text_col).mapInArrow(sparing(describe), "id long, n long, ranges array<int>, prefix array<long>")


class _Bitmap:
    """Which hashes may be among some: one bit a hash; false alarms only cost work."""

    def __init__(self, hashes: DataFrame, col: str):
        """``hashes``: distinct hashes; each slice of the bitmap is set in one task."""
        n = hashes.count()
        self.bits = min(MAX_BITS, max(1 << 14, 1 << int(8 * n).bit_length()))
        slices = 256
        width, bits = self.bits // slices, self.bits

        def fill(group: pa.Table) -> pa.Table:
            part = group.column("slice")[0].as_py()
            flags = np.zeros(width, np.uint8)
            flags[_Bitmap._at(group.column("h").to_numpy(), bits) - part * width] = 1
            return pa.table({"slice": pa.array([part], pa.int64()), "flags": pa.array([np.packbits(flags).tobytes()], pa.binary())})

        place = F.shiftrightunsigned(F.col(col), 64 - (self.bits.bit_length() - 1))
        rows = hashes.select(F.col(col).alias("h"), F.floor(place / width).cast("long").alias("slice")).groupBy("slice").applyInArrow(
            fill, "slice long, flags binary").collect()  # 256 rows, bits / 8 bytes in all
        flags = np.zeros((slices, width // 8), np.uint8)
        for r in rows:
            flags[r["slice"]] = np.frombuffer(r["flags"], np.uint8)
        self.flags = hashes.sparkSession.sparkContext.broadcast(flags.reshape(-1))

    @staticmethod
    def _at(h: np.ndarray, bits: int) -> np.ndarray:
        return (h.astype(np.int64).view(_U) >> _U(64 - (bits.bit_length() - 1))).astype(np.int64)

    def tester(self):
        flags, bits = self.flags, self.bits

        def test(h: np.ndarray) -> np.ndarray:
            at = _Bitmap._at(h, bits)
            return (flags.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0

        return test


def _shared_rows(reps: DataFrame, shared: DataFrame) -> DataFrame:
    """h, id, n, pos, s of the prefix n-grams that are in ``shared`` (column h); s: how many of them the id has up to pos."""
    test = _Bitmap(shared, "h").tester()

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = column(batch, "prefix")
            h = prefix.flatten().to_numpy(zero_copy_only=False)
            size = np.diff(prefix.offsets.to_numpy())
            row = np.repeat(np.arange(len(prefix)), size)
            pos = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
            hit = np.flatnonzero(test(h))
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[hit]), column(batch, "id").take(pa.array(row[hit])), column(batch, "n").take(pa.array(row[hit])), pa.array(pos[hit])],
                ["h", "id", "n", "pos"])

    rows = reps.select("id", "n", "prefix").mapInArrow(sparing(pick), "h long, id long, n long, pos long").join(shared, "h", "left_semi")
    return rows.withColumn("s", F.row_number().over(Window.partitionBy("id").orderBy("pos")).cast("long"))


def _overlap(a: Column, b: Column, percent: int) -> Column:
    """Smallest intersection of linked sets of these sizes."""
    return F.floor((percent * (a + b) + 99 + percent) / (100 + percent))


def _may_link(x: str, y: str, percent: int) -> Column:
    """Length filter and positional filter of two rows of ``_shared_rows`` with the same n-gram."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    shared = F.least(F.col(f"{x}.s"), F.col(f"{y}.s")) + F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos")) - 1
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (shared >= _overlap(n, m, percent))


def _verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, id_col: str, text_col: str, k: int, percent: int,
              name: str) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    spread = reps.select("id", "n", "ranges")
    narrow = pairs.join(spread.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("ranges").alias("ra")), "a").join(
        spread.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("ranges").alias("rb")), "b")
    bound = F.aggregate(F.zip_with("ra", "rb", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)  # suffix filter
    pairs = written(narrow.where(bound >= _overlap(F.col("na"), F.col("nb"), percent)).select("a", "b").distinct(), f"{name}-pairs")
    if pairs.isEmpty():
        return pairs
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    test = _Bitmap(ids.select(F.xxhash64("id").alias("h")), "h").tester()

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(test(column(batch, "h").to_numpy()))).select(["id", "text"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in byte_slices(column(batch, "tb"), 1 << 20):
                rows = batch.slice(lo, hi - lo)
                _, first, at = np.unique(column(rows, "a").to_numpy(), return_index=True, return_inverse=True)
                if _repeats(rows):
                    first = at = np.arange(hi - lo)
                sides = []
                for texts in (column(rows, "ta").take(pa.array(first)), column(rows, "tb")):
                    doc, h = shingles(texts, k)
                    sides.append(np.split(h, np.searchsorted(doc, np.arange(1, len(texts)))))
                sets = [(sides[0][i], y) for i, y in zip(at, sides[1])]
                both = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in sets])
                size = np.array([len(x) + len(y) for x, y in sets])
                yield rows.select(["a", "b"]).filter(pa.array(((100 + percent) * both >= percent * size) & (both > 0)))
        pa.default_memory_pool().release_unused()

    # a few texts too many pass the bitmap; the joins drop them
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("long")).alias("h"))
    texts = written(texts.mapInArrow(sparing(held), "id long, text string"), f"{name}-texts")
    joined = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").join(
        texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    return joined.select("a", "b", "ta", "tb").mapInArrow(sparing(compare), "a long, b long")


def _repeats(rows: pa.RecordBatch) -> bool:
    """Whether a pair occurs twice, as it does where rows share an id: then equal ids may have different texts."""
    pairs = np.stack((column(rows, "a").to_numpy(), column(rows, "b").to_numpy()), 1)
    return len(np.unique(pairs, axis=0)) < len(pairs)


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """id, n_shingles, component_id for every row of ``docs``; ids are whole numbers."""
    first = written(_first_pass(docs, id_col, text_col, k), "jaccard-first")
    sets = first.where("counts is null").select("id", "n", "d1", "d2")
    classes = written(sets.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("id").alias("rep")), "jaccard-classes")
    prefixes = _prefixes(docs, id_col, text_col, k, percent, _bucket_counts(first))
    reps = written(prefixes.join(classes.select(F.col("rep").alias("id")).distinct(), "id", "left_semi"), "jaccard-reps")

    # the prefix n-grams of two classes or more, and where they stand
    grams = reps.select(F.explode("prefix").alias("h"))
    shared = written(grams.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h"), "jaccard-shared")
    rows = written(_shared_rows(reps, shared), "jaccard-rows")
    centre = rows.groupBy("h").agg(F.min(F.struct((F.col("pos") - F.col("s")).alias("gap"), "id", "n", "pos", "s")).alias("y"))
    stars = rows.alias("x").join(centre, "h").where((F.col("x.id") != F.col("y.id")) & _may_link("x", "y", percent))
    stars = written(stars.select(F.col("y.id").alias("a"), F.col("x.id").alias("b")).distinct(), "jaccard-stars")
    links = written(_verified(stars, docs, reps, id_col, text_col, k, percent, "jaccard-star"), "jaccard-star-links")

    # pairs across components
    placed = rows.join(components(links, "jaccard-star"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("h").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("h")
    index = F.col("n") - F.floor((2 * percent * F.col("n") + 99 + percent) / (100 + percent)) + 1
    open_ = written(placed.join(mixed, "h", "left_semi").withColumn("index", F.col("pos") < index), "jaccard-open")
    x, y = open_.alias("x"), open_.where("index").alias("y")
    met = x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.component") != F.col("y.component")) & (
        F.struct("y.n", "y.id") < F.struct("x.n", "x.id")) & _may_link("x", "y", percent))
    pairs = met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    seen = stars.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))  # verified before, and found to be no link
    pairs = pairs.join(seen, (F.least("a", "b") == F.col("lo")) & (F.greatest("a", "b") == F.col("hi")), "left_anti")
    more = written(_verified(pairs, docs, reps, id_col, text_col, k, percent, "jaccard-cross"), "jaccard-cross-links")
    every = components(links.unionByName(more), "jaccard")

    of_class = classes.join(every, classes["rep"] == every["id"], "left").select(
        "d1", "d2", "n", F.coalesce("component", "rep").alias("component"))
    out = sets.join(of_class, ["d1", "d2", "n"], "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def one_of_each_group(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component.

    Rows without an id stay.  Of rows that share id and text, one stays.
    """
    kept = groups.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("_kept_id")).distinct()
    held = docs.where(F.col(id_col).isNotNull()).join(kept, F.col(id_col) == F.col("_kept_id"), "left_semi")
    held = held.unionByName(docs.where(F.col(id_col).isNull()))
    return held.withColumn("_kept_text", F.md5(F.col(text_col).cast("binary"))).dropDuplicates([id_col, "_kept_text"]).drop("_kept_text")
