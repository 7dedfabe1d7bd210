"""Embedding near-duplicates by E8 lattice hashing.

Every table projects the unit vectors at random to a few blocks of eight
dimensions and decodes each block to the nearest point of the E8 lattice; the
points of all blocks are the vector's cell.  A vector is also looked for in
neighbouring cells: per block, the lattice points that are next nearest.  Pairs
that meet in a cell are verified by cosine in double precision.

Steps on Spark:

1. Equal unit vectors form a class with a number of its own, its smallest id,
   and its size as weight.
2. In each cell every vector is paired with the smallest one at home there.
   Verified pairs give first components.
3. In the cells where several components still meet, all pairs across
   components are verified; the final components follow.
4. All links of a vector lie inside its component, so they are counted there:
   components are cut into chunks of ``CHUNK`` vectors and pairs of chunks are
   multiplied, which needs no list of pairs.  That is exact and costs the square
   of a component's number of classes in products, and each vector is sent once
   per chunk of its component.

The number of blocks follows from the number of vectors, so that cells stay
small; as each block makes a linked pair less likely to share a cell of a table, the
number of tables grows with the blocks (``tables_for``), which keeps the recall
of the weakest links.  Vectors that are null, empty, zero, or hold null or
non-finite components link with nothing; vectors of different lengths never
link.  Every row is a vector of its own: rows that share an id each have the
links of their own vector, and the id's smallest value names what they reach.  A
row without an id links with nothing, has no component and isn't kept.  Other
columns are not read.  An empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, written
from .components import components
from .rolling import mix

#: Tables for two blocks.
TABLES = 10
#: Scale of the projections: linked vectors land about half a cell apart.
SCALE = 0.6
#: Neighbouring lattice points tried in a block.
NEAR = 2
#: Vectors of a chunk when links are counted.
CHUNK = 512
_U = np.uint64


def tables_for(blocks: int) -> int:
    """Tables that keep the recall of links at the limit at 0.97 or more, by measured shares of pairs that a table brings together.

    These are 0.5, 0.3 and 0.16 for 2, 3 and 4 blocks (random pairs of 64
    dimensions with a cosine of 0.95), about 0.55 of the share of one block less.
    """
    return math.ceil(TABLES * 1.8 ** (blocks - 2))


def e8_roots() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((-2, 2), repeat=2):
            v = [0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [v for v in itertools.product((-1, 1), repeat=8) if v.count(-1) % 2 == 0]
    return np.array(out)


def _decode_d8(y: np.ndarray) -> np.ndarray:
    """Nearest whole points with an even sum."""
    near = np.rint(y)
    rest = y - near
    odd = np.flatnonzero(near.sum(1) % 2 != 0)
    worst = np.abs(rest[odd]).argmax(1)
    near[odd, worst] += np.where(rest[odd, worst] >= 0, 1, -1)
    return near


def decode_e8(y: np.ndarray) -> np.ndarray:
    """The nearest points of E8, doubled so that they are whole."""
    whole, half = _decode_d8(y), _decode_d8(y - 0.5) + 0.5
    nearer = ((y - half) ** 2).sum(1) < ((y - whole) ** 2).sum(1)
    return np.where(nearer[:, None], half, whole) * 2


class Cells:
    """The cells of unit vectors of one length."""

    def __init__(self, dim: int, tables: int, blocks: int, seed: int):
        r = np.random.default_rng([seed, dim])
        self.planes = r.normal(0, SCALE, (tables, blocks, dim, 8))
        self.weights = r.integers(1, 1 << 62, (blocks, 8)).astype(_U) * _U(2) + _U(1)
        self.salt = mix(np.arange(1, tables + 1, dtype=_U) * _U(1_000_003) + _U(dim))
        self.roots = e8_roots()

    def of(self, units: np.ndarray, table: int) -> list[np.ndarray]:
        """Keys of the cells: the home cell, then the neighbouring ones (up to two blocks moved)."""
        parts = []  # per block: hash of the nearest point and of the next ones
        for b, plane in enumerate(self.planes[table]):
            y = units @ plane
            point = decode_e8(y)
            best = np.argsort(-((y - point / 2) @ self.roots.T), 1, kind="stable")[:, :NEAR]
            points = [point, *(point + self.roots[best[:, i]] for i in range(NEAR))]
            parts.append([(p.astype(np.int64).view(_U) * self.weights[b]).sum(1, dtype=_U) for p in points])
        moves = sorted((m for m in itertools.product(range(NEAR + 1), repeat=len(parts)) if sum(x > 0 for x in m) <= 2), key=lambda m: (sum(x > 0 for x in m), m))
        return [mix(sum(parts[b][i] for b, i in enumerate(m)) ^ self.salt[table]) for m in moves]


def _unit_rows(batch: pa.RecordBatch, vec_col: str) -> list[np.ndarray | None]:
    out = []
    for v in column(batch, vec_col):
        values = v.as_py()
        if not values or None in values:
            out.append(None)
            continue
        x = np.array(values, float)
        top = np.abs(x).max()
        x = x / top if np.isfinite(top) and top > 0 else x
        out.append(x / np.sqrt((x * x).sum()) if np.isfinite(x).all() and top > 0 else None)
    return out


def _units(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, dim, unit (doubles as bytes), h1 and h2 (a hash of them); null where a vector can't link."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _unit_rows(batch, vec_col)
            held = [None if x is None else (x + 0.0).tobytes() for x in units]  # -0.0 becomes 0.0
            hashes = []
            for x in units:
                bits = None if x is None else (x + 0.0).view(_U)
                hashes.append((None, None) if bits is None else tuple(
                    int((mix(bits + _U(s)) * (np.arange(len(bits), dtype=_U) * _U(2) + _U(1))).sum(dtype=_U).view(np.int64)) for s in (0, 0x9E37)))
            yield pa.RecordBatch.from_arrays(
                [column(batch, id_col).cast(pa.int64()), pa.array([None if x is None else len(x) for x in units], pa.int32()),
                 pa.array(held, pa.binary()), pa.array([h[0] for h in hashes], pa.int64()), pa.array([h[1] for h in hashes], pa.int64())],
                ["id", "dim", "unit", "h1", "h2"])

    return vectors.select(id_col, vec_col).mapInArrow(clean, "id long, dim int, unit binary, h1 long, h2 long")


def _matrix(units: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_py()) for x in units]) if len(units) else np.zeros((0, 0))


def _cell_rows(reps: DataFrame, blocks: int, seed: int) -> DataFrame:
    """key, id, home: every vector's home cell and neighbouring cells in all tables."""
    tables = tables_for(blocks)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Cells] = {}
        for batch in batches:
            dims = column(batch, "dim").to_numpy()
            for dim in np.unique(dims).tolist():
                rows = batch.filter(pa.array(dims == dim))
                units, ids = _matrix(column(rows, "unit")), column(rows, "id")
                cells = made.setdefault(dim, Cells(dim, tables, blocks, seed))
                for table in range(tables):
                    for i, keys in enumerate(cells.of(units, table)):
                        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), ids, pa.array(np.full(len(ids), i == 0))], ["key", "id", "home"])

    return reps.select("id", "dim", "unit").mapInArrow(place, "key long, id long, home boolean")


def _verified(pairs: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = np.flatnonzero(np.array([len(x.as_py()) == len(y.as_py()) for x, y in zip(column(batch, "ua"), column(batch, "ub"))], bool))
            rows = batch.take(pa.array(same))
            cos = np.array([np.frombuffer(x.as_py()) @ np.frombuffer(y.as_py()) for x, y in zip(column(rows, "ua"), column(rows, "ub"))], float)
            yield rows.select(["a", "b"]).filter(pa.array(cos >= least))

    units = reps.select("id", "unit")
    joined = pairs.join(units.select(F.col("id").alias("a"), F.col("unit").alias("ua")), "a").join(
        units.select(F.col("id").alias("b"), F.col("unit").alias("ub")), "b")
    return joined.select("a", "b", "ua", "ub").mapInArrow(check, "a long, b long")


def _link_counts(members: DataFrame, least: float) -> DataFrame:
    """id, links: weights of the other classes that a class links with; ``members``: component, id, unit, weight."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / CHUNK).cast("long").alias("chunks"))
    cut = members.join(sizes, "component").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    cut = cut.withColumn("lo", F.least("chunk", "other")).withColumn("hi", F.greatest("chunk", "other"))

    def count(group: pa.Table) -> pa.Table:
        low = group.column("chunk").to_numpy() == group.column("lo")[0].as_py()
        ids, weight = group.column("id").to_numpy(), group.column("weight").to_numpy()
        units = [np.frombuffer(x.as_py()) for x in group.column("unit")]
        links = np.zeros(len(ids), np.int64)
        sides = [np.flatnonzero(low)] * 2 if low.all() else [np.flatnonzero(low), np.flatnonzero(~low)]
        near = np.stack([units[i] for i in sides[0]]) @ np.stack([units[i] for i in sides[1]]).T >= least
        near &= ids[sides[0]][:, None] != ids[sides[1]][None]
        links[sides[0]] += near @ weight[sides[1]]
        if not low.all():
            links[sides[1]] += weight[sides[0]] @ near
        return pa.table({"id": pa.array(ids), "links": pa.array(links)})

    return cut.select("component", "lo", "hi", "chunk", "id", "unit", "weight").groupBy("component", "lo", "hi").applyInArrow(
        count, "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicate_vectors(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding",
                           seed: int = 8) -> DataFrame:
    """id, n_links, component_id, kept for every row of ``vectors``; ids are whole numbers."""
    units = written(_units(vectors, id_col, vec_col), "lattice-units")
    usable = units.where("unit is not null and id is not null")
    # equal vectors have equal bytes: any of them stands for the class
    classes = usable.groupBy("h1", "h2", "dim").agg(F.min("id").alias("lowest"), F.count("*").alias("weight"), F.min("unit").alias("unit"))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "lattice-classes")
    reps = classes.select("id", "dim", "unit", "weight")
    # one block has about 1400 cells with vectors in them
    blocks = max(2, math.ceil(math.log(max(reps.count(), 2)) / math.log(1400)))
    cells = written(_cell_rows(reps, blocks, seed), "lattice-cells")

    leads = cells.where("home").groupBy("key").agg(F.min("id").alias("lead"))
    stars = cells.join(leads, "key").where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    links = written(_verified(stars, reps, least), "lattice-star")
    first = components(links, "lattice-star")

    placed = cells.join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.max("home").alias("lived")).where(
        "low < high and lived").select("key")
    open_ = written(placed.join(mixed, "key", "left_semi"), "lattice-open")
    x, y = open_.where("home").alias("x"), open_.alias("y")
    met = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.component") != F.col("y.component"))).select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    more = written(_verified(met, reps, least), "lattice-cross")
    every = written(components(links.unionByName(more), "lattice"), "lattice-components")

    grouped = classes.drop("h1", "h2", "dim").join(every, "id", "left").withColumn("component", F.coalesce("component", "id"))
    linked = every.select("component").distinct()
    counts = _link_counts(grouped.join(linked, "component", "left_semi"), least)
    named = grouped.groupBy("component").agg(F.min("lowest").alias("component_id"))
    of_class = classes.select("id", "h1", "h2", "dim", "weight").join(grouped.select("id", "component"), "id").join(named, "component").join(
        counts, "id", "left").select("h1", "h2", "dim", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    # a row without an id has no class
    hashes = [F.when(F.col("id").isNotNull(), F.col(c)).alias(c) for c in ("h1", "h2", "dim")]
    out = units.select("id", *hashes).join(of_class, ["h1", "h2", "dim"], "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "id").alias("component_id")).withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
