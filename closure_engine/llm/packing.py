"""Mixture-controlled packing of token sequences by deficit round-robin.

Documents become token ids with an end id and are cut into pieces that fill
windows of ``window`` tokens.  Each source has a queue and a deficit counter.
When a window opens, every counter grows by the source's target share of the
window; round-robin then serves the sources whose counter holds at least
``least`` tokens, from the front of their queues, until the window is full.
What a source did not get (or got too much) stays in its counter for the next
windows, so each window is close to the target proportions and every run of
windows is closer still.  When a queue is empty, the others take its part.

On Spark: an Arrow function encodes every text once and writes the ids.  The
documents are then dealt by hash into blocks of about ``block_bytes`` of ids
(four bytes each), one task each, so every block has a like mixture of sources.
The targets are the sources' shares of all tokens (or given weights).  The
tokens of every (block, source) are added up; running sums over the blocks, in
groups of blocks and within them, tell by how many tokens the blocks before left each
source behind its target, and the block's counters start from exactly that:
deficits cross partitions without one partition waiting for another.

The last tokens of a block, fewer than a window, fill sequences whose lengths
are powers of two, so nothing is padded.  A null text is empty: its only token
is the end id.  A null source is a source of its own.  Repeated rows are packed
one by one; rows that repeat inside a partition of the input are dealt by their place, so
that no block has more copies of a row than the input has partitions.  Only id,
text and source are read, so other columns can't clash.  An empty table gives an
empty table.
"""

from __future__ import annotations

import zlib
from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_slices, column, sparing, written
from .word_ids import worker_ids

#: Sequence numbers: the block in the upper bits, the place in the block in the lower ones.
_BLOCK_BITS = 32
#: Size of a queue's documents that are brought into their final form at once.
_AHEAD = 1 << 17
#: Blocks whose running sums are taken together.
_TOGETHER = 1 << 10


class _Queue:
    """The documents of one source: the next ones as ids, the others as rows."""

    def __init__(self, encode, end: int):
        self.rows: deque = deque()
        self.encode, self.end = encode, np.array([end], "<u4")
        self.next: deque = deque()
        self.ids, self.id, self.at = None, None, 0

    def ready(self) -> bool:
        if self.ids is None or self.at == len(self.ids):
            if not self.next:
                if not self.rows:
                    return False
                batch, size = [], 0
                while self.rows and size < _AHEAD:
                    batch.append(self.rows.popleft())
                    size += len(batch[-1][1])
                self.next.extend(zip((i for i, _ in batch), self.encode([t for _, t in batch])))
            self.id, ids = self.next.popleft()
            self.ids, self.at = np.concatenate((np.frombuffer(ids, "<u4"), self.end)), 0
        return True

    def take(self, most: int) -> tuple:
        """(doc id, start, ids of the piece, tokens of the document)."""
        start = self.at
        self.at = min(len(self.ids), start + most)
        return self.id, start, self.ids[start:self.at], len(self.ids)


def round_robin(queues: list[_Queue], shares: list[float], deficits: list[float], window: int,
                least: int) -> Iterator[tuple[int, int, tuple]]:
    """(sequence, offset, piece), window after window, until all queues are empty."""
    deficits, sequence = list(deficits), 0
    while any(q.ready() for q in queues):
        room = window
        deficits = [d + s * window for d, s in zip(deficits, shares)]
        while room:
            ready = [i for i, q in enumerate(queues) if q.ready()]
            if not ready:
                break
            due = [i for i in ready if deficits[i] >= least] or [max(ready, key=deficits.__getitem__)]
            for i in due:
                give = min(room, max(least, int(deficits[i])))
                while give and queues[i].ready():
                    piece = queues[i].take(give)
                    n = len(piece[2])
                    yield sequence, window - room, piece
                    room, give, deficits[i] = room - n, give - n, deficits[i] - n
                if not room:
                    break
        sequence += 1


def _powers_of_two(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def _cut(pieces: list[tuple[int, tuple]], first: int) -> Iterator[tuple[int, int, tuple]]:
    """The pieces of an unfilled window, cut to sequences of powers of two."""
    lengths = _powers_of_two(sum(len(p[2]) for _, p in pieces))
    sequence, offset = 0, 0
    for _, (doc, start, ids, total) in pieces:
        while len(ids):
            n = min(len(ids), lengths[sequence] - offset)
            yield first + sequence, offset, (doc, start, ids[:n], total)
            ids, start, offset = ids[n:], start + n, offset + n
            if offset == lengths[sequence]:
                sequence, offset = sequence + 1, 0


def pack_block(rows: list[tuple], shares: dict, deficits: dict, encode, end: int, window: int,
               least: int) -> Iterator[tuple[int, int, tuple]]:
    """(sequence, offset, piece) of one block; ``rows``: (id, source, text)."""
    by_source: dict = {}
    for doc, source, text in rows:
        by_source.setdefault(source, _Queue(encode, end)).rows.append((doc, text))
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    waiting: list[tuple[int, tuple]] = []
    at = 0
    for sequence, offset, piece in round_robin([by_source[s] for s in names], [shares.get(s, 0.0) for s in names],
                                               [deficits.get(s, 0.0) for s in names], window, least):
        if sequence != at:
            yield from ((at, o, p) for o, p in waiting)
            waiting, at = [], sequence
        waiting.append((offset, piece))
    if sum(len(p[2]) for _, p in waiting) == window:
        yield from ((at, o, p) for o, p in waiting)
    else:
        yield from _cut(waiting, at)


def encoded_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """id, source, ids (bytes, without the end id), n (tokens with it), deal (hash by which a row is dealt).

    Equal rows of one partition get different ``deal`` values, from the second
    one on and from the first one on where the second follows in the same Arrow batch.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("id", "source", "text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_ids(tokenizer)
        part, met = TaskContext.get().partitionId() + 1, Counter()
        width = encoder.dtype.itemsize
        for batch in batches:
            texts, keys = column(batch, "text"), column(batch, "h").to_pylist()
            here = Counter(keys)
            places = []
            for h in keys:
                again = met[h]
                places.append((part << 36) + again if again or here[h] > 1 else 0)
                met[h] += 1
            for a, b in byte_slices(texts, 1 << 20):
                ids = [encoder.encode(t) for t in texts[a:b].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "id")[a:b], column(batch, "source")[a:b], pa.array(ids, pa.binary()),
                     pa.array([len(x) // width + 1 for x in ids], pa.int64()), column(batch, "h")[a:b], pa.array(places[a:b], pa.int64())],
                    ["id", "source", "ids", "n", "h", "place"])

    made = rows.mapInArrow(sparing(encode), f"id {id_type}, source string, ids binary, n long, h long, place long")
    return made.select("id", "source", "ids", "n", F.xxhash64("h", "place").alias("deal"))


def carried_deficits(held: DataFrame, share: DataFrame) -> DataFrame:
    """(block, source, share, behind): tokens by which the blocks before left the source behind its target.

    ``held``: (block, source, tokens), ``share``: (name, share), one row a
    source.  Running sums over groups of ``_TOGETHER`` blocks, then within each
    group, so a task sees a group's blocks or one row a group.
    """
    held = held.withColumn("group", F.floor(F.col("block") / F.lit(_TOGETHER)))

    def before(order: str, *keys: str):
        return F.sum("tokens").over(Window.partitionBy(*keys).orderBy(order)) - F.col("tokens")

    of_block = held.groupBy("group", "block").agg(F.sum("tokens").alias("tokens"))
    of_group = of_block.groupBy("group").agg(F.sum("tokens").alias("tokens")).select("group", before("group").alias("earlier"))
    upto = of_block.select("group", "block", before("block", "group").alias("within")).join(of_group, "group")
    own_group = held.groupBy("group", "source").agg(F.sum("tokens").alias("tokens")).select(
        F.col("group").alias("of_group"), F.col("source").alias("of"), before("group", "source").alias("own_earlier"))
    own = held.select("group", "block", "source", before("block", "group", "source").alias("own_within"))
    own = own.join(own_group, (F.col("group") == F.col("of_group")) & F.col("source").eqNullSafe(F.col("of")))
    own = own.join(share, F.col("source").eqNullSafe(F.col("name"))).select("block", "source", "share", (F.col("own_earlier") + F.col("own_within")).alias("own"))
    return own.join(upto.select("block", (F.col("earlier") + F.col("within")).alias("upto")), "block").select(
        "block", "source", "share", (F.col("share") * F.col("upto") - F.col("own")).alias("behind"))


def pack_sequences(docs: DataFrame, tokenizer: str, weights: dict | None = None, window: int = 2048, end_id: int = 1,
                   least: int = 256, block_bytes: int = 8 << 20, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source", with_ids: bool = False) -> DataFrame:
    """One row a piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).

    ``weights``: target share by source name, instead of the sources' shares of
    all tokens; a source that is missing has weight 0 and is packed at the end.
    """
    rows = written(encoded_documents(docs, tokenizer, id_col, text_col, source_col), "pack-ids", compression="zstd")
    id_type = rows.schema["id"].dataType.simpleString()
    weight = F.lit(None).cast("double")
    for name, share in (weights or {}).items():
        weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(share))).otherwise(weight)
    blocks = max(1, -(-4 * (rows.agg(F.sum("n")).first()[0] or 0) // block_bytes))
    rows = rows.withColumn("block", F.pmod("deal", F.lit(blocks)))
    held = written(rows.groupBy("block", "source").agg(F.sum("n").alias("tokens")), "pack-held")
    share = held.groupBy("source").agg(F.sum("tokens").cast("double").alias("share"))
    if weights:
        share = share.withColumn("share", F.coalesce(weight, F.lit(0.0)))
    of = F.sum("share").over(Window.partitionBy())  # one row a source
    share = share.select(F.col("source").alias("name"), F.when(of > 0, F.col("share") / of).otherwise(0.0).alias("share"))
    plan = carried_deficits(held, share).groupBy("block").agg(F.collect_list(F.struct("source", "share", "behind")).alias("plan"))
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = f"`{id_col}` {id_type}, " + ", ".join(f"{x} long" for x in names) + (", ids array<int>" if with_ids else "")

    def pack_group(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = worker_ids(tokenizer).dtype
        block = left.column("block")[0].as_py()
        plan_rows = right.column("plan")[0].as_py() if right.num_rows else []
        out: dict = {x: [] for x in ("id", *names)}
        held_ids = []
        order = sorted(zip(left.column("id").to_pylist(), left.column("source").to_pylist(), left.column("ids").to_pylist()),
                       key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1] is None, r[1] or "", r[2]))
        widen = lambda some: [np.frombuffer(x, kind).astype("<u4").tobytes() for x in some]
        for sequence, offset, (doc, start, ids, n) in pack_block(
                order, {x["source"]: x["share"] for x in plan_rows}, {x["source"]: x["behind"] for x in plan_rows},
                widen, end_id, window, least):
            for x, v in zip(out, (doc, start, len(ids), zlib.crc32(ids), n, (block << _BLOCK_BITS) + sequence, offset)):
                out[x].append(v)
            if with_ids:
                held_ids.append(ids.astype(np.int32))
        columns = [pa.array(out["id"], left.schema.field("id").type), *(pa.array(out[x], pa.int64()) for x in names)]
        if with_ids:
            ends = np.cumsum([0, *map(len, held_ids)]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(held_ids or [np.zeros(0, np.int32)]))))
        pa.default_memory_pool().release_unused()  # a worker process serves many blocks
        return pa.table(columns, [id_col, *names] + ["ids"] * with_ids)

    return rows.select("id", "source", "ids", "block").groupBy("block").cogroup(plan.groupBy("block")).applyInArrow(pack_group, schema)
