"""Token ids as length-delimited binary records, with an offset index for shuffled reads.

Layout of a data set: ``<path>/records/`` holds the files, ``<path>/index/`` a
Parquet table of offsets.  A file is a row of frames and the eight bytes
``TRAILER``.  A frame is

    length of the payload       8 bytes, unsigned
    masked checksum of these 8  4 bytes
    payload                     id length (4 bytes; 0xFFFFFFFF: null), bytes per token (1 byte),
                                id as UTF-8, token ids
    masked checksum of it       4 bytes

with little-endian numbers throughout.  Checksums are CRC-32, masked by a
rotation and a constant, so that a checksum stored inside checked data doesn't
cancel out.  Token ids take two bytes where the vocabulary allows it, else four.

On Spark: rows are dealt by range of (id, hash of the text, row number), so the
files follow each other in ascending order of ids, nulls first, and copies of one
id are spread as well.  Within a range the rows are sorted, encoded and framed in
an Arrow function that hands on about ``file_bytes`` of frames at a time; Spark's
text writer stores each such string of bytes as a file of its own with the
trailer as its line end.  So the files go through Spark's commit protocol to any
storage that Spark can write, and a task that is repeated leaves no half file.
The index is read off the written files: one row a frame with its file's place
in the order (range, number in the range), offset, length and number of tokens,
and the running number of tokens before it, from sums per file and per range.

``read_records`` reads frames back by the index, all or chosen ones, in any
order; every frame that is read is checked against its checksums.

Results: a null text is empty, its only token is the end id.  Repeated rows are
separate records.  A null id is kept as null and comes first.  A file's size is
bounded by ``file_bytes`` and one record, a task's memory by a few of them.  Only
id and text are read, so other columns can't clash.  An empty table gives a data
set without records.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import byte_slices, column, shuffle_partitions, written
from .word_ids import worker_ids

#: Eight ASCII bytes that end a complete file.
TRAILER = "\nTOKREC1"
#: Chosen rows of the index that may be sent to every task: 24 bytes each, 6 MB.
FEW = 1 << 18
_HEAD = struct.Struct("<QI")
_INNER = struct.Struct("<IB")
_NULL = 0xFFFFFFFF


def masked_crc(data) -> int:
    """CRC-32, rotated right by 15 bits, plus a constant."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: str | None, ids: bytes, width: int) -> bytes:
    """One record; ``ids``: little-endian numbers of ``width`` bytes."""
    name = b"" if doc_id is None else doc_id.encode()
    payload = b"".join((_INNER.pack(_NULL if doc_id is None else len(name), width), name, ids))
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def read_frame(data: memoryview, at: int, whole: bool = True) -> tuple[str | None, np.ndarray | None, int, int]:
    """(id, token ids, number of tokens, length of the frame) at ``at``.

    ``whole=False`` checks the length's checksum only and leaves the ids out.
    """
    if at + 20 > len(data):
        raise ValueError(f"cut off record at {at}")
    length, check = _HEAD.unpack_from(data, at)
    if masked_crc(data[at:at + 8]) != check:
        raise ValueError(f"damaged length at {at}")
    start, end = at + 12, at + 12 + length
    if end + 4 > len(data):
        raise ValueError(f"cut off record at {at}")
    if whole and masked_crc(data[start:end]) != int.from_bytes(data[end:end + 4], "little"):
        raise ValueError(f"damaged record at {at}")
    named, width = _INNER.unpack_from(data, start)
    name = None if named == _NULL else bytes(data[start + 5:start + 5 + named]).decode()
    first = start + 5 + (0 if named == _NULL else named)
    ids = np.frombuffer(data[first:end], f"<u{width}") if whole else None
    return name, ids, (end - first) // width, end + 4 - at


def _file(data: bytes | memoryview) -> memoryview:
    """The frames of a file, whose trailer is checked; a file without any byte has none."""
    view = memoryview(data)
    if len(view) and bytes(view[-len(TRAILER):]) != TRAILER.encode():
        raise ValueError("a record file lacks its trailer")
    return view[:max(0, len(view) - len(TRAILER))]


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
                  file_bytes: int = 16 << 20, ranges: int | None = None) -> None:
    """Writes the data set: the record files, then the index read off them."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = ["id", "tie", "row"]
    dealt = rows.repartitionByRange(ranges or shuffle_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_ids(tokenizer)
        width = 2 if encoder.dtype.itemsize == 2 and end_id < 1 << 16 else 4
        end = end_id.to_bytes(width, "little")
        held: list[bytes] = []
        size = 0
        for batch in batches:
            texts = column(batch, "text")
            for a, b in byte_slices(texts, 1 << 20):
                for doc_id, text in zip(column(batch, "id")[a:b].to_pylist(), texts[a:b].to_pylist()):
                    ids = encoder.encode(text)
                    if width != encoder.dtype.itemsize:
                        ids = np.frombuffer(ids, encoder.dtype).astype("<u4").tobytes()
                    held.append(frame(doc_id, ids + end, width))
                    size += len(held[-1])
                    if size >= file_bytes:
                        yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["frames"])
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["frames"])
        pa.default_memory_pool().release_unused()

    files = dealt.select(F.col("id").cast("string").alias("id"), "text").mapInArrow(framed, "frames binary")
    files.select(F.col("frames").cast("string").alias("value")).write.option("lineSep", TRAILER).option("maxRecordsPerFile", 1).text(f"{path}/records")
    write_index(docs.sparkSession, path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(part, number, content): the record files by their place in the order."""
    name = F.element_at(F.split("path", "/"), -1)
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records").select(
        F.regexp_extract(name, r"^part-(\d+)", 1).cast("int").alias("part"),
        F.coalesce(F.regexp_extract(name, r"-c(\d+)\.", 1).try_cast("int"), F.lit(0)).alias("number"), "content")


def write_index(spark: SparkSession, path: str) -> None:
    """Reads the record files and writes (id, part, number, offset, length, n_tokens, start), one row a record."""

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, content in zip(*(column(batch, x) for x in ("part", "number", "content"))):
                data = _file(content.as_buffer())
                found, at, before = [], 0, 0
                while at < len(data):
                    name, _, n, length = read_frame(data, at, whole=False)
                    found.append((name, at, length, n, before))
                    at, before = at + length, before + n
                columns = list(zip(*found)) if found else [()] * 5
                k = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.string()), pa.array([part.as_py()] * k, pa.int32()), pa.array([number.as_py()] * k, pa.int32()),
                     *(pa.array(c, pa.int64()) for c in columns[1:])], ["id", "part", "number", "offset", "length", "n_tokens", "in_file"])

    found = _files(spark, path).mapInArrow(
        offsets, "id string, part int, number int, offset long, length long, n_tokens long, in_file long")
    found = written(found, "record-offsets")
    sums = found.groupBy("part", "number").agg(F.sum("n_tokens").alias("held"))
    sums = sums.withColumn("in_part", F.sum("held").over(Window.partitionBy("part").orderBy("number")) - F.col("held"))
    # one row a range: as many as the cluster has shuffle partitions, whatever the data
    parts = sums.groupBy("part").agg(F.sum("held").alias("held"))
    parts = parts.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("before"))
    starts = sums.join(parts, "part").select("part", "number", (F.col("before") + F.col("in_part")).alias("before"))
    (found.join(starts, ["part", "number"]).select("id", "part", "number", "offset", "length", "n_tokens", (F.col("before") + F.col("in_file")).alias("start"))
     .write.parquet(f"{path}/index"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id string, part int, number int, offset long, length long, n_tokens long, start long").parquet(f"{path}/index")


def _frames(part: int, number: int, content: pa.Scalar, offsets, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """The frames of a file at the given offsets (None: all), checked, in batches of bounded size."""
    data, out, arrays, size = _file(content.as_buffer()), [], [], 0
    at, places = 0, iter(offsets) if offsets is not None else None
    while at < len(data):
        if places is not None and (at := next(places, None)) is None:
            break
        name, ids, n, length = read_frame(data, at)
        out.append((part, number, at, name, n, zlib.crc32(ids.astype("<u4"))))
        if with_ids:
            arrays.append(ids)
        size += n if with_ids else 1
        at += length
        if size > 1 << 20:
            yield _rows(out, arrays, with_ids)
            out, arrays, size = [], [], 0
    yield _rows(out, arrays, with_ids)


def read_records(spark: SparkSession, path: str, chosen: DataFrame | None = None, with_ids: bool = True) -> DataFrame:
    """id (text), start, n_tokens, ids_crc32 (and ids) of the records that ``chosen`` rows of the index point at (default: all).

    ``chosen`` rows are counted: up to ``FEW`` of them are sent to the tasks, a
    list of offsets a file, and only these frames are touched.  More rows than
    that meet the frames by an equi-join on their place; file contents are never
    shuffled.  A row of the index without a fitting frame is an error.
    """
    index = read_index(spark, path) if chosen is None else chosen
    schema = "part int, number int, offset long, id string, found long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    files = _files(spark, path)
    few = chosen is not None and chosen.count() <= FEW
    if few:
        wanted = chosen.groupBy("part", "number").agg(F.sort_array(F.collect_set("offset")).alias("wanted"))
        files = files.join(F.broadcast(wanted), ["part", "number"])

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, content in enumerate(column(batch, "content")):
                offsets = column(batch, "wanted")[row].as_py() if few else None
                yield from _frames(column(batch, "part")[row].as_py(), column(batch, "number")[row].as_py(), content, offsets, with_ids)

    places = index.select("part", "number", "offset", "n_tokens", "start")
    met = places.join(files.mapInArrow(frames, schema), ["part", "number", "offset"], "left")
    fits = F.col("found").eqNullSafe(F.col("n_tokens"))
    checked = F.when(fits, F.col("n_tokens")).otherwise(F.raise_error(F.lit("the index does not fit the record files")).cast("long"))
    return met.select("id", "start", checked.alias("n_tokens"), "ids_crc32", *["ids"] * with_ids)


def _rows(out: list[tuple], arrays: list[np.ndarray], with_ids: bool) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    made = [pa.array(c, kind) for c, kind in zip(zip(*out) if out else [()] * 6, kinds)]
    if with_ids:
        ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
        made.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays or [np.zeros(0)]).astype(np.int32))))
    return pa.RecordBatch.from_arrays(made, ["part", "number", "offset", "id", "found", "ids_crc32"] + ["ids"] * with_ids)


def shuffled(spark: SparkSession, path: str, seed: int, ranks: int = 1, rank: int | None = None) -> DataFrame:
    """The records in an order that only ``seed`` decides, with their ``place`` key; of one of ``ranks`` readers, if asked for.

    The index is shuffled and cut, so a reader touches its own records only.
    """
    index = read_index(spark, path).withColumn("place", F.xxhash64("part", "number", "offset", F.lit(seed)))
    if rank is not None:
        index = index.where(F.pmod("place", F.lit(ranks)) == rank)
    found = read_records(spark, path, index.drop("place"))
    return found.join(index.select("start", "place"), "start").orderBy("place")
