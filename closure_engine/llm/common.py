"""Helpers shared by the corpus operators: reading, written intermediates, byte slices."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from closure_engine.session import ensure_checkpoint_dir, setting

#: Separators of words: space and the five ASCII controls 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"
_WRITTEN: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` (with the writer's ``options``) under ``spark.checkpoint.dir`` as Parquet and return it reread.

    Cuts the lineage with files that every executor can read, so losing an
    executor never repeats the work above.  ``release`` removes the files.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which ``release`` removes."""
    ensure_checkpoint_dir(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    _WRITTEN.append(f"{root}/closure-{name}-{uuid.uuid4().hex}")
    return _WRITTEN[-1]


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete a table that ``written`` made and whose successor is written; nothing lazy may still read it."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        held = next((w for w in _WRITTEN if path.endswith(w.rsplit("/", 1)[1])), None)
        if held:
            _WRITTEN.remove(held)
            _delete(spark, held)


@contextmanager
def sized_batches(spark: SparkSession, limit: int = 4 << 20) -> Iterator[None]:
    """Inside, a batch of rows that Spark sends to Python ends at about ``limit`` bytes, not only at a number of rows of any length.

    Both sides hold a whole batch, the JVM in buffers that it doesn't give back.
    """
    with setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(limit)):
        yield


def release(spark: SparkSession) -> int:
    """Delete every intermediate table that ``written`` made in this process and that still exists; returns how many."""
    n = 0
    while _WRITTEN:
        _delete(spark, _WRITTEN.pop())
        n += 1
    return n


def shuffle_partitions(spark: SparkSession) -> int:
    """The cluster's number of shuffle partitions (a setting that grows with the data)."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def utf8_bytes(text: Column) -> Column:
    """UTF-8 length; 0 for a null text."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def byte_slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of about ``limit`` UTF-8 bytes each; a longer text makes a range of its own."""
    ends = np.cumsum(np.diff(string_buffers(texts)[1]))
    a = 0
    while a < len(texts):
        before = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield a, b
        a = b


def string_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without copying; nulls count as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[at[0]:at[-1]] if held else np.zeros(0, np.uint8)
    return data, at - at[0]


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def sparing(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An Arrow function that returns the worker process's free memory at a task's end; idle workers stay beside the JVM in later steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
        if trim:
            trim(0)

    return run
