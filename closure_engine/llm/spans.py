"""Helpers of the operators that find spans in texts."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, column, sparing, string_buffers

#: (kind, start, end) in code points, end exclusive.
Span = tuple[str, int, int]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def having(texts: pa.Array, wanted: np.ndarray) -> np.ndarray:
    """Which texts hold a byte of the table ``wanted`` (256 flags)."""
    data, ends = string_buffers(texts)
    sums = np.zeros(len(data) + 1, np.int64)
    np.cumsum(wanted[data], out=sums[1:])
    return np.diff(sums[ends]) > 0


def byte_table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


def text_slices(batches: Iterator[pa.RecordBatch], text_col: str, limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of the batches with texts of bounded bytes in all."""
    for batch in batches:
        for a, b in byte_slices(column(batch, text_col), limit):
            part = batch.slice(a, b - a)
            yield part, column(part, text_col)


def span_rows(docs: DataFrame, id_col: str, text_col: str, counts: tuple[str, ...],
              find: Callable[[list[str | None], pa.Array], list[tuple[list[Span], list[Span]]]]) -> DataFrame:
    """id, the number of base spans of each kind, base_sha256, spans.

    ``find`` gets the texts of a slice and returns (base, all) spans of each.
    """
    chosen = docs.select(id_col, text_col)
    schema = f"`{id_col}` {chosen.schema[id_col].dataType.simpleString()}, " + "".join(f"n_{k} long, " for k in counts) + (
        "base_sha256 string, spans string")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, text_col):
            found = find(texts.to_pylist(), texts)
            yield pa.RecordBatch.from_arrays(
                [column(part, id_col),
                 *(pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in counts),
                 pa.array([digest(base) for base, _ in found]), pa.array([joined(every) for _, every in found])],
                [id_col, *(f"n_{k}" for k in counts), "base_sha256", "spans"])

    return chosen.mapInArrow(sparing(scan), schema)


def redacted(docs: DataFrame, text_col: str,
             find: Callable[[list[str | None], pa.Array], list[tuple[list[Span], list[Span]]]]) -> DataFrame:
    """The rows of ``docs`` with every span replaced by its kind in angle brackets; a null text stays null."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, text_col):
            out = []
            for text, (_, spans) in zip(texts.to_pylist(), find(texts.to_pylist(), texts)):
                pieces, at = [], 0
                for kind, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
                    if b > at:
                        pieces += [text[at:max(a, at)], f"<{kind}>" if a >= at else ""]
                        at = b
                out.append(None if text is None else "".join(pieces) + text[at:])
            i = part.schema.get_field_index(text_col)
            yield part.set_column(i, part.schema.field(i), pa.array(out, part.schema.field(i).type))

    return docs.mapInArrow(sparing(rewrite), docs.schema)
