"""Quality rules by repetition coverage.

For several n-gram lengths, rolling hashes find the word n-grams that a text
holds twice or more; the words that any of them covers are measured in
characters (code points), and so are the lines that equal an earlier line.  A
text is kept if it passes the base rule and no coverage exceeds its limit:

* base rule: at least ``min_words`` words, and at most ``base_percent`` percent
  of the words inside 5-word windows found twice or more;
* ``gram_limits``: length -> largest share of the words' characters inside
  duplicated n-grams of that length;
* ``line_limit``: largest share of the words' characters on lines that equal an
  earlier line of the text;
* ``symbol_limit``: most symbols a word (repetition of single characters).

All is computed on whole texts in one pass over Arrow batches, in slices of
bounded bytes; nothing is shuffled.  A null or empty text has no words and
fails the base rule.  Repeated rows give repeated rows.  Only id and text are
read, so other columns can't clash.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import byte_slices, column, sparing, string_buffers
from .rolling import Texts, mix, repeated

BASE_GRAM = 5
GRAM_LIMITS = {5: 0.30, 8: 0.25, 13: 0.20}
LINE_LIMIT = 0.30
SYMBOL_LIMIT = 1.0
_SYMBOL = np.zeros(256, bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", np.uint8)] = True


def _lines(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, text) of the lines that hold a word."""
    cut = np.flatnonzero(t.data == 10)
    filled = np.diff(t.ends) > 0
    start = np.sort(np.concatenate((t.ends[:-1][filled], cut + 1)))
    doc = np.searchsorted(t.ends, start, "right") - 1
    own = np.flatnonzero(np.append(start, len(t.data))[:-1] < len(t.data))  # not behind a text's last line break
    start, doc = start[own], doc[own]
    keep = np.append(True, start[1:] != start[:-1]) if len(start) else np.zeros(0, bool)
    start, doc = start[keep], doc[keep]
    stop = np.append(start[1:], len(t.data)) if len(start) else start
    stop = np.where(t.data[stop - 1] == 10, stop - 1, stop) if len(stop) else stop
    worded = np.searchsorted(t.start, stop) > np.searchsorted(t.start, start)
    return start[worded], stop[worded], doc[worded]


def measure(texts: pa.Array, gram_limits: dict[int, float], line_limit: float) -> dict[str, np.ndarray]:
    """The counts of each text and the largest coverage relative to its limit."""
    data, ends = string_buffers(texts)
    t = Texts(data, ends)
    salt = mix(np.arange(t.n, dtype=np.uint64) + np.uint64(1))  # windows and lines are compared within a text only
    char = (data & 0xC0) != 0x80
    out = {"n_words": t.n_words.astype(np.int64), "word_chars": t.per_text(t.solid & char),
           "n_symbols": t.per_text(_SYMBOL[data])}
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum(char, out=chars[1:])
    of_word = chars[t.stop] - chars[t.start]
    words, whole, over = t.words(), np.maximum(out["word_chars"], 1), np.zeros(t.n)
    for n in sorted({BASE_GRAM, *gram_limits}):
        grams, at = t.grams(words, n)
        at = at[repeated(grams ^ salt[t.doc[at]])]
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + n, -1)
        covered = np.cumsum(edge)[:-1] > 0
        if n == BASE_GRAM:
            out["n_repeat_words"] = np.bincount(t.doc[covered], minlength=t.n).astype(np.int64)
        if n in gram_limits:
            share = np.bincount(t.doc[covered], of_word[covered], minlength=t.n) / whole
            out[f"coverage_{n}"] = share
            over = np.maximum(over, share / gram_limits[n])
    start, stop, doc = _lines(t)
    keys = t.ranges(start, stop) ^ salt[doc]
    order = np.argsort(keys, kind="stable")
    later = np.zeros(len(keys), bool)  # equal to an earlier line
    if len(keys):
        later[order[1:]] = keys[order][1:] == keys[order][:-1]
    out["n_dup_lines"] = np.bincount(doc[later], minlength=t.n).astype(np.int64)
    solid = np.zeros(len(data) + 1, np.int64)
    np.cumsum(t.solid & char, out=solid[1:])
    on_lines = np.bincount(doc[later], (solid[stop] - solid[start])[later], minlength=t.n)
    out["line_coverage"] = on_lines / whole
    out["over"] = np.maximum(over, out["line_coverage"] / line_limit)
    return out


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 10,
                  base_percent: int = 20, gram_limits: dict[int, float] | None = None, line_limit: float = LINE_LIMIT, symbol_limit: float = SYMBOL_LIMIT,
                  slice_bytes: int = 1 << 20, keep: bool = False) -> DataFrame:
    """id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, the coverages.

    ``keep``: return the rows of ``docs`` that are kept instead, with their own columns.
    """
    limits = GRAM_LIMITS if gram_limits is None else gram_limits
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    shares = (*(f"coverage_{n}" for n in sorted(limits)), "line_coverage")
    chosen = docs if keep else docs.select(id_col, text_col)
    schema = chosen.schema if keep else (
        f"`{id_col}` {chosen.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{x} long" for x in counts)
        + ", base_failed boolean, kept boolean, " + ", ".join(f"{x} double" for x in shares))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in byte_slices(column(batch, text_col), slice_bytes):
                part = batch.slice(a, b - a)
                m = measure(column(part, text_col), limits, line_limit)
                failed = (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > base_percent * m["n_words"])
                kept = ~failed & (m["over"] <= 1.0) & (m["n_symbols"] <= symbol_limit * m["n_words"])
                if keep:
                    yield part.filter(pa.array(kept))
                else:
                    yield pa.RecordBatch.from_arrays(
                        [column(part, id_col), *(pa.array(m[x]) for x in counts), pa.array(failed), pa.array(kept),
                         *(pa.array(m[x].astype(np.float64)) for x in shares)],
                        [id_col, *counts, "base_failed", "kept", *shares])

    return chosen.mapInArrow(sparing(judge), schema)
