"""Cross-tokenizer alignment by diagonal run skipping, and corpus-wide counts of the linked token ids.

A text with a space before it is encoded by a byte-level BPE (A) and, with the
space that the library itself adds, by a sentencepiece model (B).  Where tokens
of both end at the same byte, the text is cut; between two cuts lies a group, and
every A token of a group is linked with every B token of it.

The cuts are found on the two arrays of ends.  At the current index shift (index
in B less index in A) the arrays are compared by exponential probing: stretches of
1, 2, 4, ... ends that agree are jumped as one-to-one groups, the first stretch
that differs is halved down to the first end that differs.  There an irregular
group is resolved locally, end by end, until both ends agree again, which gives
the shift for the next run.

On Spark: an Arrow function encodes and aligns, and writes one row a document
with its figures and its distinct links (pairs of ids with their number), long
lists cut to rows of at most ``LIST`` pairs.  How many documents hold a pair is
a partial aggregate over all of them; the highest count of each A id is a window
over at most as many rows as B has ids.  The documents then look their pairs up: the
pairs held by most documents, at most 2^18 by construction (each has at least
the 2^18th part of all rows), are sent to the tasks, the others meet the counts
by an equi-join, in which no pair has more rows than that.

Results: null and empty texts, and texts whose joined token bytes differ from
space and text on either side (such as texts with U+2581), have no tokens: all
figures are 0 and the hash is ''.  Repeated rows are documents of their own and
count as such.  Only id and text are read, so other columns can't clash.  An
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closure_engine.operators.skew import hot_keys

from .common import byte_slices, column, written
from .token_counts import _BYTE_CHARS, _SAFE
from .word_ids import worker_ids

#: Most pairs in the list of one row, and most links that are spelled out at a time.
LIST = 1 << 16
AT_ONCE = 1 << 20
#: Ends that are compared one by one before stretches are.
_PROBE = 16
#: Longer parts of a text are not remembered.
_LONG = 64
#: Most pairs whose counts are sent to every task.
MOST_SENT = 1 << 18
_FIGURES = ("n_a", "n_b", "n_groups", "n_links")


class _Lossy(Exception):
    """A part's token bytes are not the part's."""


class PieceIds:
    """Ids of a sentencepiece model, word by word where no piece holds a space inside."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.dtype = np.dtype("<u2" if n <= 1 << 16 else "<u4")
        #: No merge crosses a space after a word then, so the words' ids are those of the text.
        self.by_words = not any("▁" in p.lstrip("▁") for p in pieces)
        self.code = "H" if self.dtype.itemsize == 2 else "I"

    def checked(self, part: str, ids: list[int]) -> bytes | None:
        """The ids as bytes; None where their bytes are not those of a space and the part."""
        if b"".join(map(self.bytes.__getitem__, ids)) != b" " + part.encode():
            return None
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def ask(self, part: str) -> bytes:
        """The ids of a part with a space before it; checked against its bytes."""
        value = self.checked(part, self.model.encode(part) if part else [self.model.piece_to_id("▁")])
        if value is None:
            raise _Lossy
        return value

    def spaced(self, text: str) -> bytes:
        """Ids of the text, to which the model itself adds a space; raises ``_Lossy`` where their bytes differ."""
        if not self.by_words:
            return self.ask(text)
        return b"".join(self.ask(part[1:]) for part in _SAFE.split(" " + text))


def token_bytes(tokenizer) -> list[bytes]:
    """The bytes of every entry of a byte-level tokenizer, by id."""
    back = {chr(c): b for b, c in _BYTE_CHARS.items()}
    entry = tokenizer.id_to_token
    return [bytes(back.get(c, ord(c) & 0xFF) for c in entry(i) or "") for i in range(tokenizer.get_vocab_size(True))]


def irregular_groups(a: list[int], b: list[int]) -> list[int]:
    """First and last index in A, first and last in B, of each group that isn't one token to one, one after the other.

    ``a``, ``b``: ascending ends that share their last one.  Probing begins with
    ``_PROBE`` single ends, as most stretches are short, and doubles from there.
    """
    found: list[int] = []
    k = shift = 0
    n = len(a)
    while True:
        near = min(k + _PROBE, n)
        while k < near and a[k] == b[k + shift]:
            k += 1
        if k == n:
            return found
        if k == near:
            step = _PROBE
            while k < n and a[k:k + step] == b[k + shift:k + shift + step]:
                k, step = k + step, 2 * step
            k = min(k, n)
            while step > _PROBE and k < n:
                step //= 2
                if a[k:k + step] == b[k + shift:k + shift + step]:
                    k += step
            continue
        x, y = k, k + shift
        end_a, end_b = a[x], b[y]
        while end_a != end_b:
            if end_a < end_b:
                x += 1
                end_a = a[x]
            else:
                y += 1
                end_b = b[y]
        found += (k, x, k + shift, y)
        k, shift = x + 1, y - x


def group_sizes(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B in each group, from two ascending lists of ends that share their last end."""
    found = np.array(irregular_groups(a, b), np.int64).reshape(-1, 4)

    def sizes(n: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        inside = last - first  # tokens of an irregular group before its last one
        ends = np.ones(n, bool)
        ends[np.repeat(first, inside) + np.arange(inside.sum()) - np.repeat(np.cumsum(inside) - inside, inside)] = False
        return np.diff(np.flatnonzero(ends), prepend=-1)

    return sizes(len(a), found[:, 0], found[:, 1]), sizes(len(b), found[:, 2], found[:, 3])


def _merged(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(times, first) if len(keys) else times


def linked_pairs(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, times): the distinct linked id pairs, A's id in the upper 32 bits, and how many links each has.

    ``a``, ``b``: ids; ``n``, ``m``: group sizes.  Links are spelled out at most
    ``AT_ONCE`` at a time; of a group with more than that, the distinct ids are
    paired and their numbers multiplied.
    """
    a = a.astype(np.int64) << 32
    b = b.astype(np.int64)
    first_a, first_b, links = np.cumsum(n) - n, np.cumsum(m) - m, n * m
    single = links == 1
    keys, times = np.unique(a[first_a[single]] | b[first_b[single]], return_counts=True)
    rest = np.flatnonzero(~single)
    if not len(rest):
        return keys, times
    held = (keys, times)
    upto = np.cumsum(links[rest])
    at = 0
    while at < len(rest):
        g = rest[at]
        if links[g] > AT_ONCE:
            one, many = np.unique(a[first_a[g]:first_a[g] + n[g]], return_counts=True)
            other, more = np.unique(b[first_b[g]:first_b[g] + m[g]], return_counts=True)
            width = max(1, AT_ONCE // len(other))
            for k in range(0, len(one), width):
                keys = (one[k:k + width, None] | other[None, :]).ravel()
                held = _merged(np.r_[held[0], keys], np.r_[held[1], (many[k:k + width, None] * more[None, :]).ravel()])
            at += 1
            continue
        end = max(at + 1, int(np.searchsorted(upto, upto[at] - links[g] + AT_ONCE, "right")))
        some = rest[at:end]
        large = np.flatnonzero(links[some] > AT_ONCE)
        some = some[:large[0]] if len(large) else some
        count, width = links[some], m[some]
        k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        width = np.repeat(width, count)
        row = k // width
        keys, times = np.unique(a[np.repeat(first_a[some], count) + row] | b[np.repeat(first_b[some], count) + k - row * width], return_counts=True)
        held = _merged(np.r_[held[0], keys], np.r_[held[1], times])
        at += len(some)
    return held


class Aligner:
    """Both encoders of a worker process, with the bytes of their tokens.

    ``memo``: parts of texts, with both encoders' ids, that are remembered in
    each of two generations.
    """

    def __init__(self, path_a: str, path_b: str, memo: int = 1 << 18):
        self.a, self.b = worker_ids(path_a, special=False), PieceIds(path_b)
        self.memo, self.held, self.old = memo, {}, {}
        self.bytes_a = token_bytes(self.a.tokenizer)
        #: With an entry for every byte and no normalizer, A's joined token bytes are those of the text.
        self.lossless = self.a.tokenizer.normalizer is None and {bytes([b]) for b in range(256)} <= set(self.bytes_a)
        self.lengths_a = np.array(list(map(len, self.bytes_a)))
        self.lengths_b = np.array(list(map(len, self.b.bytes)))
        self.width = max(len(self.bytes_a), len(self.b.bytes))
        #: An id's decimal digits before a comma, before the bar and before the semicolon, padded with zero bytes.
        self.spelled = np.array([f"{i}{mark}" for mark in ",|;" for i in range(self.width)], "S")

    def _learn(self, parts: set[str]) -> dict[str, tuple[bytes, bytes] | None]:
        """The ids of parts that aren't remembered (None: lossy), asked for all at once; uneven parts are left out."""
        known = {x: value for x in parts if (value := self.old.get(x)) is not None}
        new = [x for x in parts if x not in known and x and not x[-1].isspace()]
        for x, ids in zip(new, self.b.model.encode(new, num_threads=1) if new else ()):
            b = self.b.checked(x, ids)
            known[x] = None if b is None else (self.a.ask(x, self.a.later), b)
        if len(self.held) >= self.memo:
            self.held, self.old = {}, self.held
        self.held.update((x, value) for x, value in known.items() if value is not None and len(x) <= _LONG)
        return known

    def _ids(self, texts: list[str | None]) -> list[tuple[bytes, bytes] | None]:
        """Both encoders' ids of each text; None for a text without tokens."""
        texts = [x or "" for x in texts]
        split = [x.split(" ") if x and self.b.by_words else [] for x in texts]
        met = [list(map(self.held.get, parts)) for parts in split]
        fresh = self._learn({x for parts, values in zip(split, met) if None in values for x, value in zip(parts, values) if value is None})
        out: list[tuple[bytes, bytes] | None] = []
        for text, parts, values in zip(texts, split, met):
            try:
                if None in values:
                    values = [value or fresh[x] for x, value in zip(parts, values)]
                if not text or None in values:
                    out.append(None)
                elif parts:
                    out.append((b"".join([x for x, _ in values]), b"".join([x for _, x in values])))
                else:
                    out.append((self.a.spaced(text), self.b.spaced(text)))
            except KeyError:  # a part is empty or ends in white space, so the space after it is no boundary
                try:
                    out.append((self.a.spaced(text), self.b.spaced(text)))
                except _Lossy:
                    out.append(None)
            except _Lossy:
                out.append(None)
        return out

    def align(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(ids of A, ids of B, group sizes in A, in B) of each text; all empty for a text without tokens."""
        none = np.zeros(0, np.int64)
        for text, ids in zip(texts, self._ids(texts)):
            if ids is None:
                yield none, none, none, none
                continue
            a, b = np.frombuffer(ids[0], self.a.dtype), np.frombuffer(ids[1], self.b.dtype)
            if not self.lossless and b"".join(map(self.bytes_a.__getitem__, a.tolist())) != b" " + text.encode():
                yield none, none, none, none
            else:
                yield a, b, *group_sizes(np.cumsum(self.lengths_a[a]).tolist(), np.cumsum(self.lengths_b[b]).tolist())

    def group_text(self, a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group in order."""
        if not len(n):
            return b""
        last_a, last_b = np.cumsum(n), np.cumsum(m)
        out = np.empty(len(a) + len(b), np.int64)
        codes = a.astype(np.int64)
        codes[last_a - 1] += self.width
        out[np.arange(len(a)) + np.repeat(last_b - m, n)] = codes
        codes = b.astype(np.int64)
        codes[last_b - 1] += 2 * self.width
        out[np.arange(len(b)) + np.repeat(last_a, m)] = codes
        text = self.spelled[out].view(np.uint8)
        return text[text > 0].tobytes()[:-1]


_HELD: dict = {}


def _worker_aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _HELD:
        _HELD[path_a, path_b] = Aligner(path_a, path_b)
    return _HELD[path_a, path_b]


def _lists(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    ends = np.cumsum([0, *(len(k) for k, _ in held)]).astype(np.int32)
    keys, times = (np.concatenate([x[i] for x in held] or [np.zeros(0, np.int64)]) for i in (0, 1))
    fields = pa.StructArray.from_arrays([pa.array(keys, pa.int64()), pa.array(times, pa.int64())], ["pair", "times"])
    return pa.ListArray.from_arrays(pa.array(ends), fields)


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, <id>, n_a, n_b, n_groups, n_links, groups_sha256, links (array of (pair, times)).

    ``row`` numbers the documents.  A document with more than ``LIST`` distinct
    pairs has further rows that hold its ``row`` and links only.
    """
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = chosen.schema["id"].dataType.simpleString()

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _worker_aligner(path_a, path_b)
        row = TaskContext.get().partitionId() << 36
        names = ["row", "id", *_FIGURES, "groups_sha256", "links"]
        for batch in batches:
            texts, ids = column(batch, "text"), column(batch, "id")
            for start, end in byte_slices(texts, 1 << 20):
                out: list[tuple] = []
                held: list[tuple[np.ndarray, np.ndarray]] = []
                at: list[int] = []
                some = texts[start:end].to_pylist()
                for k, (a, b, n, m) in zip(range(start, end), aligner.align(some)):
                    keys, times = linked_pairs(a, b, n, m)
                    spelled = hashlib.sha256(aligner.group_text(a, b, n, m)).hexdigest() if len(a) else ""
                    out.append((row, len(a), len(b), len(n), int(times.sum()), spelled))
                    at.append(k)
                    held.append((keys[:LIST], times[:LIST]))
                    for more in range(LIST, len(keys), LIST):
                        out.append((row, None, None, None, None, None))
                        at.append(k)
                        held.append((keys[more:more + LIST], times[more:more + LIST]))
                    row += 1
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), ids.take(pa.array(at)), *(pa.array(c, pa.int64()) for c in columns[1:5]),
                     pa.array(columns[5], pa.string()), _lists(held)], names)

    return chosen.mapInArrow(align, f"row long, id {id_type}, " + ", ".join(f"{x} long" for x in _FIGURES)
                             + ", groups_sha256 string, links array<struct<pair:long,times:long>>").withColumnRenamed("id", id_col)


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, documents, best) from (row, pair, times): how many documents hold the pair, and whether no pair of its A id is held by more."""
    counted = links.groupBy("pair").agg(F.count("*").alias("documents"))
    most = F.max("documents").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counted.withColumn("best", F.col("documents") == most)


def cross_tokenizer_alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                              most_sent: int = MOST_SENT) -> DataFrame:
    """<id>, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of ``docs``.

    A pair's count is the number of documents that hold it linked; ``n_best``
    counts the links whose count is the highest of their A id, ``count_sum`` adds
    the counts over the links.
    """
    aligned = written(aligned_documents(docs, path_a, path_b, id_col, text_col), "aligned")
    links = aligned.select("row", F.explode("links").alias("l")).select("row", "l.pair", "l.times")
    counts = written(pair_counts(links), "pair-counts")
    sent = hot_keys(counts, "pair", "documents", most_sent, 1)
    probed = links.join(F.broadcast(sent), "pair", "left")
    known = ["row", "times", "documents", "best"]
    rest = probed.where("documents is null").select("row", "pair", "times").join(counts, "pair")
    met = probed.where("documents is not null").select(*known).unionByName(rest.select(*known))
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                  F.sum(F.col("times") * F.col("documents")).alias("count_sum"))
    figures = aligned.where("n_a is not null").drop("links")
    none = F.lit(0).cast("long")
    return figures.join(sums, "row", "left").select(id_col, *_FIGURES, F.coalesce("n_best", none).alias("n_best"),
                                                    F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
