"""Token counts: batched encoding inside Arrow functions that return lengths only.

A task receives Arrow batches, deals their rows into groups of about equal
bytes and splits every text at safe boundaries before encoding.  A boundary is
safe before a space that follows a character which is no white space: a
byte-level BPE pre-tokenizer always ends a piece there, because its pieces are
an optional space with non-spaces, or white space only.  Encoding the parts
one by one therefore gives exactly the tokens of the whole text, however long
it is.  Parts repeat a lot (they are mostly one word), so a bounded memo
remembers what the tokenizer library answered; each group asks the library
once, in one batch, for the parts that are new.

Results: a null text counts as empty (0 tokens, 0 bytes).  Repeated rows give
repeated rows.  Columns other than the id and the text are not read, so their
names can't clash.  An empty table gives an empty table.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import byte_slices, column, string_buffers

#: Letters of Latin scripts, which no part of a pre-tokenizer's pattern divides, then ASCII marks other than the
#: apostrophe, which are a piece of their own.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_LETTERS = re.compile(f"[{_LATIN}]+").fullmatch
_PLAIN = re.compile(f"([{_LATIN}]+)([!-&(-/:-@\\[-`{{-~]*)").fullmatch
#: Byte-level tokenizers write each byte as a visible character: visible Latin-1 as it is, the others from U+0100 on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_CHARS = {b: 0x100 + i for i, b in enumerate(x for x in range(0x100) if x not in _VISIBLE)}
_SAFE = re.compile(r"(?<=\S)(?= )")
#: Parts longer than this are encoded but not remembered.
_LONG = 96


def load_tokenizer(path: str):
    """A tokenizers.Tokenizer that uses one thread and neither truncates nor pads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _shown(text: str) -> str:
    """A text's bytes in the visible characters of byte-level tokenizers."""
    return text.encode().decode("latin-1").translate(_BYTE_CHARS)


class PartEncoder:
    """Encodes texts part by part with a memo of at most ``memo`` parts.

    ``of_encoding`` and ``of_tokens`` make what is remembered of a part from the
    library's answer, ``total`` and ``+`` add what is remembered of a text's parts.
    """

    def __init__(self, path: str, of_encoding: Callable, of_tokens: Callable, total: Callable, memo: int = 1 << 20):
        self.tokenizer, self.memo = load_tokenizer(path), memo
        self.of_encoding, self.of_tokens, self.total = of_encoding, of_tokens, total
        self.marks: dict = {}
        #: Words of plain letters are one piece of a byte-level pre-tokenizer: the library's BPE model takes them as they are.
        self.plain = (self.tokenizer.normalizer is None and "ByteLevel(add_prefix_space=False" in str(self.tokenizer.pre_tokenizer)[:40]
                      and not any(_LETTERS(x.content) or x.content == "" for x in self.tokenizer.get_added_tokens_decoder().values()))
        self.first: dict = {}  # parts without the space before them
        self.later: dict = {}  # parts as they stand after a space, which is left out of the key

    def _learn(self, known: dict, new: set, space: str) -> list:
        """Ask for what is new; returns the parts to be forgotten after use."""
        if len(known) + len(new) > self.memo:  # the parts met first are the most frequent: half of the room is theirs
            for x in list(itertools.islice(known, self.memo // 2, None)):
                if x not in new:
                    del known[x]
        rest = list(new)
        if self.plain:
            rest, shown = [], _shown(space)
            for x in new:
                value = self._plain(x, known, shown)
                if value is None and "\n" in x:  # a line break between words is a piece of its own
                    before, _, after = x.partition("\n")
                    one, two = self._plain(before, known, shown), self._plain(after, self.first, "")
                    value = None if one is None or two is None else one + self._marks("\n") + two
                if value is None:
                    rest.append(x)
                else:
                    known[x] = value
        if rest:
            found = self.tokenizer.encode_batch_fast([space + x for x in rest], add_special_tokens=False)
            known.update(zip(rest, map(self.of_encoding, found)))
        return [x for x in new if len(x) > _LONG or not x or x[-1].isspace()]

    def _plain(self, x: str, known: dict, shown: str):
        """What is remembered of a word and the marks after it; None if ``x`` is something else."""
        m = _PLAIN(x)
        if not m:
            return None
        word, marks = m.groups()
        value = known.get(word)
        if value is None:
            value = self.of_tokens(self.tokenizer.model.tokenize(shown + (word if word.isascii() else _shown(word))))
        return value + self._marks(marks) if marks else value

    def _marks(self, marks: str):
        value = self.marks.get(marks)
        if value is None:
            value = self.of_tokens(self.tokenizer.model.tokenize(_shown(marks)))
            if len(self.marks) < 4096 and len(marks) <= _LONG:
                self.marks[marks] = value
        return value

    def encode(self, texts: list[str]) -> list:
        """The total of each text."""
        start, split, late = [], [], set()
        for text in texts:
            parts = text.split(" ")
            start.append(parts[0])
            del parts[0]
            split.append(parts)
            late.update(parts)
        # What the memos hold may be dropped to make room, so it is settled now what this group needs.
        start_new, late_new = set(start).difference(self.first), late.difference(self.later)
        # A space that follows white space is no boundary.  Parts that show one (empty or ending in white
        # space) are never remembered, so only parts that the memo lacks have to be looked at.
        odd = {x for x in start_new if x[-1:].isspace()}
        odd_late = {x for x in late_new if not x or x[-1].isspace()}
        if odd or odd_late:
            for i, parts in enumerate(split):
                if start[i] in odd or not odd_late.isdisjoint(parts):
                    start[i], *parts = _SAFE.split(texts[i])
                    split[i] = [x[1:] for x in parts]
                    start_new.add(start[i])
                    late.update(split[i])
                    late_new.update(split[i])
            start_new.difference_update(self.first)
            late_new.difference_update(self.later)
        if len(self.later) + len(late_new) > self.memo:
            late_new = late.union(late_new)
        if len(self.first) + len(start_new) > self.memo:
            start_new = start_new.union(start)
        forget = (self._learn(self.first, start_new, ""), self._learn(self.later, late_new, " "))
        first, later, total = self.first, self.later, self.total
        out = [first[x] + total(map(later.__getitem__, parts)) for x, parts in zip(start, split)]
        for known, keys in zip((first, later), forget):
            for x in keys:
                known.pop(x, None)
        return out


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def length_encoder(path: str) -> PartEncoder:
    return PartEncoder(path, len, len, sum)


def id_encoder(path: str) -> PartEncoder:
    """Totals are bytes: the ids as little-endian unsigned 32-bit numbers."""
    return PartEncoder(path, lambda x: _packed(x.ids), lambda x: _packed([t.id for t in x]), b"".join, memo=1 << 19)


_ENCODERS: dict = {}


def worker_encoder(kind: Callable, path: str) -> PartEncoder:
    """The worker process's encoder of a kind, made once and kept between its tasks."""
    if (kind, path) not in _ENCODERS:
        _ENCODERS[kind, path] = kind(path)
    return _ENCODERS[kind, path]


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512, batch_bytes: int = 1 << 20) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit (n_tokens > limit) for every row of ``docs``.

    ``tokenizer``: path of a byte-level BPE file of the tokenizers library.
    """
    chosen = docs.select(id_col, text_col)
    schema = f"`{id_col}` {chosen.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(length_encoder, tokenizer)
        for batch in batches:
            texts = column(batch, text_col)
            counts: list[int] = []
            for a, b in byte_slices(texts, batch_bytes):
                counts += encoder.encode([x or "" for x in texts[a:b].to_pylist()])
            tokens = np.array(counts, np.int64)
            yield pa.RecordBatch.from_arrays(
                [column(batch, id_col), pa.array(np.diff(string_buffers(texts)[1])), pa.array(tokens), pa.array(tokens > limit)],
                [id_col, "n_bytes", "n_tokens", "over_limit"])

    return chosen.mapInArrow(count, schema)
