"""Token ids of whole texts by a byte-level BPE of the tokenizers library, word by word.

A space that follows a character which is no white space ends a piece of a
byte-level pre-tokenizer (see :mod:`token_counts`), so a text's ids are those of
its words, each with the space before it, one after the other.  Words repeat:
what the library answered is remembered in two generations of bounded size, and
a word that has not been used for a whole generation is forgotten.  Texts with
white space before a space are cut at the safe boundaries only.

Ids are little-endian numbers of 16 bits where the vocabulary allows it, else 32.
"""

from __future__ import annotations

import gc
import struct

import numpy as np

from .token_counts import _LETTERS, _PLAIN, _SAFE, _shown, load_tokenizer

#: Words longer than this are encoded but not remembered.
_LONG = 64


class _Uneven(Exception):
    """A part is empty or ends in white space: the space after it is no boundary."""


class _Words(dict):
    """Part of a text -> its ids as bytes; ``space`` is what stands before the part in the text."""

    def __init__(self, owner: WordIds, space: str):
        super().__init__()
        self.owner, self.space, self.shown, self.old = owner, space, _shown(space), {}

    def __missing__(self, part: str) -> bytes:
        value = self.old.get(part)
        if value is None:
            if not part or part[-1].isspace():
                raise _Uneven
            value = self.owner.ask(part, self)
            if len(part) > _LONG:
                return value
        self.keep(part, value)
        return value

    def keep(self, part: str, value: bytes) -> None:
        if len(self) >= self.owner.memo:
            self.old = dict(self)
            self.clear()
        self[part] = value


class WordIds:
    """``encode(text)``: the ids of a whole text as bytes of ``dtype``.

    ``special``: special strings inside texts become special tokens, the
    library's default; otherwise they are ordinary text.
    """

    def __init__(self, path: str, special: bool = True, memo: int = 1 << 19):
        self.tokenizer, self.memo = load_tokenizer(path), memo
        self.tokenizer.encode_special_tokens = not special
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4")
        added = self.tokenizer.get_added_tokens_decoder().values()
        #: Words of plain letters are one piece of a byte-level pre-tokenizer: the library's BPE model takes them as they are.
        self.plain = (self.tokenizer.normalizer is None and "ByteLevel(add_prefix_space=False" in str(self.tokenizer.pre_tokenizer)[:40]
                      and not any(_LETTERS(x.content) or x.content == "" for x in added))
        self.first, self.later = _Words(self, ""), _Words(self, " ")
        self.marks: dict[str, bytes] = {}

        self.tokenize, self.code = self.tokenizer.model.tokenize, "H" if self.dtype.itemsize == 2 else "I"
        self.packers = [struct.Struct(f"<{n}{self.code}").pack for n in range(_LONG)]

    def _pack(self, ids: list[int]) -> bytes:
        n = len(ids)
        return self.packers[n](*ids) if n < _LONG else np.array(ids, self.dtype).tobytes()

    def _model(self, shown: str) -> bytes:
        return self._pack([t.id for t in self.tokenize(shown)])

    def ask(self, part: str, words: _Words) -> bytes:
        """The ids of a part that is not remembered."""
        if self.plain:
            value = self._word(part, words)
            if value is None and "\n" in part:  # a line break between words is a piece of its own
                before, _, after = part.partition("\n")
                one = self._word(before, words)
                two = None if one is None else self._word(after, self.first)
                value = None if two is None else one + self._mark("\n") + two
            if value is not None:
                return value
        return self.whole(words.space + part)

    def whole(self, text: str) -> bytes:
        """By the library's whole pipeline."""
        return self._pack(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def _word(self, part: str, words: _Words) -> bytes | None:
        """The ids of a word and the marks after it; None if ``part`` is something else."""
        m = _PLAIN(part)
        if not m:
            return None
        word, marks = m.groups()
        value = words.get(word)
        if value is None:
            value = words.old.get(word)
            if value is None:
                value = self._model(words.shown + (word if word.isascii() else _shown(word)))
            if marks and len(word) <= _LONG:
                words.keep(word, value)
        return value + self._mark(marks) if marks else value

    def _mark(self, marks: str) -> bytes:
        value = self.marks.get(marks)
        if value is None:
            value = self._model(_shown(marks))
            if len(self.marks) < 4096 and len(marks) <= _LONG:
                self.marks[marks] = value
        return value

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        start, *parts = text.split(" ")
        try:
            return self.first[start] + b"".join(map(self.later.__getitem__, parts))
        except _Uneven:
            start, *parts = _SAFE.split(text)
            return self._safe(start, self.first) + b"".join(self._safe(x[1:], self.later) for x in parts)

    def _safe(self, part: str, words: _Words) -> bytes:
        if not part or part[-1].isspace():
            return self.whole(words.space + part)
        return words[part]

    def spaced(self, text: str) -> bytes:
        """The ids of the text with a space before it."""
        try:
            return b"".join(map(self.later.__getitem__, text.split(" ")))
        except _Uneven:
            start, *parts = _SAFE.split(" " + text)
            return self._safe(start, self.first) + b"".join(self._safe(x[1:], self.later) for x in parts)


_HELD: dict = {}


def worker_ids(path: str, special: bool = True) -> WordIds:
    """The worker process's encoder, made once and kept between its tasks."""
    if (path, special) not in _HELD:
        _HELD[path, special] = WordIds(path, special)
        # the library's answers are many small objects without cycles; looking for cycles among them took a seventh of the time
        gc.set_threshold(100_000, 50, 50)
    return _HELD[path, special]
