"""Secret scans: a character convolutional network over candidates and their contexts.

Base spans come from fixed formats (assignments to names like password or
token, access keys, long hexadecimal strings) and always stay.  Candidates are
all runs of 16 key characters or more with two kinds of small letters, capitals
and digits, however long, that no base span covers; a run that a base span only
touches is a candidate as a whole.
The network reads the characters before, in and after every one of them, a long
one in windows that overlap by half, and adds those of which a window reaches its
threshold, as kind ``other``.  Added spans may overlap base spans; redaction
replaces what they cover together once.

Training uses the findings of all documents.  Positives: base findings, and the
same places with secrets of formats that the base leaves out.  Negatives:
candidates that look like paths, versions, dates, numbers or words, put into
contexts of the corpus, and the corpus's own candidates outside of all base
spans, but for those that fit a format of the made secrets, which may be true
ones and stay unlabelled.  Findings are dealt by hash into blocks of about
``BLOCK_FINDINGS``.  Half of a block's findings fit the network: in every epoch
each block takes its steps from the same network, and the networks are averaged
(local gradient descent).  The other halves calibrate its probabilities and set
the threshold: the highest one that still finds ``RECALL`` of the positives,
where made positives that are no candidates count as missed.  A corpus of one
block is fitted on the driver.

A null text is empty.  Repeated rows give repeated rows.  Only id and text are
read, so other columns can't clash.  An empty table gives an empty table.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Blocks, running, scored
from .boosting import recall_threshold
from .common import sparing, string_buffers, written
from .convnet import CharNet, codes, newton_sums
from .spans import Span, byte_table, having, redacted, span_rows, text_slices

KINDS = ("assign", "access", "hex")
_ORDER = {k: i for i, k in enumerate((*KINDS, "other"))}
#: Findings of a block, on average.
BLOCK_FINDINGS = 8_000
RECALL = 0.98
#: Characters that the network reads: before, in, and after a candidate.
BEFORE, INSIDE, AFTER = 24, 48, 8
#: Windows of an example that the network is fitted on, and windows that are scored at once.
LEARNT, SCORED = 2, 4096

# Fixed formats of the base spans.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")

_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{16,}(?![A-Za-z0-9+/_=.-])")
_SMALL, _CAPITAL, _DIGIT = re.compile("[a-z]"), re.compile("[A-Z]"), re.compile("[0-9]")
# Beginnings and bodies of the made secrets' formats.
_BEGINS = re.compile(r"(ghp_|sk-|pk_live_|xoxb-|glpat-|eyJ|AIza)")
_SOLID = re.compile(r"[A-Za-z0-9+/]{24,}={0,2}")
_SIGNS = byte_table(":=")
_NOT_KEY = ~byte_table(string.ascii_letters + string.digits + "+/_=.-")


def _key_runs(texts: pa.Array) -> np.ndarray:
    """Which texts hold 16 key characters in a row."""
    data, ends = string_buffers(texts)
    stops = np.concatenate(([-1], np.flatnonzero(_NOT_KEY[data]), [len(data)]))
    long = np.flatnonzero(np.diff(stops) > 16)
    out = np.zeros(len(ends) - 1, bool)
    for i in long:  # a run may touch several texts; which of them hold 16 is settled by the pattern
        a = np.searchsorted(ends, stops[i] + 1, "right") - 1
        out[max(a, 0):np.searchsorted(ends, stops[i + 1], "left")] = True
    return out


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping base spans of each kind, by start and kind."""
    out: list[Span] = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(name in low for name in _NAMES):
            out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(out, key=_by_start)


def _by_start(s: Span) -> tuple:
    return s[1], _ORDER[s[0]], s[2]


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Runs of key characters with two kinds of small letters, capitals and digits that no base span covers."""
    out = []
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        if bool(_SMALL.search(m[0])) + bool(_CAPITAL.search(m[0])) + bool(_DIGIT.search(m[0])) >= 2 and not any(x <= a and b <= y for _, x, y in base):
            out.append(("other", a, b))
    return out


def like_secret(s: str) -> bool:
    """Whether a run may be a secret of a made format: a known beginning, or 24 characters or more with capitals and digits and no words' separators."""
    return bool(_BEGINS.match(s)) or bool(_SOLID.fullmatch(s) and _DIGIT.search(s) and _CAPITAL.search(s))


def window(text: str, a: int, b: int, at: int) -> list[int]:
    """The codes of a candidate's characters from ``at`` on, between those before and after the candidate."""
    s = text[at:min(b, at + INSIDE)]
    before, after = text[max(0, a - BEFORE):a], text[b:b + AFTER]
    return ([0] * (BEFORE - len(before)) + codes(before) + codes(s) + [0] * (INSIDE - len(s))
            + codes(after) + [0] * (AFTER - len(after)))


def places(a: int, b: int) -> list[int]:
    """Where the windows begin that together cover a candidate; neighbours share half of their characters."""
    return [*range(a, b - INSIDE, INSIDE // 2), max(a, b - INSIDE)]


def _learnt(text: str, a: int, b: int) -> list[list[int]]:
    """The windows of an example; of a very long one, some from all over it."""
    at = places(a, b)
    return [window(text, a, b, i) for i in (at if len(at) <= LEARNT else [at[j * (len(at) - 1) // (LEARNT - 1)] for j in range(LEARNT)])]


def _made(r: random.Random) -> tuple[str, float]:
    """A secret of a format that the base leaves out (1), or something that only looks like one (0)."""
    key = lambda n, also="": "".join(r.choice(string.ascii_letters + string.digits + also) for _ in range(n))
    word = lambda: "".join(r.choice("aeiou") if i % 2 else r.choice("bcdfghlmnprst") for i in range(r.randint(3, 8)))
    number = lambda n: "".join(r.choice(string.digits) for _ in range(n))
    secret = [
        lambda: r.choice(["ghp_", "sk-", "pk_live_", "xoxb-", "glpat-"]) + key(r.randint(24, 40)), lambda: key(r.randint(24, 64)),
        lambda: key(r.randint(30, 44), "+/") + "=" * r.randint(0, 2), lambda: "eyJ" + key(20) + "." + key(40) + "." + key(30, "_-"),
        lambda: "AIza" + key(35, "_-"), lambda: key(r.randint(32, 64)).upper(),
    ]
    harmless = [
        lambda: "/".join(word() for _ in range(r.randint(3, 6))) + f"/{number(r.randint(2, 4))}.{r.choice(['html', 'txt', 'png'])}",
        lambda: f"{word()}-{word()}-{word()}-{number(r.randint(1, 4))}", lambda: f"20{number(2)}-{number(2)}-{number(2)}T{number(2)}.{number(2)}.{number(2)}Z",
        lambda: f"{word()}_{word()}_{word()}_v{number(1)}.{number(1)}.{number(2)}", lambda: f"www.{word()}{word()}{number(2)}.example.com",
        lambda: word() + word() + word() + word() + number(r.randint(2, 4)), lambda: f"{word()}.{word()}.{word()}{number(2)}.{word()}",
        lambda: f"{number(4)}-{number(4)}-{number(4)}-{number(4)}-{word()[:2]}x", lambda: f"{word().title()}{word().title()}{word().title()}{number(2)}",
    ]
    good = r.random() < 0.5
    return r.choice(secret if good else harmless)(), float(good)


def examples(text: str, seed: int = 0) -> list[tuple[list[list[int]], float, bool]]:
    """Labelled findings of a text, as windows: its own, and made ones in its contexts; and whether the scan proposes them."""
    base = base_spans(text)
    out = [(_learnt(text, a, b), 1.0, True) for k, a, b in base if k != "hex" or re.search("[a-f]", text[a:b])]
    out += [(_learnt(text, a, b), 0.0, True) for _, a, b in candidates(text, base)
            if not like_secret(text[a:b]) and not any(a < y and x < b for _, x, y in base)]
    r = random.Random(f"{seed}:{len(text)}:{text[:40]}")
    near_to = [(a, b) for _, a, b in base] + [(a, a) for a in (text.find(" ", r.randrange(len(text))) + 1 for _ in range(2)) if a]
    for a, b in near_to:
        s, label = _made(r)
        near = text[max(0, a - 40):a]
        if label and r.random() < 0.3:
            near += r.choice(["key: ", "auth = ", "bearer ", "credential "])
        changed = near + s + (" " if a == b else "") + text[b:b + 20]  # between words, or in place of a finding
        x, y = len(near), len(near) + len(s)
        found = base_spans(changed)
        proposed = any(p <= x and y <= q for _, p, q in found + candidates(changed, found))
        out.append((_learnt(changed, x, y), label, proposed))
    return out


def train(docs: DataFrame, id_col: str, text_col: str, seed: int = 7) -> tuple[CharNet, float] | None:
    """The calibrated network and its threshold; None where the table holds nothing to learn from."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches, text_col):
            got = [e for x in texts.to_pylist() if x for e in examples(x, seed)]
            if got:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _, _ in got], pa.list_(pa.list_(pa.int8()))), pa.array([y for _, y, _ in got]),
                                                  pa.array([p for _, _, p in got])], ["x", "y", "proposed"])

    rows = docs.select(text_col).mapInArrow(sparing(gather), "x array<array<tinyint>>, y double, proposed boolean")
    blocks = Blocks(rows, BLOCK_FINDINGS, _packed, ("x", "sizes", "y", "proposed"), "secrets")
    if blocks.n < 8 or not blocks.both:
        return None
    net = CharNet((BEFORE, INSIDE, AFTER))
    if blocks.count == 1:
        fit, held = _halves(*blocks.only())
        net.fit(*fit.windows()).calibrate(*held.windows())
        return net, threshold(held.best(net.score(held.x)), held.y, held.proposed)
    net.fit_blocks(blocks.summed, lambda *b: _halves(*b)[0].windows())

    def measured(*buffers: bytes) -> dict[str, bytes]:
        held = _halves(*buffers)[1]
        z = net.logits(held.x)
        return {"z": z.tobytes(), "of": held.windows()[1].tobytes(), "best": held.best(z).tobytes(), "y": held.y.tobytes(), "proposed": held.proposed.tobytes()}

    answers = blocks.map(measured, ("z", "of", "best", "y", "proposed"), "secrets-answers")
    net.calibrate_by(lambda a, b: answers.summed(lambda _, z, y, *more: newton_sums(np.frombuffer(z), np.frombuffer(y), a, b)))

    def positives(_: int, z: bytes, of: bytes, best: bytes, y: bytes, proposed: bytes) -> tuple[np.ndarray, np.ndarray]:
        found = (np.frombuffer(y) > 0) & np.frombuffer(proposed, bool)
        return np.frombuffer(best)[found], np.ones(found.sum())

    n = int(answers.summed(lambda _, z, of, best, y, *more: np.array([np.frombuffer(y).sum()]))[0])
    held = written(running(scored(answers, positives), "secrets-scores"), "secrets-running")
    # as many positives as have to be found, those not proposed being missed; all proposed ones where they are too few
    enough, least = held.agg(F.max(F.when(F.col("good") >= n - int(np.floor((1 - RECALL) * n)), F.col("score"))), F.min("score")).first()
    best = enough if enough is not None else least
    return net, 1.0 if best is None else float(net.probability(np.array([best]))[0])


class _Half:
    """Findings: windows of all of them, how many each has, labels, whether the scan proposes them."""

    def __init__(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray, proposed: np.ndarray):
        self.x, self.sizes, self.y, self.proposed = x, sizes, y, proposed

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        return self.x, np.repeat(self.y, self.sizes)

    def best(self, score: np.ndarray) -> np.ndarray:
        """The highest score of each finding's windows."""
        return np.maximum.reduceat(score, np.cumsum(self.sizes) - self.sizes) if len(self.sizes) else np.zeros(0)


def _packed(t: pa.Table) -> dict[str, bytes]:
    """Findings as buffers: codes of the windows, numbers of windows, labels, proposed or not."""
    x = t.column("x").combine_chunks()
    y, proposed = (t.column(c).to_numpy(zero_copy_only=False) for c in ("y", "proposed"))
    return {"x": x.flatten().flatten().to_numpy().astype(np.int8).tobytes(), "sizes": x.value_lengths().to_numpy().astype("<i4").tobytes(),
            "y": y.astype("<f8").tobytes(), "proposed": proposed.astype(bool).tobytes()}


def _halves(x: bytes, sizes: bytes, y: bytes, proposed: bytes) -> tuple[_Half, _Half]:
    """The findings of a block that fit the network, and those that calibrate it."""
    codes_, n = np.frombuffer(x, np.int8).reshape(-1, BEFORE + INSIDE + AFTER), np.frombuffer(sizes, "<i4")
    labels, found, half = np.frombuffer(y), np.frombuffer(proposed, bool), len(n) // 2
    cut = n[:half].sum()
    return _Half(codes_[:cut], n[:half], labels[:half], found[:half]), _Half(codes_[cut:], n[half:], labels[half:], found[half:])


def threshold(best: np.ndarray, y: np.ndarray, proposed: np.ndarray) -> float:
    """The highest one that finds RECALL of the positives, those not proposed being missed; the lowest of the proposed ones' scores if none does."""
    held = best[proposed & (y > 0)]
    return max(recall_threshold(np.where(proposed, best, -1.0), y, RECALL), float(held.min(initial=1.0)))


def finder(model: tuple[CharNet, float] | None):
    """find(texts, array) -> (base, all) spans of each text."""

    def find(texts: list[str | None], array: pa.Array) -> list[tuple[list[Span], list[Span]]]:
        out: list = [([], [])] * len(texts)
        open_: list[tuple[int, Span]] = []
        rows: list[list[int]] = []
        of: list[int] = []
        over: set[int] = set()  # candidates with a window that reaches the threshold

        def score() -> None:
            if rows:
                hit = np.flatnonzero(model[0].score(np.array(rows)) >= model[1])
                over.update(of[j] for j in hit.tolist())
                rows.clear()
                of.clear()

        runs = _key_runs(array)
        for i in np.flatnonzero(runs | having(array, _SIGNS)).tolist():
            text = texts[i]
            base = base_spans(text)
            out[i] = (base, base)
            if model and runs[i]:
                for c in candidates(text, base):
                    for at in places(c[1], c[2]):
                        rows.append(window(text, c[1], c[2], at))
                        of.append(len(open_))
                        if len(rows) == SCORED:
                            score()
                    open_.append((i, c))
        for i in [i for i, x in enumerate(texts) if x and "AKIA" in x and not out[i][0]]:
            base = base_spans(texts[i])
            out[i] = (base, base)
        score()
        added: dict[int, list[Span]] = {}
        for j in sorted(over):
            added.setdefault(open_[j][0], []).append(open_[j][1])
        for i, more in added.items():
            out[i] = (out[i][0], sorted(out[i][0] + more, key=_by_start))
        return out

    return find


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_assign, n_access, n_hex, base_sha256, spans for every row of ``docs``."""
    return span_rows(docs, id_col, text_col, KINDS, finder(train(docs, id_col, text_col)))


def redact_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with every secret replaced by its kind."""
    return redacted(docs, text_col, finder(train(docs, id_col, text_col)))
