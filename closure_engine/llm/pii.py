"""Personal data: candidate spans judged by gradient-boosted trees.

Base spans come from fixed formats (email, ip, card, phone) and always stay.
High-recall generators propose further, overlapping candidates: addresses
written with words or brackets for the signs, numbers with other separators or
without a country code, shorter card numbers.  Boosted trees score each
candidate by its format (digits, groups, separators, checksums) and its context
(the characters and words around it).  A candidate that no base span covers is
added when its calibrated probability reaches the threshold; of overlapping added ones the most likely stays.  An added span may reach beyond a
base span that it overlaps; redaction replaces both once.

Training uses the candidates of all documents with a digit or ``@`` (what others
write out in words no format labels): those that base spans cover are the
positives, the rest negatives; for the formats that the base leaves out,
findings are rewritten in their own contexts (positives) and spoilt (wrong
checksum, too large parts, dates: negatives).  Candidates are dealt by hash into
blocks of about ``BLOCK_CANDIDATES``; every split of a tree is decided by sums over
all blocks, and a corpus of one block is fitted on the driver.  Half of the
candidates fit the trees; the other half calibrate each kind's probabilities by a logistic function
of the trees' score (Platt), which makes a probability a different score for each
kind, and set the threshold of the probabilities for the precision ``PRECISION``.
(Thresholds set for each kind alone hung on single candidates: they left a fifth of
the phone numbers of a kind's few findings.)

A null text is empty.  Repeated rows give repeated rows.  Only id and text are
read, so other columns can't clash.  An empty table gives an empty table.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import Blocks, running, scored
from .boosting import BoostedTrees, NO_THRESHOLD, Part, binned, precise_threshold
from .common import sparing
from .convnet import newton_sums
from .spans import Span, byte_table, having, redacted, span_rows, text_slices

KINDS = ("email", "ip", "card", "phone")
#: Candidates of a block, on average.
BLOCK_CANDIDATES = 20_000
PRECISION = 0.995

# Fixed formats of the base spans.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# What else may be personal data: kind -> format.
_CANDIDATES = {
    "email": re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:@|[(\[{] ?at ?[)\]}]| at ) ?[A-Za-z0-9-]{1,63}"
                        r"(?: ?(?:\.|[(\[{] ?dot ?[)\]}]| dot ) ?[A-Za-z0-9-]{1,63})+"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?: ?[.,] ?|\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{3,6}(?:[ ._/-]{0,2}[0-9]{2,6}){2,6}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\+|00)?(?:[0-9]{1,3}[ .-]?)?[(]?[0-9]{2,4}[)]?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"),
}
_CLUES = {
    "email": ("mail", "contact", "write", "address"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "pay", "credit"), "phone": ("phone", "call", "tel", "fax", "mobile"),
}
_NEEDED = byte_table("0123456789@")
# The sign between name and host, without which the generator proposes no address.
_AT_WORD = re.compile(r"[(\[{] ?at ?[)\]}]| at ")
_AT = re.compile(rf"(?=@|{_AT_WORD.pattern})")
_ALNUM = _LOCAL - frozenset("._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _parts_fit(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in parts)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping base spans of each kind, by kind and start."""
    out: list[Span] = []
    end = 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            a = at = m.start()
            while a > end and text[a - 1] in _LOCAL:
                a -= 1
            if a < at:
                out.append(("email", a, end := m.end()))
    out += [("ip", *m.span()) for m in _IP.finditer(text) if _parts_fit(m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """The matches of the address format, tried only where a sign between name and host stands."""
    end = 0
    for sign in _AT.finditer(text):
        stop = sign.start()
        a = stop = stop - (stop > end and text[stop - 1] == " ")
        while a > end and stop - a < 64 and text[a - 1] in _LOCAL:
            a -= 1
        while a < stop and text[a] not in _ALNUM:
            a += 1
        m = _CANDIDATES["email"].match(text, a) if a < stop else None
        if m:
            yield m.span()
            end = m.end()


def candidates(text: str) -> list[Span]:
    out: list[Span] = [("email", a, b) for a, b in _addresses(text)]
    for kind, pattern in _CANDIDATES.items():
        if kind != "email":
            out += [(kind, *m.span()) for m in pattern.finditer(text)]
    return out


def features(text: str, span: Span) -> list[float]:
    """Format and context of a candidate."""
    kind, a, b = span
    s = text[a:b]
    digits = "".join(c for c in s if "0" <= c <= "9")
    groups = re.findall(r"[0-9]+", s)
    sizes = [len(g) for g in groups] or [0]
    before, after = text[max(0, a - 24):a], text[b:b + 2]
    last = re.split(r"[^A-Za-z]+", s)[-1]
    clue = before.lower()
    return [
        *(float(kind == k) for k in KINDS), len(s), len(digits), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
        float(luhn(digits)) if digits else -1.0, float(len(groups) == 4 and _parts_fit(groups)),
        float(bool(groups) and len(set(sizes)) == 1), float(s[:1] == "+" or s[:2] == "00"), s.count("("), s.count("@"),
        s.count("."), s.count("-"), s.count(" "), s.count(",") + s.count("/") + s.count("_"),
        sum(s.count(w) for w in ("at", "dot")), float(len(last)), float(s[:1] in "345"),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in ("+", "-", ".", "/", ":", "=")),
        float(after[:1] in ("-", "/", ":", "%", "=")), float(bool(re.match(r"[.,]?[0-9]", after))),
        float(any(w in clue for w in _CLUES[kind])), float(bool(re.fullmatch(r"(?:19|20)[0-9]{2}.*", s))),
        float(len(set(digits))),
    ]


def _luhn_number(r: random.Random, start: str, n: int) -> str:
    body = start + "".join(str(r.randrange(10)) for _ in range(n - len(start) - 1))
    return next(body + c for c in "0123456789" if luhn(body + c))


def _rewritten(kind: str, s: str, r: random.Random) -> list[tuple[str, str, float]]:
    """(kind, text, label): a finding in formats that the base leaves out, and things that only look like it."""
    d = "".join(str(r.randrange(10)) for _ in range(16))
    if kind == "email":
        name, _, host = s.partition("@")
        at, dot = r.choice([(" (at) ", " (dot) "), (" at ", " dot "), ("[at]", "[dot]"), (" @ ", ".")])
        if r.random() < 0.5:  # names without digits
            name, host = re.sub("[0-9]+", "", name).strip(".") or "me", re.sub("[0-9]+", "", host)
        host = ".".join(host.split(".")[-r.randint(2, 3):])
        return [("email", name + at + host.replace(".", dot), 1.0), ("email", f"{r.choice(['look', 'is', 'one', 'work'])} at home.Then", 0.0),
                ("email", f"{r.choice(['meet', 'open', 'stood'])} at {d[0]}.{d[1:3]}", 0.0)]
    if kind == "ip":
        p = s.split(".")
        return [("ip", r.choice(["[.]", "(.)", " . "]).join(p), 1.0), ("ip", ", ".join(str(r.randrange(1, 999)) for _ in p), 0.0),
                ("ip", ".".join(str(r.randrange(256, 999)) for _ in p), 0.0)]
    if kind == "phone":
        n = [c for c in s if c.isdigit()][-10:]
        a, b, c = "".join(n[:3]), "".join(n[3:6]), "".join(n[6:])
        return [("phone", r.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"001 {a} {b} {c}"]), 1.0),
                ("phone", f"20{d[:2]}-0{r.randrange(1, 10)}-{r.randrange(10, 29)}", 0.0), ("phone", d[:r.randrange(9, 13)], 0.0),
                ("phone", f"{d[:3]}.{d[3:6]}", 0.0)]
    short = _luhn_number(r, r.choice(["34", "37"]), 15)
    full = _luhn_number(r, "4", 16)
    bad = full[:-1] + str((int(full[-1]) + r.randrange(1, 10)) % 10)
    return [("card", f"{short[:4]} {short[4:10]} {short[10:]}", 1.0), ("card", ".".join(full[i:i + 4] for i in range(0, 16, 4)), 1.0),
            ("card", bad, 0.0), ("card", " ".join(bad[i:i + 4] for i in range(0, 16, 4)), 0.0), ("card", d[:13], 0.0)]


def _overlaps(span: Span, others: list[Span]) -> bool:
    return any(span[1] < b and a < span[2] for _, a, b in others)


def examples(text: str, seed: int = 0) -> list[tuple[list[float], float]]:
    """Labelled candidates of a text: its own, and rewritten findings in their contexts."""
    out = []
    base = base_spans(text)
    for c in candidates(text):
        hit = any(c[0] == k and a <= c[1] and c[2] <= b for k, a, b in base)
        if hit or not _overlaps(c, base):
            out.append((features(text, c), float(hit)))
    r = random.Random(f"{seed}:{len(text)}:{text[:40]}")
    for kind, a, b in base:
        for k, s, label in _rewritten(kind, text[a:b], r):
            near = text[max(0, a - 40):a]
            changed = near + s + text[b:b + 10]
            if label == 0.0 or any(c == (k, len(near), len(near) + len(s)) for c in candidates(changed)):
                out.append((features(changed, (k, len(near), len(near) + len(s))), label))
    return out


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p))


class CalibratedTrees:
    """Trees whose score becomes a probability kind by kind; a candidate's first features tell its kind."""

    def __init__(self, trees: BoostedTrees, x: np.ndarray | None = None, y: np.ndarray | None = None, lines: np.ndarray | None = None):
        """``x``, ``y``: labelled candidates that the trees weren't fitted on; or ``lines``: slope and shift by kind."""
        self.trees, self.lines = trees, lines
        if lines is None:
            raw, kind = logit(trees.score(x)), x[:, :len(KINDS)]
            self.lines = _platt_lines(lambda values: np.array([values(k, raw[kind[:, k] == 1], y[kind[:, k] == 1]) for k in range(len(KINDS))]))

    def probability(self, kind: np.ndarray, raw: np.ndarray) -> np.ndarray:
        line = self.lines[kind]
        return 1 / (1 + np.exp(-(line[:, 0] * raw + line[:, 1])))

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.probability(x[:, :len(KINDS)].argmax(1), logit(self.trees.score(x)))


def _platt(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of one kind."""
    return tuple(_platt_lines(lambda values: values(0, raw, y)[None], 1)[0].tolist())


def _platt_lines(sums: Callable[[Callable], np.ndarray], kinds: int = len(KINDS)) -> np.ndarray:
    """Slope and shift, by kind, of the logistic function that fits the labels best, with Platt's targets; the score as it is where a class lacks.

    ``sums(values)``: a row a kind, ``values(kind, raw, y)`` added up over all candidates.
    """
    counts = sums(lambda k, raw, y: np.array([y.sum(), (1 - y).sum()]))
    lines = np.tile([1.0, 0.0], (kinds, 1))
    open_ = (counts > 0).all(1)
    for _ in range(50):
        if not open_.any():
            break

        def newton(k: int, raw: np.ndarray, y: np.ndarray) -> np.ndarray:
            good, bad = counts[k]
            return newton_sums(raw, np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2)), *lines[k])

        for k, (ga, gb, haa, hab, hbb) in enumerate(sums(newton)):
            if open_[k]:
                step = np.linalg.solve(np.array([[haa, hab], [hab, hbb]]) + 1e-6 * np.eye(2), np.array([ga, gb]))
                lines[k] -= np.clip(step, -2, 2)
                open_[k] = np.abs(step).max() >= 1e-9
    lines[lines[:, 0] <= 0] = 1.0, 0.0  # never turn the order round
    return lines


def train(docs: DataFrame, id_col: str, text_col: str, seed: int = 9) -> tuple[CalibratedTrees, float] | None:
    """The calibrated trees and the least probability to add; None where the table holds nothing to learn from."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches, text_col):
            held = np.flatnonzero(having(texts, _NEEDED))
            got = [x for i in held.tolist() for x in examples(texts[i].as_py() or "", seed)]
            if got:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in got], pa.list_(pa.float64())), pa.array([y for _, y in got])], ["x", "y"])

    rows = docs.select(text_col).mapInArrow(sparing(gather), "x array<double>, y double")
    blocks = Blocks(rows, BLOCK_CANDIDATES, _packed, ("x", "y"), "pii")
    if not blocks.n or not blocks.both:
        return None
    if blocks.count == 1:
        (x, y), held = _halves(*blocks.only(), seed)
        model = CalibratedTrees(BoostedTrees().fit(x, y), *held)
        return model, max(0.5, precise_threshold(model.score(held[0]), held[1], PRECISION))
    trees = BoostedTrees()
    edges = _edges(blocks, trees.shares(), seed)

    def cut(x: bytes, y: bytes) -> dict[str, bytes]:
        own, labels = _halves(x, y, seed)[0]
        return {"bins": binned(own, edges).tobytes(), "y": labels.tobytes()}

    parts = blocks.map(cut, ("bins", "y"), "pii-bins")
    part = lambda b, y: Part(np.frombuffer(b, np.uint8).reshape(len(edges), -1), np.frombuffer(y))
    n, good = parts.summed(lambda _, b, y: np.array([len(y) // 8, np.frombuffer(y).sum()]))
    trees.grow(edges, good / n, lambda grown: parts.summed(lambda _, *b: part(*b).sums(grown)))

    def answers(x: bytes, y: bytes) -> dict[str, bytes]:
        own, labels = _halves(x, y, seed)[1]
        return {"kind": own[:, :len(KINDS)].argmax(1).astype(np.int8).tobytes(), "raw": logit(trees.score(own)).tobytes(), "y": labels.tobytes()}

    held = blocks.map(answers, ("kind", "raw", "y"), "pii-answers")

    def sums(values) -> np.ndarray:
        """``values(k, raw, y)`` of each kind, added up over the blocks."""
        def of(_: int, kind: bytes, raw: bytes, y: bytes) -> np.ndarray:
            at = np.frombuffer(kind, np.int8)
            return np.concatenate([values(k, np.frombuffer(raw)[at == k], np.frombuffer(y)[at == k]) for k in range(len(KINDS))])

        return held.summed(of).reshape(len(KINDS), -1)

    model = CalibratedTrees(trees, lines=_platt_lines(sums))

    def probabilities(_: int, kind: bytes, raw: bytes, y: bytes) -> tuple[np.ndarray, np.ndarray]:
        return model.probability(np.frombuffer(kind, np.int8), np.frombuffer(raw)), np.frombuffer(y)

    upto = running(scored(held, probabilities), "pii-scores")
    least = upto.where(F.col("good") / F.col("n") >= PRECISION).agg(F.min("score")).first()[0]
    return model, max(0.5, NO_THRESHOLD if least is None else least)


def _packed(t: pa.Table) -> dict[str, bytes]:
    """Candidates as buffers: features and labels."""
    return {"x": t.column("x").combine_chunks().flatten().to_numpy().tobytes(), "y": t.column("y").to_numpy().tobytes()}


def _halves(x: bytes, y: bytes, seed: int) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """The candidates of a block that fit the trees, and those that calibrate them: (features, labels) each."""
    labels = np.frombuffer(y)
    order = np.random.default_rng(seed).permutation(len(labels))
    rows, labels, half = np.frombuffer(x).reshape(len(labels), -1)[order], labels[order], len(labels) // 2
    return (rows[:half], labels[:half]), (rows[half:], labels[half:])


def _edges(blocks: Blocks, shares: np.ndarray, seed: int) -> list[np.ndarray]:
    """The exact quantiles of every feature, from the counts of its different values (lengths and counts of characters)."""

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                for f, c in enumerate(_halves(batch.column(1)[i].as_py(), batch.column(2)[i].as_py(), seed)[0][0].T):
                    found, n = np.unique(c, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), f, np.int32)), pa.array(found), pa.array(n)], ["feature", "value", "n"])

    held = blocks.rows.mapInArrow(values, "feature int, value double, n long").groupBy("feature", "value").agg(F.sum("n").alias("n"))
    cuts = held.groupBy("feature").agg(F.percentile("value", F.array(*map(F.lit, shares.tolist())), F.col("n")).alias("cuts")).collect()
    return [np.unique(r["cuts"]) for r in sorted(cuts)]


def _covered(span: Span, others: list[Span]) -> bool:
    return any(a <= span[1] and span[2] <= b for _, a, b in others)


def finder(model: tuple | None):
    """find(texts, array) -> (base, all) spans of each text; ``model``: what scores candidates, and the threshold."""

    def find(texts: list[str | None], array: pa.Array) -> list[tuple[list[Span], list[Span]]]:
        out: list = [([], [])] * len(texts)
        open_: list[tuple[int, Span]] = []
        rows: list[list[float]] = []
        worded = [t is not None and _AT_WORD.search(t) is not None for t in texts]
        for i in np.flatnonzero(having(array, _NEEDED) | np.array(worded, bool)).tolist():
            base = base_spans(texts[i])
            out[i] = (base, base)
            if model:
                for c in candidates(texts[i]):
                    if not _covered(c, base):
                        open_.append((i, c))
                        rows.append(features(texts[i], c))
        if rows:
            scores = model[0].score(np.array(rows))
            added: dict[int, list[Span]] = {}
            for j in np.argsort(-scores, kind="stable"):
                if scores[j] < model[1]:
                    break
                i, c = open_[j]
                if not _overlaps(c, added.setdefault(i, [])):
                    added[i].append(c)
            for i, more in added.items():
                out[i] = (out[i][0], sorted(out[i][0] + more, key=lambda s: (KINDS.index(s[0]), s[1])))
        return out

    return find


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row of ``docs``."""
    return span_rows(docs, id_col, text_col, KINDS, finder(train(docs, id_col, text_col)))


def redact_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with personal data replaced by its kind."""
    return redacted(docs, text_col, finder(train(docs, id_col, text_col)))
