"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models of the characters (UTF-8 bytes) inside words
are counted over all labelled training texts, one for toxic and one for
ordinary texts: full counts at the highest order, continuation counts below,
and both classes back off to one shared distribution in the end, so that
expressions too rare for one class alone get a sound probability.  The contexts
of a word start at its first letter, so spelling variants share what they have
in common.

A text's word evidence is the difference of the word's log-likelihoods under
the two models.  Two length-normalised sums describe a text: the mean
difference of its words, and the mean of what exceeds ``MARGIN`` (single words
differ a little by chance, long texts have many).  A logistic function turns
them into a score.  It is fitted on at most about ``MAX_FITTED`` of the labelled
training rows, all if they are fewer, with evidence from models of the other
half of the training rows, as a model is too sure of the texts it was counted
on.  Where these rows lack a class, ``UNFITTED`` stands in.

On Spark: the labels are joined to the texts by id (a shuffled join), each task
adds up the character n-grams of its texts, and the sums meet in one
aggregation.  Continuation counts, backoffs and probabilities are aggregates and
joins over all of these n-grams and those of all words to score; none is left
out, and the model grows with the input.  Every distinct word is valued once:
words go in batches, a batch asks for each of its n-grams once, and the answers
meet its words.  A step's tables and shuffles are removed when its successor is
written.  The most frequent ``HOT_WORDS`` values are sent to the tasks that score, so that
no word is hot in a join; the other words of a text meet theirs in a join.

Rows with crc32(id as text) mod ``folds`` = 0 are held out and never learnt
from.  Several labels of an id count as toxic if one is; null labels are
dropped.  A null text is empty and has no evidence.  Without labels of both
classes every score is 0.  Repeated rows are scored alike.  Other columns are
not read.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from closure_engine.session import shuffles_removed

from .common import byte_slices, column, discard, sized_batches, sparing, string_buffers, written
from .rolling import LETTERS, Texts

if TYPE_CHECKING:  # Python workers import this module and need no pandas
    import pandas as pd

#: Symbols of an n-gram; one byte each of a 64-bit key, the predicted one last.
ORDER = 6
DISCOUNT = 0.75
#: Log-likelihood by which a word has to differ to count as evidence.
MARGIN = 2.0
#: Words whose values are sent to the tasks; all others are joined, with the same result.
HOT_WORDS = 1 << 17
#: Bounds on the words that ask for their n-grams together: their number and bytes.
BATCH_WORDS, BATCH_BYTES = 1 << 17, 4 << 20
#: Bound on the labelled training rows that the logistic function is fitted on.
MAX_FITTED = 50_000
#: The logistic function where these rows lack a class: toxic is a text whose words differ by MARGIN on average.
UNFITTED = (1.0, 0.0, 0.0, -MARGIN)
_U = np.uint64
_START, _END = 1, 2


def word_grams(t: Texts, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, place in ``first``) of every character n-gram of the words ``first``, their end included."""
    start, size = t.start[first], t.stop[first] - t.start[first]
    at = np.concatenate(([0], np.cumsum(size + 2)))
    symbols = np.zeros(at[-1], _U)
    symbols[at[:-1]], symbols[at[1:] - 1] = _START, _END
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    symbols[np.repeat(at[:-1] + 1, size) + inside] = t.data[np.repeat(start, size) + inside]
    word = np.repeat(np.arange(len(first)), size + 2)
    place = np.arange(len(symbols)) - np.repeat(at[:-1], size + 2)
    keys = np.zeros(len(symbols), _U)
    for back in range(ORDER):
        far = np.flatnonzero(place >= back)
        keys[far] |= symbols[far - back] << _U(8 * back)
    return keys[place > 0], word[place > 0]


def _symbols(keys: np.ndarray) -> np.ndarray:
    return sum(((keys >> _U(8 * i)) > 0).astype(np.int64) for i in range(ORDER))


def _lower(keys: np.ndarray, n: int) -> np.ndarray:
    """The keys without their oldest symbol, which is the n-th."""
    return keys & _U((1 << 8 * (n - 1)) - 1)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    names, at = np.unique(keys, return_inverse=True)
    return names, np.stack([np.bincount(at, c, len(names)) for c in counts.T], 1)


class KneserNeyPair:
    """What the toxic model's log-likelihood exceeds the ordinary one's by, for every n-gram and backoff.

    The plain form of ``gram_values``, for n-grams that fit into memory.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """``counts``: of the ordinary and of the toxic class, a row an n-gram."""
        n_symbols = _symbols(keys)
        tables = {ORDER: (keys[n_symbols == ORDER], counts[n_symbols == ORDER])}
        order = np.argsort(tables[ORDER][0])
        tables[ORDER] = tuple(x[order] for x in tables[ORDER])
        for n in range(ORDER - 1, 0, -1):  # continuation counts, and full counts where a word's start leaves no longer context
            above, c = tables[n + 1]
            tables[n] = _summed(np.concatenate((_lower(above, n + 1), keys[n_symbols == n])),
                                np.concatenate(((c > 0).astype(float), counts[n_symbols == n])))
        names, c = tables[1]
        shared = (c.sum(1) + 1) / (c.sum(1) + 1).sum()
        total = np.maximum(c.sum(0), 1)
        p = np.maximum(c - DISCOUNT, 0) / total + DISCOUNT * (c > 0).sum(0) / total * shared[:, None]
        self.grams, self.backoffs = {1: (names, np.log(p[:, 1] / p[:, 0]))}, {}
        for n in range(2, ORDER + 1):
            keys_n, c = tables[n]
            contexts, at = np.unique(keys_n >> _U(8), return_inverse=True)
            below = p[np.searchsorted(names, _lower(keys_n, n))]
            total = np.stack([np.bincount(at, x, len(contexts)) for x in c.T], 1)
            kinds = np.stack([np.bincount(at, x > 0, len(contexts)) for x in c.T], 1)
            rest = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            p = np.maximum(c - DISCOUNT, 0) / np.maximum(total[at], 1) + rest[at] * below
            names = keys_n
            self.grams[n] = (names, np.log(p[:, 1] / p[:, 0]).astype(np.float32))
            self.backoffs[n] = (contexts, np.log(rest[:, 1] / rest[:, 0]).astype(np.float32))

    def excess(self, keys: np.ndarray) -> np.ndarray:
        """Of each n-gram: its log-likelihood under the toxic model less that under the ordinary one."""
        out, keys = np.zeros(len(keys)), keys.copy()
        n_symbols = _symbols(keys)
        open_ = np.ones(len(keys), bool)
        for n in range(ORDER, 0, -1):
            at = np.flatnonzero(open_ & (n_symbols == n))
            hit, value = _found(*self.grams[n], keys[at])
            out[at] += value
            open_[at[hit]] = False
            miss = at[~hit]
            if n > 1:
                out[miss] += _found(*self.backoffs[n], keys[miss] >> _U(8))[1]
                keys[miss] = _lower(keys[miss], n)
                n_symbols[miss] = n - 1
        return out


def _found(names: np.ndarray, values: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are among the sorted names, and their values (0 for the others)."""
    if not len(names):
        return np.zeros(len(keys), bool), np.zeros(len(keys))
    at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
    hit = names[at] == keys
    return hit, np.where(hit, values[at], 0.0)


def held_out(id_col: str, folds: int = 5) -> Column:
    """crc32 of the id as text, mod ``folds``, is 0; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


#: Counts of an n-gram: ordinary and toxic texts of either half of the training rows.
_COUNTS = ("ordinary0", "toxic0", "ordinary1", "toxic1")


def _half(id_col: str) -> Column:
    return F.pmod(F.xxhash64(id_col, F.lit("half")), F.lit(2)).cast("int")


def _count(docs: DataFrame, text_col: str) -> DataFrame:
    """The n-grams of all texts, key and _COUNTS; ``docs``: text, toxic, half."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, b in byte_slices(column(batch, text_col), 2 << 20):
                t = Texts(*string_buffers(column(batch, text_col)[a:b]), lower=True, solid=LETTERS)
                toxic, half = (column(batch, c)[a:b].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("toxic", "half"))
                kind = (2 * half + toxic)[t.doc]
                _, first, at = np.unique(t.words(), return_index=True, return_inverse=True)
                counts = np.bincount(4 * at + kind, minlength=4 * len(first)).reshape(-1, 4)
                keys, word = word_grams(t, first)
                found.append(_summed(keys, counts[word]))
            if found:
                keys, counts = _summed(np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found]))
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), *map(pa.array, counts.astype(np.int64).T)], ["key", *_COUNTS])

    counted = docs.mapInArrow(sparing(count), "key long, " + ", ".join(f"{c} long" for c in _COUNTS))
    return counted.groupBy("key").agg(*(F.sum(c).alias(c) for c in _COUNTS))


#: The models: of all training rows and of either half; their counts of the ordinary and of the toxic class.
_MODELS = {"all": (("ordinary0", "ordinary1"), ("toxic0", "toxic1")), "half0": (("ordinary0",), ("toxic0",)), "half1": (("ordinary1",), ("toxic1",))}
_CLASSES = tuple(f"{m}_{c}" for m in _MODELS for c in (0, 1))


def gram_values(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """key and, by model, what the toxic model's log-likelihood exceeds the ordinary one's by, for each key of ``asked``.

    ``counts``: key and _COUNTS of all training n-grams; ``asked``: distinct
    keys.  The result is written.  A key has at most 255 keys after it in its context and at most 255
    keys that it is the lower order of, so no key is hot.
    """
    known = counts.select("key", *(sum(F.col(c) for c in _MODELS[m][k]).cast("double").alias(f"{m}_{k}") for m in _MODELS for k in (0, 1)),
                          F.lit(0).alias("asked"))
    every = known.unionByName(asked.select("key", *(F.lit(0.0).alias(c) for c in _CLASSES), F.lit(1).alias("asked")))
    below = lambda key, n: key.bitwiseAND(F.lit((1 << 8 * n) - 1))
    key = F.col("key")
    # each n-gram and all its lower orders: how often it occurs, and its counts where it is whole
    suffixes = F.array(*(F.when(key >= 1 << 8 * (n - 1), F.struct(F.lit(n).alias("n"), below(key, n).alias("key"), (below(key, n) == key).alias("whole")))
                         for n in range(1, ORDER + 1)))
    cut = every.select(F.explode(F.filter(suffixes, lambda x: x.isNotNull())).alias("s"), *_CLASSES, "asked").select(
        "s.n", "s.key", "s.whole", *_CLASSES, "asked")
    seen = cut.groupBy("n", "key").agg(
        *((F.sum(c) > 0).cast("double").alias(f"any_{c}") for c in _CLASSES),
        *(F.sum(F.when(F.col("whole"), F.col(c)).otherwise(0.0)).alias(c) for c in _CLASSES),
        F.max(F.when(F.col("whole"), F.col("asked")).otherwise(0)).alias("asked"))
    # continuation counts, and full counts at the highest order and where a word's start leaves no longer context
    shorter = F.expr("key & (shiftleft(1L, 8 * (n - 1)) - 1)")
    seen = written(seen, "toxic-seen")
    counted = seen.select("n", "key", *_CLASSES, "asked").unionByName(seen.where("n > 1").select(
        (F.col("n") - 1).alias("n"), shorter.alias("key"), *(F.col(f"any_{c}").alias(c) for c in _CLASSES), F.lit(0).alias("asked")))
    counted = counted.groupBy("n", "key").agg(*(F.sum(c).alias(c) for c in _CLASSES), F.max("asked").alias("asked"))
    context = Window.partitionBy("n", F.shiftright("key", 8))
    total = {c: F.sum(c).over(context) for c in _CLASSES}
    kinds = {c: F.sum((F.col(c) > 0).cast("double")).over(context) for c in _CLASSES}
    tables = written(counted.select(
        "n", "key", "asked", *_CLASSES, *(total[c].alias(f"total_{c}") for c in _CLASSES),
        *(F.when(total[c] > 0, DISCOUNT * kinds[c] / F.greatest(total[c], F.lit(1.0))).otherwise(1.0).alias(f"rest_{c}") for c in _CLASSES)),
        "toxic-tables")
    discard(seen)

    def level(rows: DataFrame, lower: dict[str, Column]) -> DataFrame:
        p = {c: F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.greatest(f"total_{c}", F.lit(1.0)) + F.col(f"rest_{c}") * lower[c] for c in _CLASSES}
        return rows.select("key", "asked", *(p[c].alias(f"p_{c}") for c in _CLASSES))

    # the lowest order: both classes share one distribution; a byte that neither has seen says nothing
    first = tables.where("n = 1")
    own = {m: F.col(f"{m}_0") + F.col(f"{m}_1") for m in _MODELS}
    whole = Window.partitionBy("n")  # 255 keys at most
    first = first.withColumns({f"shared_{m}": (own[m] + 1) / F.sum(F.when(own[m] > 0, own[m] + 1)).over(whole) for m in _MODELS})
    p = level(first, {c: F.col(f"shared_{c.split('_')[0]}") for c in _CLASSES}).alias("p").join(first.select(
        F.col("key").alias("same"), *(own[m].alias(f"own_{m}") for m in _MODELS)), F.col("key") == F.col("same"))
    p = p.select("key", "asked", *(F.when(F.col(f"own_{c.split('_')[0]}") > 0, F.col(f"p_{c}")).otherwise(1.0).alias(f"p_{c}") for c in _CLASSES))
    out, orders = [], []
    for n in range(1, ORDER + 1):
        if n > 1:
            rows = tables.where(F.col("n") == n).withColumn("lower", below(key, n - 1))
            lower = p.select(F.col("key").alias("lower"), *(F.col(f"p_{c}").alias(f"lower_{c}") for c in _CLASSES))
            p = level(rows.join(lower, "lower"), {c: F.col(f"lower_{c}") for c in _CLASSES})
        p = written(p, f"toxic-order{n}")
        orders.append(p)
        out.append(p.where("asked = 1").select("key", *(F.log(F.col(f"p_{m}_1") / F.col(f"p_{m}_0")).alias(m) for m in _MODELS)))
    values = out[0]
    for x in out[1:]:
        values = values.unionByName(x)
    values = written(values, "toxic-values")
    for x in (tables, *orders):
        discard(x)
    return values


def _vocabulary(docs: DataFrame, text_col: str) -> DataFrame:
    """Every distinct word of all texts: letters, n."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in byte_slices(column(batch, text_col), 2 << 20):
                t = Texts(*string_buffers(column(batch, text_col)[a:b]), lower=True, solid=LETTERS)
                _, first, n = np.unique(t.words(), return_index=True, return_counts=True)
                letters = [t.data[x:y].tobytes() for x, y in zip(t.start[first].tolist(), t.stop[first].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(letters, pa.binary()), pa.array(n)], ["letters", "n"])

    return docs.select(text_col).mapInArrow(sparing(read), "letters binary, n long").groupBy("letters").agg(F.sum("n").alias("n"))


def _batched(words: DataFrame) -> DataFrame:
    """batch, word, letters, n; a batch keeps to BATCH_WORDS and, but for a longer word, BATCH_BYTES.

    ``words``: letters, n and, if it is not to be the letters' hash, word.
    """

    def hashes(letters: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0, np.int64), *(
            Texts(*string_buffers(letters[a:b]), solid=LETTERS).words().view(np.int64) for a, b in byte_slices(letters, 2 << 20))]))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, size = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            lengths = np.diff(string_buffers(column(batch, "letters"))[1])
            numbers = np.empty(len(lengths), np.int64)
            for i, length in enumerate(lengths.tolist()):
                if n and (n >= BATCH_WORDS or size + length > BATCH_BYTES):
                    at, n, size = at + 1, 0, 0
                numbers[i], n, size = at, n + 1, size + length
            letters = column(batch, "letters")
            word = column(batch, "word") if "word" in batch.schema.names else hashes(letters)
            yield pa.RecordBatch.from_arrays([pa.array(numbers), word, letters, column(batch, "n")], ["batch", "word", "letters", "n"])

    return words.mapInArrow(sparing(deal), "batch long, word long, letters binary, n long")


def _spellings(letters: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Of a slice of words at a time: where it begins and ends, its n-grams' keys and the word, from the slice's first on, of each."""
    for a, b in byte_slices(letters, 1 << 18):
        data, ends = string_buffers(letters[a:b])
        yield a, b, *word_grams(SimpleNamespace(data=data, start=ends[:-1], stop=ends[1:]), np.arange(b - a))


def _asked(words: DataFrame) -> DataFrame:
    """batch, key: the character n-grams of every batch of words; once a batch, or once for each task that reads a part of it."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys = None, np.zeros(0, _U)
        answer = lambda: pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), now)), pa.array(keys.astype(np.int64))], ["batch", "key"])
        for batch in batches:
            numbers = column(batch, "batch").to_numpy()
            cuts = np.flatnonzero(numbers[1:] != numbers[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(numbers)]):
                if a == b:
                    continue
                if now != numbers[a]:
                    if now is not None:
                        yield answer()
                    now, keys = numbers[a], np.zeros(0, _U)
                keys = np.unique(np.concatenate([keys, *(np.unique(k) for _, _, k, _ in _spellings(column(batch, "letters")[a:b]))]))
        if now is not None:
            yield answer()

    return words.select("batch", "letters").mapInArrow(sparing(ask), "batch long, key long")


def word_values(counts: DataFrame, words: DataFrame) -> DataFrame:
    """word, n and, by model, the difference of the word's log-likelihoods; ``words``: as for ``_batched``, each word once."""
    words = written(_batched(words), "toxic-words")
    asked = written(_asked(words), "toxic-asked")
    values = gram_values(counts, asked.select("key").distinct())
    answers = asked.join(values.hint("merge"), "key").select("batch", "key", *_MODELS)

    def add(words: pa.Table, answers: pa.Table) -> pa.Table:
        words, answers = words.combine_chunks(), answers.combine_chunks()
        keys, first = np.unique(answers.column("key").to_numpy(), return_index=True)
        of_key = np.stack([answers.column(m).to_numpy()[first] for m in _MODELS], 1)
        sums = np.zeros((len(words), len(_MODELS)))
        for chunk in words.column("letters").chunks[:1]:
            for a, b, asked, word in _spellings(chunk):
                at = np.searchsorted(keys, asked.astype(np.int64))
                sums[a:b] = np.stack([np.bincount(word, x[at], b - a) for x in of_key.T], 1)
        return pa.table([words.column("word"), words.column("n"), *map(pa.array, sums.T)], ["word", "n", *_MODELS])

    valued = written(words.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        add, "word long, n long, " + ", ".join(f"{m} double" for m in _MODELS)), "toxic-word-values")
    for x in (words, asked, values):
        discard(x)
    return valued


def evidence(texts: pa.Array, model: KneserNeyPair) -> np.ndarray:
    """(mean excess, mean excess beyond the margin) of the words of each text."""
    t = Texts(*string_buffers(texts), lower=True, solid=LETTERS)
    _, first, at = np.unique(t.words(), return_index=True, return_inverse=True)
    keys, word = word_grams(t, first)
    of_word = np.bincount(word, model.excess(keys), len(first))[at]
    n = np.maximum(t.n_words, 1)
    return np.stack([np.bincount(t.doc, of_word, t.n) / n, np.bincount(t.doc, np.maximum(of_word - MARGIN, 0), t.n) / n], 1)


def _inputs(e: np.ndarray) -> np.ndarray:
    return np.column_stack((e[:, 0], e[:, 1], np.sqrt(np.maximum(e[:, 1], 0)), np.ones(len(e))))


def _logistic(e: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    x, w = _inputs(e), np.zeros(4)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(4), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             folds: int = 5) -> DataFrame:
    """id, held_out, score, predicted for every row of ``docs``."""
    with shuffles_removed(docs.sparkSession), sized_batches(docs.sparkSession):
        return _toxicity(docs, labels, id_col, text_col, label_col, folds)


def _toxicity(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int) -> DataFrame:
    chosen = docs.select(id_col, text_col)
    marked = labels.where(F.col(label_col).isin(0, 1) & ~held_out(id_col, folds) & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("label_id")).agg(F.max(label_col).cast("int").alias("toxic"))
    learnt = chosen.where(~held_out(id_col, folds)).join(marked.hint("shuffle_hash"), F.col(id_col) == F.col("label_id"))
    counts = written(_count(learnt.select(text_col, "toxic", _half(id_col).alias("half")), text_col), "toxic-grams")
    held = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS)).first()
    has = {m: all(sum(held[c] for c in of) > 0 for of in _MODELS[m]) for m in _MODELS}
    if not has["all"]:
        return chosen.select(id_col, held_out(id_col, folds).alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    values = word_values(counts, _vocabulary(docs, text_col))
    discard(counts)
    measured = _measured(chosen, values, id_col, text_col)
    discard(values)
    share = min(1.0, MAX_FITTED / max(1, learnt.select(id_col).count()))
    sampled = F.pmod(F.xxhash64(id_col, F.lit("sample")), F.lit(1 << 20)) <= int(share * (1 << 20))
    usable = F.when(_half(id_col) == 0, F.lit(has["half1"])).otherwise(F.lit(has["half0"]))
    rows = measured.where(sampled & usable).join(marked, F.col(id_col) == F.col("label_id")).select(
        "other_mean", "other_beyond", "toxic").limit(2 * MAX_FITTED).toPandas()
    fitted = UNFITTED if rows["toxic"].nunique() < 2 else _logistic(rows[["other_mean", "other_beyond"]].to_numpy(), rows["toxic"].to_numpy(float))
    w = [F.lit(float(x)) for x in fitted]
    z = w[0] * F.col("mean") + w[1] * F.col("beyond") + w[2] * F.sqrt(F.greatest("beyond", F.lit(0.0))) + w[3]
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    return measured.select(id_col, held_out(id_col, folds).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def _hot(values: DataFrame) -> pd.DataFrame:
    """The most frequent words, HOT_WORDS at most, by word.

    Those of the highest levels that fit as a whole; the first rows of a sorted
    table would send as many rows of every partition to the driver.
    """
    level = F.floor(F.log2("n") * 32)
    n, least = 0, None
    for x in values.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():  # 2,048 rows at most
        if (n := n + x["words"]) > HOT_WORDS:
            break
        least = x["level"]
    return (values.limit(0) if least is None else values.where(level >= least)).toPandas().sort_values("word")


def _measured(docs: DataFrame, values: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, mean, beyond, other_mean, other_beyond for every row of ``docs``; "other" is by the model of the half without the row."""
    names = ("mean", "beyond", "other_mean", "other_beyond")
    hot = _hot(values)
    hot_words, hot_values = hot["word"].to_numpy(np.int64), hot[list(_MODELS)].to_numpy(float)
    id_type = docs.schema[id_col].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, b in byte_slices(column(batch, text_col), 2 << 20):
                part = batch.slice(a, b - a)
                t = Texts(*string_buffers(column(part, text_col)), lower=True, solid=LETTERS)
                half = column(part, "half").to_numpy().astype(np.int64)
                words, at = np.unique(t.words().view(np.int64), return_inverse=True)
                place = np.minimum(np.searchsorted(hot_words, words), len(hot_words) - 1) if len(hot_words) else np.zeros(len(words), np.int64)
                hit = hot_words[place] == words if len(hot_words) else np.zeros(len(words), bool)
                of_word = np.zeros((len(words), 3))
                of_word[hit] = hot_values[place[hit]]
                own, other = of_word[at, 0], of_word[at, 2 - half[t.doc]]
                unmet = ~hit[at]
                sums = [np.bincount(t.doc, x * ~unmet, t.n) for x in (own, np.maximum(own - MARGIN, 0), other, np.maximum(other - MARGIN, 0))]
                ends = np.concatenate(([0], np.cumsum(np.bincount(t.doc[unmet], minlength=t.n)))).astype(np.int32)
                cold = pa.ListArray.from_arrays(pa.array(ends), pa.array(words[at[unmet]]))
                yield pa.RecordBatch.from_arrays(
                    [column(part, id_col), pa.array(np.arange(row, row + t.n)), pa.array(half), pa.array(t.n_words.astype(np.int64)), *map(pa.array, sums), cold],
                    [id_col, "row", "half", "words", *names, "cold"])
                row += t.n

    rows = written(docs.withColumn("half", _half(id_col).cast("long")).mapInArrow(
        sparing(measure), f"`{id_col}` {id_type}, row long, half long, words long, " + ", ".join(f"{x} double" for x in names) + ", cold array<long>"),
        "toxic-evidence")
    kept = rows
    if values.count() > len(hot_words):
        over = lambda c: F.greatest(c - MARGIN, F.lit(0.0))
        own, other = F.col("own"), F.col("other")
        # two values a word travel, not their four partial sums: hardly two words of a text are in one task
        cold = rows.select("row", "half", F.explode("cold").alias("word")).join(values.drop("n").hint("merge"), "word").select(
            F.col("row").alias("cold_row"), F.col("all").alias("own"), F.when(F.col("half") == 0, F.col("half1")).otherwise(F.col("half0")).alias("other"))
        cold = cold.repartition("cold_row").groupBy("cold_row").agg(
            *(F.sum(x).alias(f"cold_{name}") for name, x in zip(names, (own, over(own), other, over(other)))))
        rows = rows.join(cold, F.col("row") == F.col("cold_row"), "left").withColumns(
            {x: F.col(x) + F.coalesce(F.col(f"cold_{x}"), F.lit(0.0)) for x in names})
    n = F.greatest("words", F.lit(1))
    means = written(rows.select(id_col, *((F.col(x) / n).alias(x) for x in names)), "toxic-means")
    discard(kept)
    return means
