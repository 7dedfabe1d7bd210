"""The filter audit against counting every order by hand."""

import itertools
import re

from pyspark.sql import functions as F

from closure_engine.llm.filter_audit import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(rows):
    """The letters that each row fails."""
    out = []
    for i, text, _ in rows:
        text = text or ""
        w = WORD.findall(text)
        f = {"A"} if len(w) < 50 else set()
        f |= {"B"} if 100 * len(set(w)) < 65 * len(w) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else set()
        f |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        f |= {"E"} if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows) else set()
        out.append(f)
    return out


def plain(rows, labels):
    failed = fails(rows)
    good, toxic = ({i for i, *marks in labels if i is not None and marks[k] == 1} for k in (0, 1))
    out = {}
    for part in {s or "" for _, _, s in rows}:
        mine = [(i, f) for (i, _, s), f in zip(rows, failed) if (s or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = set(order[:step - 1])
                gone = [i for i, f in mine if letter in f and not f & before]
                shapley[letter] += len(gone)
                out[part, "".join(order), step] = [
                    sum(not f & {*before, letter} for _, f in mine), len(gone), sum(letter in f and bool(f & before) for _, f in mine),
                    sum(f == {letter} for _, f in mine), sum(i in good for i in gone), sum(i in toxic for i in gone), letter]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return {k: tuple(v) for k, v in out.items()}


def check(spark, docs, labels):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, part string")
    got = filter_audit(docs, marks).collect()
    assert len({r[:3] for r in got}) == len(got)
    assert {tuple(r[:3]): tuple(r[3:]) for r in got} == plain(rows, [x[:3] for x in labels])


def test_awkward_documents(spark, odd):
    check(spark, odd, [(1, 1, 0, "x"), (2, 0, 1, "x"), (2, 1, 0, "x"), (6, 1, 1, "x"), (10, None, 1, "x"), (11, 1, None, "x"), (None, 1, 1, "x"), (99, 1, 1, "x")])


def test_words_symbols_and_copies(spark):
    text = ["w%d" % i for i in range(60)]
    many = [" ".join(text), " ".join(text) + " #", "AB CD", " ".join(["same"] * 60), " ".join(text[:49]), " ".join(text).upper()]
    docs = spark.createDataFrame([(i, many[i % 6] if i % 7 else None, "ab"[i % 2] if i % 5 else None) for i in range(60)],
                                 "doc_id long, text string, source string")
    check(spark, docs, [(i, i % 2, int(i % 3 == 0), "x") for i in range(0, 60, 4)])


def test_a_hot_row_and_null_ids(spark):
    docs = spark.createDataFrame([(5, "copy", "s")] * 200 + [(None, "copy", "s")] * 100 + [(3, "copy", "t"), (7, "copy", "s"), (None, "x", None)],
                                 "doc_id long, text string, source string")
    check(spark, docs, [(5, 1, 0, "x")])


def test_own_filters(spark):
    docs = spark.createDataFrame([(1, "ab", "s"), (2, "b", "s"), (3, "ab", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = filter_audit(docs, labels, {"x": F.col("text").contains("a"), "y": F.col("text").contains("b")}, duplicates=None)
    assert {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["shapley"]) for r in got.collect()} == {
        ("xy", 1): (1, 2, 0, 2), ("xy", 2): (0, 1, 2, 4), ("yx", 1): (0, 3, 0, 4), ("yx", 2): (0, 0, 2, 2)}


def test_empty_table(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(none, labels).count() == 0
