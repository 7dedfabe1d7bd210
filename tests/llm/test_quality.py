"""Quality rules against plain counting."""

import re
from collections import Counter

import pyarrow as pa

from closure_engine.llm.quality import GRAM_LIMITS, LINE_LIMIT, SYMBOL_LIMIT, measure, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    chars = max(1, sum(map(len, words)))

    def covered(n):
        seen = Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
        return {j for i in range(len(words) - n + 1) if seen[tuple(words[i:i + n])] > 1 for j in range(i, i + n)}

    lines = [x for x in text.split("\n") if WORD.search(x)]
    later = [x for i, x in enumerate(lines) if x in lines[:i]]
    repeat, symbols = len(covered(5)), len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 10 or 100 * repeat > 20 * len(words)
    shares = [(sum(len(words[j]) for j in covered(n)) / chars, limit) for n, limit in GRAM_LIMITS.items()]
    shares.append((sum(len(w) for x in later for w in WORD.findall(x)) / chars, LINE_LIMIT))
    kept = not failed and all(a <= b for a, b in shares) and symbols <= SYMBOL_LIMIT * len(words)
    return (len(words), sum(map(len, words)), symbols, len(later), repeat, failed, kept)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def test_given_documents(spark, sf, given):
    rows = quality_rules(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    assert len(rows) == len(given)
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == plain(given[r["doc_id"]])


def test_awkward_documents(odd):
    small = odd.where("doc_id is null or doc_id not in (6, 12)")
    texts = {r["doc_id"]: r["text"] for r in small.collect()}
    rows = quality_rules(small).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in small.collect())
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == plain(texts[r["doc_id"]])


def test_long_words_and_texts(odd):
    got = {r["doc_id"]: r for r in quality_rules(odd).collect()}
    assert got[6]["n_words"] == 60_000 and got[12]["word_chars"] == 50_000 and got[12]["n_words"] == 1


def test_kept_rows_are_unchanged(odd):
    kept = quality_rules(odd, keep=True)
    assert kept.schema == odd.schema
    want = {r["doc_id"] for r in quality_rules(odd).collect() if r["kept"]}
    assert {r["doc_id"] for r in kept.collect()} == want and 10 in want and 11 not in want


def test_empty_table(none):
    assert quality_rules(none).count() == 0


def test_line_with_passed_words_but_repeated_lines():
    text = "\n".join(f"line {i} has quite some words of its own here {i * 7}" for i in range(20))
    clean, dup = measure(pa.array([text, text + "\n" + text]), GRAM_LIMITS, LINE_LIMIT)["line_coverage"]
    assert clean == 0 and abs(dup - 0.5) < 1e-9
