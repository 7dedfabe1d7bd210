"""Cross-tokenizer alignment against whole texts, set intersection and all pairs."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from closure_engine.llm import alignment
from closure_engine.llm.alignment import Aligner, cross_tokenizer_alignment, group_sizes, linked_pairs

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_groups(text, libraries):
    """[(ids of A, ids of B)] of a text; None without tokens."""
    from tokenizers.decoders import ByteLevel  # noqa: F401  (the library's own decoder is behind decode)

    a, b = libraries
    if not text:
        return None
    whole = b" " + text.encode()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    back = {chr(x): x for x in visible} | {chr(0x100 + i): x for i, x in enumerate(x for x in range(256) if x not in visible)}
    bytes_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return None
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    out, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
        out.append((ids_a[i:x], ids_b[j:y]))
        i, j = x, y
    return out


def plain(rows, libraries):
    groups = [plain_groups(t, libraries) for _, t in rows]
    links = [Counter((a, b) for x, y in g or [] for a in x for b in y) for g in groups]
    count = Counter(p for held in links for p in held)
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    out = Counter()
    for (i, _), g, held in zip(rows, groups, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g or [])
        out[(i, sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []), sum(held.values()),
             sum(n for p, n in held.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in held.items()),
             hashlib.sha256(text.encode()).hexdigest() if g else "")] += 1
    return out


def check(docs, libraries, **settings):
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()], libraries)
    got = Counter(map(tuple, cross_tokenizer_alignment(docs, A, B, **settings).collect()))
    assert got == want


def test_given_documents(spark, sf, libraries):
    check(spark.read.parquet(f"{sf}/documents.parquet"), libraries)


def test_awkward_documents(odd, libraries):
    check(odd.where("length(text) < 20000 or text is null"), libraries)


def test_long_documents(odd):
    rows = cross_tokenizer_alignment(odd.where("length(text) >= 20000"), A, B).collect()
    assert len(rows) == 2 and all(r["n_a"] > 1000 and r["n_links"] >= r["n_groups"] > 0 for r in rows)


def test_texts_that_are_cut_oddly(spark, libraries):
    texts = ["a  b", " a", "a ", "a\nb", "a▁b", "<s>x</s>", "<unk>", "<0x41>", "<|endoftext|> a<|endoftext|>", "ﬁ Å é  ", "\x00a",
             "a   b  c", "\xa0x", "x　y", "\t\ta  ", "\n", "  ", " ", "\n \n a \n", "​", "﻿a", "ｱ" * 9, "it's we'll 12 345", "\U0001F600 x"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), libraries)


def test_pairs_that_are_looked_up_by_a_join(spark, sf, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "LIST", 50)  # not seen by the tasks, whose processes import the module anew
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    check(docs, libraries, most_sent=4)


def test_repeated_rows_count_as_documents(spark, libraries):
    docs = spark.createDataFrame([(1, "some words here")] * 40 + [(2, "some other words")], "doc_id long, text string")
    check(docs, libraries)


def test_empty_table(none):
    assert cross_tokenizer_alignment(none, A, B).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_groups_are_cut_where_both_arrays_end(seed):
    r = random.Random(seed)
    for _ in range(400):
        last = r.randrange(2, 300)
        a, b = (sorted({last, *r.sample(range(1, last), r.randrange(last))}) for _ in range(2))
        if r.random() < 0.5:
            b = sorted({last, *r.sample(a, int(len(a) * 0.95)), *r.sample(range(1, last), min(3, last - 1))})
        n, m = group_sizes(a, b)
        cuts = sorted(set(a) & set(b))
        assert [a[i - 1] for i in np.cumsum(n)] == cuts and [b[i - 1] for i in np.cumsum(m)] == cuts


def test_long_stretches_are_jumped():
    a = list(range(1, 100_001))
    b = [x for x in a if x not in (5, 50_000, 99_999)]
    n, m = group_sizes(a, b)
    assert Counter(zip(n.tolist(), m.tolist())) == {(1, 1): len(b) - 3, (2, 1): 3}


@pytest.mark.parametrize("most", [7, 40, 1 << 20])
def test_links_spelled_out_in_slices(monkeypatch, most):
    monkeypatch.setattr(alignment, "AT_ONCE", most)
    r = np.random.default_rng(5)
    n, m = r.integers(1, 9, 60), r.integers(1, 9, 60)
    a, b = r.integers(0, 12, n.sum()), r.integers(0, 12, m.sum())
    want, i, j = Counter(), 0, 0
    for x, y in zip(n, m):
        want.update((int(p) << 32) + int(q) for p in a[i:i + x] for q in b[j:j + y])
        i, j = i + x, j + y
    keys, times = linked_pairs(a, b, n, m)
    assert dict(zip(keys.tolist(), times.tolist())) == want


def test_one_large_group():
    aligner = Aligner(A, B)
    (a, b, n, m), = aligner.align(["ｱ" * 3000])
    keys, times = linked_pairs(a, b, n, m)
    assert times.sum() == (n * m).sum() and len(set(keys.tolist())) == len(keys)
