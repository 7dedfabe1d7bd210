"""Token counts against the library on whole texts."""

import random

import numpy as np
import public_tokenizers
import pytest

from closure_engine.llm.token_counts import id_encoder, length_encoder, load_tokenizer, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "b ", " ", "  ", "\n", " \n", "\t", "é", "'s", "<|endoftext|>", " x", "\x1c", "\xa0", "9", "!!", "日本", "don't", "\r\n", "​",
          "\U0001F600", "", ". ", "\x00", "Straße", "naïve,", "　", "end."]


@pytest.fixture(scope="module")
def whole():
    return load_tokenizer(PATH)


@pytest.mark.parametrize("memo", [64, 1 << 16])
def test_parts_give_the_tokens_of_the_whole_text(whole, memo):
    r = random.Random(3)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 14))) for _ in range(6000)]
    want = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    ids, lengths = id_encoder(PATH), length_encoder(PATH)
    ids.memo = lengths.memo = memo
    got, counts = [], []
    for i in range(0, len(texts), 37):
        got += [np.frombuffer(b, "<u4").tolist() for b in ids.encode(texts[i:i + 37])]
        counts += lengths.encode(texts[i:i + 37])
    assert got == want and counts == [len(x) for x in want]


def test_given_and_awkward_documents(spark, sf, odd, whole):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd):
        texts = sorted((str(r["doc_id"]), r["text"] or "") for r in docs.collect())
        rows = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts(docs, PATH).collect())
        want = sorted((i, len(t.encode()), len(whole.encode(t, add_special_tokens=False))) for i, t in texts)
        assert rows == [(*x, x[2] > 512) for x in want]


def test_empty_table(none):
    assert token_counts(none, PATH).count() == 0
