"""Token records: an exact round trip through the files, damage that is noticed, shuffled reads."""

import struct
import zlib
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest

from closure_engine.llm.token_counts import load_tokenizer
from closure_engine.llm.token_records import TRAILER, _file, frame, masked_crc, read_frame, read_index, read_records, shuffled, write_records

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(spark, docs, folder, **settings):
    whole = load_tokenizer(PATH)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    encoded = {t: whole.encode(t, add_special_tokens=False).ids + [2] for _, t in rows}
    path = str(folder / "set")
    write_records(docs, path, PATH, end_id=2, **settings)
    found = sorted(read_records(spark, path).collect(), key=lambda r: r["start"])
    assert [r["start"] for r in found] == list(accumulate([0] + [r["n_tokens"] for r in found]))[:-1]
    assert [r["id"] and int(r["id"]) for r in found] == [i for i, _ in rows]  # ascending, nulls first
    assert Counter((r["id"], tuple(r["ids"])) for r in found) == Counter((None if i is None else str(i), tuple(encoded[t])) for i, t in rows)
    assert all(r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4")) for r in found)
    assert read_index(spark, path).count() == len(rows)
    return path, found


def test_given_documents(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    path, found = check(spark, docs, tmp_path, file_bytes=1 << 14)
    index = read_index(spark, path)
    assert index.select("part", "number").distinct().count() >= 8
    some = read_records(spark, path, index.where("cast(id as int) % 17 = 3"))
    want = {r["start"]: r["ids"] for r in found if int(r["id"]) % 17 == 3}
    assert {r["start"]: r["ids"] for r in some.collect()} == want


def test_awkward_documents(spark, odd, tmp_path):
    check(spark, odd, tmp_path)


def test_copies_of_one_row_are_spread(spark, tmp_path):
    docs = spark.createDataFrame([(4, "a few words that repeat")] * 300 + [(k, "others") for k in range(10)], "doc_id long, text string").repartition(5)
    path, _ = check(spark, docs, tmp_path, ranges=6)
    per_range = [r["count"] for r in read_index(spark, path).groupBy("part").count().collect()]
    assert len(per_range) == 6 and max(per_range) <= 150


def test_empty_table(spark, none, tmp_path):
    write_records(none, str(tmp_path / "set"), PATH)
    assert read_records(spark, str(tmp_path / "set")).count() == 0


def test_shuffled_reads(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(90)
    path, found = check(spark, docs, tmp_path)
    whole = [r["id"] for r in shuffled(spark, path, 7).collect()]
    assert sorted(whole) == sorted(r["id"] for r in found) and whole != [r["id"] for r in found]
    assert whole == [r["id"] for r in shuffled(spark, path, 7).collect()] != [r["id"] for r in shuffled(spark, path, 8).collect()]
    ranks = [[r["id"] for r in shuffled(spark, path, 7, 3, k).collect()] for k in range(3)]
    assert sorted(sum(ranks, [])) == sorted(whole) and all(r == [i for i in whole if i in set(r)] for r in ranks)


def test_an_index_that_does_not_fit_is_an_error(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(5)
    path, _ = check(spark, docs, tmp_path)
    wrong = read_index(spark, path).selectExpr("id", "part", "number", "offset", "length", "n_tokens + 1 as n_tokens", "start")
    with pytest.raises(Exception, match="does not fit"):
        read_records(spark, path, wrong).collect()


def test_frames():
    for name, width in (("7", 2), (None, 2), ("", 4), ("naïve", 4)):
        ids = np.array([3, 5, 60_000], f"<u{width}")
        data = b"xx" + frame(name, ids.tobytes(), width)
        got, values, n, length = read_frame(memoryview(data), 2)
        assert (got, values.tolist(), n, length) == (name, [3, 5, 60_000], 3, len(data) - 2)
    assert masked_crc(b"abc") == (((zlib.crc32(b"abc") >> 15) | (zlib.crc32(b"abc") << 17)) + 0xA282EAD8) & 0xFFFFFFFF
    assert struct.unpack("<Q", frame("7", b"", 2)[:8])[0] == 6


def test_damage_is_noticed():
    whole = frame("12", np.arange(50, dtype="<u2").tobytes(), 2)
    for at in range(len(whole)):
        hurt = bytearray(whole)
        hurt[at] ^= 4
        with pytest.raises(ValueError):
            read_frame(memoryview(bytes(hurt)), 0)
    for end in (5, 15, len(whole) - 1):
        with pytest.raises(ValueError):
            read_frame(memoryview(whole[:end]), 0)
    with pytest.raises(ValueError, match="trailer"):
        _file(whole)
    assert bytes(_file(whole + TRAILER.encode())) == whole and len(_file(b"")) == 0
