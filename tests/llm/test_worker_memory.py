import subprocess
import sys

import numpy as np
import pyarrow as pa

import closure_engine.llm.toxicity as module
from closure_engine.llm import rolling
from closure_engine.llm.common import sized_batches, written

ROW = 40_000


def test_tables_of_powers_are_small():
    held = sum(x.nbytes for p in rolling._powers() for x in vars(p).values())
    assert held <= 16 << 20
    assert len(rolling._powers()[0].high) * rolling._BLOCK >= 1 << 31  # bytes of a string


def test_hashes_over_many_blocks():
    at = np.array([0, 1, 5, rolling._BLOCK - 1, rolling._BLOCK, 3 * rolling._BLOCK + 7, (1 << 31) - 1])
    p = rolling._powers()[0]
    base = 0x9E3779B97F4A7C15
    assert p.of(at).tolist() == [pow(base, i, 1 << 64) for i in at.tolist()]
    assert p.inverse(at).tolist() == [pow(base, -i, 1 << 64) for i in at.tolist()]
    # a range's hash is the same wherever it stands
    words = [b"start", b"middle" * 30_000, b"x", b"middle" * 30_000, b"start", b"y" * rolling._BLOCK, b"x"]
    data = np.frombuffer(b" ".join(words), np.uint8)
    h = rolling.Texts(data, np.array([0, len(data)])).words().tolist()
    assert [h.index(x) for x in h] == [words.index(x) for x in words]


def test_workers_need_no_pandas():
    found = subprocess.run([sys.executable, "-c", "import sys, closure_engine.llm.toxicity; print('pandas' in sys.modules)"],
                           capture_output=True, text=True, check=True, env={"PYTHONPATH": ":".join(sys.path)})
    assert found.stdout.strip() == "False"


def test_batches_end_at_a_number_of_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    docs = spark.range(0, 400, 1, 1).selectExpr("id", f"repeat('x', {ROW}) as text")
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    with sized_batches(spark):
        got = [r["n"] for r in written(docs.mapInArrow(sizes, "n long"), "test-batches").collect()]
    assert sum(got) == 400 and max(got) * ROW <= 5 << 20
    assert spark.conf.get(name, None) == before


def test_toxicity_sizes_its_batches(spark, monkeypatch):
    seen = []
    inner = module._toxicity
    monkeypatch.setattr(module, "_toxicity", lambda docs, *a: seen.append(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) or inner(docs, *a))
    docs = spark.createDataFrame([(i, "a fine day" if i % 2 else "you awful fool") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(20)], "doc_id long, toxic int")
    assert module.toxicity(docs, labels).count() == 20
    assert seen == [str(4 << 20)]
