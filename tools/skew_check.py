"""Skew experiment: one vertex holding about half of all edges.

Graph: K (``lineitem`` part -> supplier) plus one hub joined to a leaf per
line item (leaf id derived from order key and line number), so the hub has
as many edges as ``lineitem`` has rows.  The closure runs twice, with the
default hub handling and with hubs disabled, and the Spark event log (in a
fresh scratch folder) gives, per stage, the largest task's share of the
records that stage read.  The result must match in both runs.

Usage: python tools/skew_check.py [sf_dir] [cpus]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from closure_engine import SkewConfig, closure  # noqa: E402
from closure_engine.plans.graphs import raw_edges  # noqa: E402
from closure_engine.session import build_session  # noqa: E402
from closure_engine.sources.tables import table  # noqa: E402

HUB = -1
LEAF_BASE = 10_000_000


def hub_graph(spark, sf_dir):
    k = raw_edges(spark, sf_dir, "K")
    leaves = table(spark, sf_dir, "lineitem").select(
        F.lit(HUB).cast("bigint").alias("src"),
        (F.lit(LEAF_BASE) + F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("dst"))
    return k.unionByName(leaves)


def stage_skew(ev_dir: str, description: str):
    import zstandard

    tasks: dict[int, list[int]] = {}
    job_stages: dict[int, list[int]] = {}
    wanted: set[int] = set()
    for f in sorted(glob.glob(ev_dir + "/*/events*")):
        with open(f, "rb") as fh:
            raw = fh.read()
        text = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)) if f.endswith(".zstd") else io.BytesIO(raw)
        for line in io.TextIOWrapper(text, encoding="utf-8"):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                props = e.get("Properties") or {}
                job_stages[e["Job ID"]] = e["Stage IDs"]
                if props.get("spark.job.description") == description:
                    wanted.update(e["Stage IDs"])
            elif e["Event"] == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                if (m.get("Input Metrics") or {}).get("Records Read", 0):
                    continue  # scan stages: split by file layout, not by key
                rec = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                tasks.setdefault(e["Stage ID"], []).append(rec)
    worst = []
    for sid, recs in tasks.items():
        if sid in wanted and sum(recs) > 10_000 and len(recs) > 1:
            worst.append((max(recs) / sum(recs), sid, max(recs), sum(recs), len(recs)))
    return sorted(worst, reverse=True)[:5]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    cpus = sys.argv[2] if len(sys.argv) > 2 else "8"
    ev = tempfile.mkdtemp(prefix="skew-ev-")
    # Fixed 64 partitions, no coalescing: an even stage puts ~1.6% in each
    # task.  No automatic broadcast either: on a cluster the vertex tables
    # are far too large for one, so joins are shuffles (explicit, bounded
    # broadcasts such as the hub table still apply).
    spark = build_session(f"local[{cpus}]", 64, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": ev,
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    edges = hub_graph(spark, sf_dir)
    runs = {"hub handling on": SkewConfig(),
            "hub handling off": SkewConfig(min_hot_rows=1 << 62, split_rows=1 << 62)}
    closure(edges).summary.collect()  # warm-up
    out = {}
    for label, cfg in runs.items():
        spark.sparkContext.setJobDescription(label)
        t0 = time.time()
        row = closure(edges, cfg=cfg).summary.collect()[0]
        out[label] = (row, time.time() - t0)
    spark.sparkContext.setJobDescription(None)
    spark.stop()
    rows = [r for r, _ in out.values()]
    print("results equal:", rows[0] == rows[1], rows[0])
    for label, (_, secs) in out.items():
        print(f"\n{label}: {secs:.1f}s; shuffle stages with the largest single-task share of records read:")
        for share, sid, mx, tot, n in stage_skew(ev, label):
            print(f"  stage {sid:4d}: {share:6.1%} of {tot:>9,d} records in one task ({n} tasks)")


if __name__ == "__main__":
    main()
