"""Write PLANS.md: what the headline queries read and shuffle, and the flagship's plan.

Rows read, shuffled rows and bytes come from the session's own event log, so
subqueries, eager jobs and branches that adaptive execution dropped after they
ran are counted.  Usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from closure_engine.plans.registry import QUERIES  # noqa: E402
from closure_engine.session import build_session  # noqa: E402
from tools.event_log import measure, settings  # noqa: E402

NAMES = ["closure_summary", "closure_report", "local_closure", "transitivity", "triangles_total", "triangles_list",
         "common_neighbours_edge", "closure_summary_bipartite", "message_rounds_walks", "compat_v20_summary",
         "compat_v25_summary", "compat_v11_transitivity"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16, extra=settings(tempfile.mkdtemp(prefix="events-")))
    size = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in ("lineitem", "orders")}
    lines = ["# What the queries read and shuffle", "",
             f"Input: `{sf_dir}` ({size['lineitem']:,} line items, {size['orders']:,} orders), local[8], 16 shuffle partitions, "
             "AQE on. Generated by `python tools/plan_report.py` from Spark's event log: all jobs of a query, with "
             "subqueries, eager checkpoints and branches that were dropped after they ran.", "",
             "| query | rows read from tables | shuffled rows | shuffled MB | tasks |", "| --- | --- | --- | --- | --- |"]
    flagship = None
    for name in NAMES:
        df = []

        def run(name=name, df=df):
            df.append(QUERIES[name](spark, sf_dir))
            df[0].collect()

        m = measure(spark, run)
        lines.append(f"| `{name}` | {m['records_read']:,} | {m['shuffle_records']:,} | {m['shuffle_mb']:.1f} | {m['tasks']} |")
        if name == "closure_summary":
            # the top-level initial plan starts at column 0; nested subqueries indent theirs
            flagship = df[0]._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    tree = []
    for ln in flagship.splitlines():
        m = re.match(r"^([\s:+\-|]*)(\*\(\d+\) )?([A-Za-z]+)", ln)
        if m:
            tree.append(f"{m.group(1)}{m.group(3)}")
    lines += ["", "## Operator tree of `closure_summary` (final plan)", "", "```"] + tree + ["```", ""]
    spark.stop()
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines))


if __name__ == "__main__":
    main()
