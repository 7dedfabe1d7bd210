"""Command line: ``python -m closure_engine EDGES [OUT] [--sep REGEX] [--permissive]``.

Reads a text edge list, computes every measure and prints the one-row
summary (global and average coefficients included).  With ``OUT`` the
per-vertex table and the summary are written there as Parquet.
"""

from __future__ import annotations

import argparse
import json

from closure_engine.plans.programs import closure_from_text
from closure_engine.session import build_session
from closure_engine.sources.sinks import write_closure


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="python -m closure_engine")
    ap.add_argument("edges", help="text edge list: file or directory")
    ap.add_argument("out", nargs="?", help="folder for per_vertex/ and summary/ Parquet")
    ap.add_argument("--sep", default=r"\s+", help="separator regex (default: whitespace)")
    ap.add_argument("--permissive", action="store_true", help="drop malformed lines instead of failing")
    ap.add_argument("--partitions", type=int, default=None, help="repartition the edges after reading")
    args = ap.parse_args(argv)
    spark = build_session()
    result = closure_from_text(spark, args.edges, args.sep, "permissive" if args.permissive else "strict",
                               args.partitions)
    summary = write_closure(result, args.out) if args.out else result.summary
    row = summary.collect()[0].asDict()
    row["triplets"] = int(row["triplets"])
    print(json.dumps(row))
    return row


if __name__ == "__main__":
    main()
