"""What a Spark session's own event log says about the rows that were read.

Unlike the final plan of a query, the log also holds subqueries, branches
that adaptive execution dropped after they ran, and eager jobs.
"""

from __future__ import annotations

import json
import os

#: Settings of a session whose log can be read while it runs; the folder is added.
SETTINGS = {
    "spark.eventLog.enabled": "true",
    "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false",
    "spark.eventLog.buffer.kb": "1k",
}


def settings(folder: str) -> dict[str, str]:
    return SETTINGS | {"spark.eventLog.dir": f"file://{folder}"}


def _events(spark):
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    folder = sc.getConf().get("spark.eventLog.dir").removeprefix("file://")
    for name in sorted(os.listdir(folder)):
        if name.startswith(sc.applicationId):
            with open(os.path.join(folder, name), errors="replace") as log:
                for line in log:
                    try:
                        yield json.loads(line)
                    except ValueError:  # the line that is being written
                        continue


def measure(spark, query) -> dict[str, float]:
    """Runs ``query()`` and returns what its tasks read and shuffled."""
    seen = sum(1 for _ in _events(spark))
    query()
    out = {"records_read": 0, "shuffle_records": 0, "shuffle_mb": 0.0, "tasks": 0}
    for i, e in enumerate(_events(spark)):
        if i >= seen and e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m = e["Task Metrics"]
            out["tasks"] += 1
            out["records_read"] += m["Input Metrics"]["Records Read"]
            out["shuffle_records"] += m["Shuffle Write Metrics"]["Shuffle Records Written"]
            out["shuffle_mb"] += m["Shuffle Write Metrics"]["Shuffle Bytes Written"] / 1e6
    return out


def stage_bytes(spark, query) -> dict[int, list[int]]:
    """Runs ``query()`` and returns the shuffle bytes that each task of each of its stages wrote."""
    seen = sum(1 for _ in _events(spark))
    query()
    out: dict[int, list[int]] = {}
    for i, e in enumerate(_events(spark)):
        if i >= seen and e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            out.setdefault(e["Stage ID"], []).append(e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"])
    return out
