"""Time every catalogue query; prints one JSON line.

Each query runs to a sink that discards its rows, so the whole result is computed
and nothing is collected. Untimed queries first load classes and Python workers.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelloom.plans.catalog import QUERIES  # noqa: E402
from panelloom.session import build_session  # noqa: E402


def main() -> None:
    """Run the queries named on the command line, or all of them."""
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.sql.shuffle.partitions": cpus,
            # The test tables are one small file each; smaller splits use all cores.
            "spark.sql.files.maxPartitionBytes": os.environ.get("BENCH_SPLIT", "128m"),
            # The tables are one row group each: texts are dealt to all cores first.
            "spark.panelloom.scanTasks": cpus,
            # Call-site capture slows plan building in Python.
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    names = sys.argv[1:] or list(QUERIES)
    for name in ("sql_view", "firm_year_attention", "html_to_text"):
        run(name)
    seconds = {name: run(name) for name in names}
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
