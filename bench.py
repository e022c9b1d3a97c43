"""Time the registered queries: one warm-up, then the median of BENCH_REPEAT runs each. Prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the local cores, BENCH_QUERIES (comma separated) a selection.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.registry import queries  # noqa: E402
from touchline.session import local_session  # noqa: E402

def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    found = queries()
    names = chosen or list(found)
    seconds = {}
    for name in names:
        timed(found[name], spark, sf_dir)
        seconds[name] = round(statistics.median(timed(found[name], spark, sf_dir) for _ in range(repeat)), 4)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
