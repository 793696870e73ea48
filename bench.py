"""Times every registered query and prints one JSON line.

A query is timed from building its plan to having all rows computed (``noop``
sink), so result transfer to Python is not part of it.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vacancylens.session import local_session  # noqa: E402
from vacancylens.workload.queries import QUERIES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    only = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench", **{"spark.sql.shuffle.partitions": cpus})
    # Start the JVM's code paths and the file system before the first timing.
    for name in ("technology_share", "page_keywords_nested"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in only or QUERIES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
