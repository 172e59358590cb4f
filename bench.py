"""Times every catalog query and prints one JSON line."""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from paperloom.plans.catalog import QUERIES  # noqa: E402
from paperloom.session import local_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "paperloom-bench")
    only = sys.argv[1:]
    # The JVM starts outside the timings.
    spark.read.parquet(f"{folder}/region.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        started = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
