"""Time the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (full execution, no
collect to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from fieldcat.session import build_session  # noqa: E402
from fieldcat.plans.queries import QUERIES  # noqa: E402

HEADLINE = os.environ.get("BENCH_QUERIES")


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8))
    names = HEADLINE.split(",") if HEADLINE else list(QUERIES)
    # warm-up: JVM, parquet footers, codegen caches
    QUERIES["search_terms_pages"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, failed = {}, {}
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report and go on with the others
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_time", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
