"""Benchmark: time the registered queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query runs to completion through the no-op sink (every row computed, none
collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelle.plans.catalog import load_all  # noqa: E402
from parcelle.session import get_spark  # noqa: E402

def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:] if not a.startswith("-")]
    extra = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"}
    eventlog = os.environ.get("BENCH_EVENTLOG_DIR")  # e.g. a fresh `mktemp -d` folder
    if eventlog:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": eventlog})
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, extra=extra)
    # JVM and code-generation warm-up on the smallest data set, not timed.
    spark.range(1000).selectExpr("sum(id)").collect()
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        load_all()["price_stats"].fn(spark, warm).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name, q in load_all().items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        spark.sparkContext.setJobGroup(name, name)
        try:
            q.fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
           "queries": timings, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "n_queries": len(timings)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
