"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS] and print one JSON line.

Each query is timed from building its DataFrame (which includes any files it writes) to a full materialisation
through the ``noop`` sink (every row computed, nothing collected to the driver). One warm-up query runs first so
JVM start-up and class loading are not charged to the first query. Remembered size checks and table listings are
dropped before each query, so each pays for its own; the sales drop that several queries read is timed by itself.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tillgrid.operators import sizing  # noqa: E402
from tillgrid.plans import catalog, roundtrips  # noqa: E402
from tillgrid.session import local_session  # noqa: E402
from tillgrid.sources import tables  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="bench")

    # Warm-up (not timed): JIT, class loading, file-system caches.
    catalog.QUERIES["sales_incentive"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    t0 = time.perf_counter()
    roundtrips.sales_drop(spark, sf_dir)
    times: dict[str, float] = {"write_sales_drop": round(time.perf_counter() - t0, 3)}
    for name, fn in catalog.QUERIES.items():
        if only and name not in only:
            continue
        sizing.forget_verdicts()
        tables.forget_reads()
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    sf = Path(sf_dir).name.removeprefix("sf")
    try:
        sf_value: float | str = float(sf)
    except ValueError:
        sf_value = sf
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_value,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
