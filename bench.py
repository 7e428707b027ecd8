"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from precinct.catalog.queries import QUERIES  # noqa: E402
from precinct.catalog.views import table  # noqa: E402
from precinct.session import get_session  # noqa: E402

HEADLINE = [
    "incidents_built", "monthly_counts", "trend_3m", "area_measures", "population_fuzzy", "area_flagship", "areas_built",
    "meshblocks_built", "nearby_topk", "nearby_default", "filter_incidents_month", "validate_incidents_split", "upsert_snapshot",
    "metric_summary", "metric_p95_exclusive", "polygon_centroid", "ring_validity", "simplify_layer", "stream_monthly_counts",
    "full_build",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = get_session("precinct-bench", f"local[{cpus}]", {"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "area_flagship", sf_dir)  # warm-up: JVM start and code generation are not what is measured
    times = {}
    for name in names:
        times[name] = round(run(spark, name, sf_dir), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    out = {
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if "full_build" in times:
        incidents = table(spark, sf_dir, "orders").count()
        out["ingest_records_per_minute"] = round(incidents / times["full_build"] * 60)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
