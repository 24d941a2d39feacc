"""Time the headline jobs on the data folder in $BENCH_SF_DIR and print one JSON line.

Every job starts at the given tables and ends in a sink that reads all rows and columns
(``noop``): one warm-up, then the median of three runs.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from roadlark.session import local_session  # noqa: E402

HEADLINES = {
    "parse_posts": "parse_all_fields",
    "forward_fill_time": "forward_fill_time",
    "classify_vehicles": "classify_vehicles",
    "direction_lookup": "direction_ids",
    "extract_posts": "extract_posts",
    "upsert_events": "upsert_events",
    "process_batch_events": "batch_events",
    "fact_flow": "fact_flow",
}
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores, **{"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    rows = spark.read.parquet(f"{folder}/events.parquet").count()
    seconds, jobs = {}, {}
    for label, name in HEADLINES.items():
        times = []
        for run in range(RUNS + 1):
            group = f"{label}-{run}"
            spark.sparkContext.setJobGroup(group, label)
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
            jobs[label] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        seconds[label] = round(statistics.median(times[1:]), 3)
    spark.stop()
    result = {
        "metric": "total_median_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "posts": rows,
        "posts_per_second": {k: round(rows / v) for k, v in seconds.items()},
        "spark_jobs": jobs,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
