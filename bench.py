"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once to warm up and then BENCH_RUNS times (default 3) into a noop
sink; the median counts.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from skygauge.operators import anomalies
from skygauge.session import build_session
from skygauge.suite import QUERIES
from skygauge.suite.inputs import EVENT_READINGS, air_quality

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "hourly_stats", "quartile_stats", "quartile_stats_sketch", "trim_exact",
    "anomalies_airquality", "anomalies_weather", "recent_anomalies",
    "refined_airquality", "refine_dedup", "payload_explode", "slugify_documents",
    "serve_page", "serve_ranked_page", "serve_date_range", "stream_airquality_landing",
]


def kernel(method, **options):
    """The anomaly kernel by itself."""
    def run(spark, sf_dir):
        return anomalies.detect_anomalies(
            air_quality(spark, sf_dir), EVENT_READINGS, method=method, **options)
    return run


COMPARED = {
    "kernel_exact": kernel("exact"),
    "kernel_sketch": kernel("sketch"),
    "kernel_refine": kernel("refine"),
    # A summary for the trim and one for the quartiles.
    "kernel_textbook": kernel("approximate", relative_error=0.01),
}


def seconds(run, spark) -> float:
    start = time.perf_counter()
    run(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "bench",
        spark__master=f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed = {name: QUERIES[name] for name in HEADLINE} | COMPARED
    results = {}
    for name, run in timed.items():
        seconds(run, spark)
        results[name] = round(statistics.median(seconds(run, spark) for _ in range(RUNS)), 3)
    headline = sum(results[name] for name in HEADLINE)
    found = re.search(r"sf([\d.]+)", SF_DIR)
    print(json.dumps({
        "metric": "headline queries, warm median, total",
        "value": round(headline, 3),
        "unit": "sec",
        "queries": results,
        "sf": float(found.group(1)) if found else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
