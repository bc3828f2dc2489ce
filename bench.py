"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the
data and the cores. Each query is run once to warm up and then timed; the time
covers building the query and writing its whole result to a sink that drops it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from igarape.queries import QUERIES  # noqa: E402
from igarape.session import build_session  # noqa: E402

HEADLINE = [
    "gold_features",
    "annual_sums",
    "monthly_admissions",
    "quality_wide",
    "pivot_classes",
    "pivot_ratio_codes",
    "station_year_climate",
    "heat_days",
    "canonical_code_lookup",
    "classify_rules",
    "best_row_per_key",
    "dedupe_names_cumcount",
    "grid_header_detect",
    "strip_accents",
    "numbers_in_text",
    "parse_two_formats",
    "priority_panel",
    "goals_tracker",
    "driver_correlations",
    "sort_multi",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - started, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
