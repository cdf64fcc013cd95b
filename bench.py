"""Wall seconds of the headline queries; prints one JSON line.

Each query is built, planned and run in full (to a sink that discards the rows). The
queries run in rounds; the first round warms the JVM up and is not counted, the value is
the median of the others.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from countypanel.plans import catalog  # noqa: E402
from countypanel.session import local_session  # noqa: E402

HEADLINE = [
    "share_long", "share_wide", "labor_wide", "labor_yearly", "county_year_panel",
    "statewide_trend_w", "expected_rate", "county_year_matrix_x", "extreme_counties_by_year",
    "ols_health", "income_tertiles", "income_alignment", "survey_health_expanded", "match_rate",
    "json_matrix_decode", "feature_explode", "labor_star", "written_survey_table", "written_panel",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "countypanel-bench")
    registered = catalog.registered()
    runs = {name: [] for name in HEADLINE}
    for _ in range(RUNS + 1):
        for name in HEADLINE:
            runs[name].append(seconds(lambda: registered[name](spark, folder)))
    times = {name: round(statistics.median(taken[1:]), 3) for name, taken in runs.items()}
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, sum of median warm wall seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
