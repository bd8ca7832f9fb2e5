"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Results go to the no-op sink, so the time covers the whole query and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from airlake import build_session  # noqa: E402
from airlake.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "latest_wins_dedupe", "hourly_grid_gaps", "aqi_hourly", "zone_hourly_median", "city_daily",
    "rolling_24h", "lag_family", "same_hour_7d", "locf_last_valid", "feed_status", "station_status",
    "fires_located", "fires_sector_rolling", "upwind_sector_sum", "median_unbounded_groups",
    "features_train", "features_live", "forecast_accuracy", "accuracy_windows", "skill_by_horizon",
    "monthly_folds", "drift_ks", "colocated_pairs", "log_report", "semi_chosen", "alert_throttle",
    "stream_hourly_window",
)


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),  # one machine: its own folder is the shared one
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["latest_wins_dedupe"](spark, base).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(base).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
