"""Times the headline queries: warm median of three runs each, one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from railtempo.plans.queries import QUERIES
from railtempo.session import local_session

HEADLINE = [
    "line_report",
    "delay_stats_global",
    "delay_stats_by_line",
    "delay_stats_by_date",
    "delay_stats_weekly",
    "line_common_times",
    "preset_month_stats",
    "live_board",
    "trip_text_labels",
    "feed_freshness",
    "service_day_trips",
    "corridor_trips",
    "corridor_trips_multi",
    "schedule_load",
    "siri_station_fold",
    "trip_update_build",
    "update_fold",
    "feed_counters",
    "gtfs_rt_updates",
    "trips_upsert",
    "stream_daily_delay",
    "stream_update_fold",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times = {}
    for name in HEADLINE:
        seconds = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - begin)
        times[name] = round(statistics.median(seconds[1:]), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline queries, warm median",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
