"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS], print one JSON line.

Each query is executed to completion with the ``noop`` sink (the whole plan runs, nothing is
collected to the driver). Every query builds from the driver tables on its own; a small warm-up on
sf0.001 keeps JVM start-up and first-use compilation out of the timings.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roomledger.plans.catalog import queries  # noqa: E402
from roomledger.session import local_session  # noqa: E402

HEADLINE = (
    "silver_bookings",
    "fact_booking",
    "vw_booking_overview",
    "vw_booking_by_lead_time",
    "vw_booking_seasonality_hotel",
    "vw_booking_by_channel",
    "vw_room_match",
    "kpi_cards_sliced",
    "dq_report",
    "column_profile",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="roomledger-bench", **{"spark.sql.shuffle.partitions": str(cpus)})
    registry = queries()
    run(registry["vw_booking_overview"](spark, "/root/testdata/sf0.001"))
    timings = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(registry[name](spark, sf_dir))
        timings[name] = round(time.perf_counter() - start, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
