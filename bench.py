"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tickharbor import build_session  # noqa: E402
from tickharbor.plans import queries  # noqa: E402

HEADLINE = [
    "parse_all_venues", "market_events", "message_counts", "latency_histogram", "sequence_check", "first_arrivals",
    "connection_sessions", "stale_periods", "rotation_files", "parse_error_minutes", "configured_events",
    "trade_fills", "current_book", "verify_uploads", "q03_reconnects_5m", "q05_pings_sent_rate", "q07_orderbook_rate",
    "q14_latency_p95", "q24_upload_p95", "q26_cpu_usage", "message_counter_rate",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    run = queries()
    spark.read.parquet(f"{folder}/events.parquet").count()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        run[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(folder).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
