"""Times the headline queries; prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemerge.queries import QUERIES  # noqa: E402
from tidemerge.session import build_session  # noqa: E402

HEADLINE = [
    "scan_time_range", "scan_since_watermark", "table_inventory", "parse_event_time", "payload_hash",
    "normalize_messages", "normalize_statuses", "normalize_contacts", "dedupe_first",
    "merge_insert_only", "merge_update_columns", "merge_update_all", "insert_returning_stats",
    "load_messages_raw", "load_statuses_raw", "load_contacts_snapshots",
    "plan_load_mode", "chunk_row_counts", "reconcile_keys", "orphan_status_events", "dup_messages",
    "view_message_volume_daily", "view_status_funnel_daily", "view_contact_snapshots_daily",
    "view_sanity_snapshot", "view_sanity_trend_30d", "card_message_volume", "card_delivery_funnel",
    "sync_state_update", "transfer_run_log", "sync_status_report",
    "stream_ingest_statuses", "stream_dedupe_events", "stream_volume_daily",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("card_message_volume")  # start the JVM and its code caches
    times = {name: round(min(run(name), run(name)), 3) for name in HEADLINE}
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
