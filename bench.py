"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from acceptance import registry  # noqa: E402
from voltrail.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))

# Read-only queries: median of the last five of seven runs.
REPEATED = (
    "vehicle_daily_summary",
    "charging_behavior_analysis",
    "driving_mode_analysis",
    "clean_telemetry",
    "row_count_audit",
    "table_stats",
    "event_envelope_parse",
    "member_path_check",
    "content_digests",
    "aes_roundtrip",
)
# Queries that write tables or files: one warm-up, then one timed run.
WRITING = (
    "ctas_partitioned_daily",
    "refreshed_daily_summary",
    "ingest_job",
    "stream_file_ingest",
    "archive_listing",
    "archive_extract_all",
    "archive_integrity",
    "archive_pack_roundtrip",
    "compressed_export_roundtrip",
)


def run_once(query, spark) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session(
        "voltrail-bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    seconds = {}
    for names, runs, kept in ((REPEATED, 7, 5), (WRITING, 2, 1)):
        for name in names:
            times = [run_once(queries[name], spark) for _ in range(runs)]
            seconds[name] = round(statistics.median(times[-kept:]), 4)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
