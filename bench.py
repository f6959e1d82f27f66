"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pagemill.plans.queries import QUERIES  # noqa: E402
from pagemill.plans.streams import STREAMS  # noqa: E402
from pagemill.session import build_session  # noqa: E402

HEADLINE = [
    "page_ordinals",
    "page_requests",
    "request_sizes",
    "page_batches",
    "page_batches_mixed",
    "batch_members",
    "page_batches_by_count",
    "batch_round_trip",
    "message_keys",
    "raw_dead_letters",
    "latest_state",
    "skip_done",
    "register_absent",
    "state_lookup",
    "decode_round_trip",
    "ocr_pages",
    "outcome_counts",
    "proc_time_histogram",
    "in_flight_series",
    "clean_text",
    "normalized_text",
    "tokens",
    "kept_docs",
    "entity_expansion",
    "doc_metadata",
    "stream_message_keys",
    "stream_carried_batches",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        # One machine: many tiny listing tasks only cost time.
        spark__sql__sources__parallelPartitionDiscovery__parallelism="32",
    )
    spark.sparkContext.setLogLevel("ERROR")
    every = {**QUERIES, **STREAMS}
    # Start the JVM's and Python's workers before the clock does.
    every["page_batches"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        every[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    pages = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "pages": pages,
                "pages_per_second": {
                    name: round(pages / seconds[name])
                    for name in ("page_requests", "page_batches", "batch_round_trip", "ocr_pages")
                },
            }
        )
    )


if __name__ == "__main__":
    main()
