"""Wall time of the headline queries; prints one JSON line.

The three tables that services share (requests, processed, postings) are timed as they are written, the
queries after one warm-up run each, best of two. Streams are timed once, listed apart and not part of the total.
"""

from __future__ import annotations

import json
import os
import time

from vaultflow.plans import catalog
from vaultflow.plans.pipeline import Pipeline
from vaultflow.session import build_session

HEADLINE = (
    "decode_requests", "dead_letters", "validation_verdicts", "dedup_requests", "request_dispositions",
    "ledger_postings", "ledger_with_transfers", "balances", "enriched", "enriched_asof", "activity_summary",
    "late_rows", "fraud_large_amount", "fraud_velocity", "fraud_travel", "fraud_money_mule", "fraud_alerts",
    "notifications", "recent_notifications",
)
# Streams run their table in three pieces, each with its own checkpoint; once is enough.
STREAMS = ("activity_summary_stream", "fraud_large_amount_stream", "fraud_velocity_stream", "fraud_travel_stream",
           "fraud_money_mule_stream", "enriched_stream")


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    pipeline = Pipeline.of(spark, sf_dir)
    seconds = {
        "write_requests": timed(lambda: pipeline.request_table),
        "write_processed": timed(lambda: pipeline.processed),
        "write_postings": timed(lambda: pipeline.postings),
    }
    for name in HEADLINE:
        query = catalog.QUERIES[name]

        def run(query=query) -> None:
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        if name not in ("ledger_with_transfers", "ledger_postings"):  # the ledger is warm from write_postings
            run()
        seconds[name] = min(timed(run), timed(run))
    streams = {}
    for name in STREAMS:
        streams[name] = timed(lambda name=name: catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in seconds.items()}, "streams": {k: round(v, 3) for k, v in streams.items()}, "sf": sf_dir.rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
