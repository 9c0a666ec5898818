"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores. Each query is run
once to warm the session and timed on a further run; the time includes building the
plan, all jobs it starts, and producing every output row.
"""

from __future__ import annotations

import json
import os
import time

from riskweave.plans.queries import QUERIES
from riskweave.session import build_session

HEADLINE = (
    "normalize_union",
    "explode_landed_pages",
    "parse_envelopes",
    "dedupe_first_serving",
    "dedupe_store",
    "account_history",
    "score_rules",
    "score_rules_heavy",
    "score_rules_orders",
    "flags_upserted",
    "flag_status_counts",
    "flags_per_rule",
    "evaluation",
    "features",
    "chrono_split",
    "review_queue_pending",
    "stream_ingest",
    "stream_score",
    "ml_metrics",
)
# Model training is timed once: its run is far longer than any warm-up effect.
ONCE = ("ml_metrics",)


def _run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        cores,
        **{"spark.sql.shuffle.partitions": cores, "spark.ui.showConsoleProgress": "false"},
    )
    seconds = {}
    for name in HEADLINE:
        if name not in ONCE:
            _run(spark, name, sf_dir)
        seconds[name] = round(_run(spark, name, sf_dir), 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cores": cores,
                "spark": spark.version,
                "rule_scorer_rows_per_sec": round(rows / seconds["score_rules"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
