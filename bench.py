"""Time the headline queries; prints one JSON line.

Settings: BENCH_SF_DIR (scale folder), BENCH_CPUS (local cores). Every query is written to the
`noop` sink, so all its rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import time

import workload
from pagemark.session import local_session

HEADLINE = [
    "annotation_table",
    "topk_collapse",
    "drop_duplicates_first",
    "reading_order",
    "box_overlap",
    "page_tokens",
    "page_reconciliation",
    "decode_unk",
    "flat_to_bio",
    "fill_predictions",
    "fill_stats",
    "status_merge",
    "progress",
    "productivity",
    "class_report_flat",
    "class_report_bio",
    "class_report_averages",
    "page_metrics",
    "error_patterns",
    "kappa",
    "entity_spans",
    "sequence_scores",
    "calibration",
    "label_transitions",
    "by_case",
    "completion_audit",
    "duplicate_rows",
    "dataset_diff_by_key",
    "text_lines",
    "json_profile",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    known = workload.queries()
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    known["token_accuracy"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cores": cores,
            }
        )
    )


if __name__ == "__main__":
    main()
