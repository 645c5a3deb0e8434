"""Time the headline queries; print one JSON line.

Each query is written to a sink that keeps nothing, twice; the second time counts, so
that code generation is not measured.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strata.queries import all_queries  # noqa: E402
from strata.session import build_session  # noqa: E402

HEADLINE = [
    "gold_dimension",
    "gold_group_dimension",
    "timeline_slices",
    "interval_containment_join",
    "interval_sweep",
    "islands_collapse",
    "scd1_latest",
    "scd1_dedup_lineitem",
    "scd2_history",
    "scd2_track_columns",
    "scd2_active_flag",
    "cdc_snapshot_deletes",
    "cdc_snapshot_diff",
    "dq_quarantine_clean",
    "dq_quarantine_audit",
    "dq_rule_counts",
    "transform_sql_rules",
    "map_history_a",
    "landing_append_evolve",
    "stream_scd1",
    "metrics_layer_volume",
    "metrics_top_violations",
    "metrics_missing_dates",
    "extract_parse",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "bench", spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    runs = all_queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            runs[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
