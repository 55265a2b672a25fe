"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from driftwell.plans import all_plans
from driftwell.session import local_session

HEADLINE = [
    "q4_range", "q9_fk_path_join", "q9_grouped_path_topk", "q12_count_rows_and_values", "q14_aggregate_passthrough",
    "q16_top_k", "q17_nested_result", "q19_spec_validation", "m3_update_many", "m5_upsert_rows", "m7_cascade_delete",
    "s1_frame_records", "s3_envelope_forms", "s8_command_log", "x2_unique_ingest_time", "x3_reassemble",
    "t7_type_widening", "t12_auto_increment_id", "n1_child_tables", "p3_cardinality", "p7_running_placement",
    "p8_final_placement", "i3_fd_mining_per_batch", "i4_inclusion_dependencies", "c1_insert_or_update",
    "c5_answered_gets", "c7_current_state", "c10_statements", "k1_relational_sink", "r7_ingest_event_table",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    plans = all_plans()
    spark.range(1000).groupBy("id").count().collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        plans[name][0](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/"))}))


if __name__ == "__main__":
    main()
