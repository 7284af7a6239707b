"""Seconds per headline query; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores. Each query runs once, in full.
"""

from __future__ import annotations

import json
import os
import sys
import time

from docquarry.plans.catalog import QUERIES
from docquarry.session import local_session

HEADLINE = [
    "s2a_elements_from_text",
    "s2b_elements_from_html",
    "s8_upsert",
    "p3_tables_to_markdown",
    "p6_normalize",
    "p8_stage_counters",
    "k2_chunk_documents",
    "k2_chunk_elements",
    "k6_chunk_configs",
    "e6_points",
    "r2_top_k_cosine",
    "r4_filtered_top_k",
    "r5_batch_retrieval",
    "r5_batch_retrieval_own_file",
    "r7_approximate_top_k",
    "g5_many_models",
    "v9_qa_samples",
    "m2_token_set_ratio",
    "m7_retrieval_report",
    "m9_compare_configs",
    "a1_token_f1",
    "a5_evaluate_models",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    names = sys.argv[1:] or HEADLINE
    # Starts the Python workers and the scan code, so that no query pays for it.
    spark.range(8).mapInArrow(lambda batches: batches, "id long").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
