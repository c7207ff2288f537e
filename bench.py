"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected), after an untimed warm-up on the smallest tables (JVM JIT).  ``BENCH_QUERIES=all`` runs the whole catalog;
``BENCH_QUERIES=a,b`` a chosen list.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "pref_quality_report",
    "pref_validate_lines",
    "chat_validate_lines",
    "toolcalls_build",
    "rejected_distribution",
    "exact_split_pairs",
    "hash_split_pairs",
    "output_scores",
    "model_summary",
    "model_compare_detail",
    "char_vocab",
    "encode_decode_roundtrip",
    "token_length_stats",
    "next_token_pairs",
    "context_blocks",
    "packing",
    "token_cross_entropy",
    "temperature_topk",
    "loss_table",
    "loss_deltas",
    "gpu_cost_rollup",
    "dpo_loss",
    "chat_render",
    "label_mask",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from ptloom.plans.catalog import QUERIES
    from ptloom.session import local_session

    sel = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if sel == "all" else ([s for s in sel.split(",") if s] or HEADLINE)
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")),
                          app="ptloom-bench")
    # untimed warm-up: session start, file listing, code generation and JIT of the
    # validator code paths, by running the flagship once on the smallest tables
    # (set BENCH_WARMUP_DIR= to an empty value to skip it)
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm):
        QUERIES["pref_quality_report"](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    spark.stop()
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
