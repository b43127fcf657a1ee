"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "collapse_profiles",
    "blocks_default",
    "candidate_pairs",
    "pair_features",
    "connected_components",
    "inference_summary",
    "document_components",
    "average_linkage",
    "linkage_sweep",
    "priority_chunks",
    "time_gaps",
    "describe_lines",
    "calibrate",
    "latency_p95",
    "probability_drift",
    "action_counts_stream",
]


def main() -> None:
    from checks import queries
    from checks.registry import QUERIES
    from kinfold.session import build_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()
    # Tables shared by several queries are written before the clock starts.
    shared = {"people": queries.people, "pairs": queries.fa_pairs, "scored": queries.fa_scored,
              "doc_tokens": queries.doc_tokens, "doc_pairs": queries.doc_pairs}
    times: dict[str, float] = {}
    for name, make in shared.items():
        start = time.perf_counter()
        make(spark, sf)
        times[f"prepare_{name}"] = round(time.perf_counter() - start, 3)
        print(f"prepare_{name}", times[f"prepare_{name}"], file=sys.stderr, flush=True)
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline queries", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf)}))


if __name__ == "__main__":
    main()
