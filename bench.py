"""Time the headline queries over whole tables; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores. Every row is produced and sent to a null sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from knownwhen.session import local_session
from verification.queries import QUERIES

HEADLINE = [
    "dedup_per_filing", "knowledge_intervals", "fact_revision", "fundamental_as_of",
    "asof_grid", "factor_input_asof", "roa_deciles", "bias_by_quarter", "scd2_build",
    "restatement_monitor", "inv_i3_no_gap", "inv_i6_seq_contiguous", "equivalence_check",
    "silver_num", "exclusion_funnel", "reconcile_layers", "concept_candidates",
    "coverage_by_quarter", "snapshot_diff", "snapshot_buckets",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores=cpus)
    names = sys.argv[1:] or HEADLINE
    run(spark, "knowledge_intervals", folder)  # JVM warm-up
    seconds = {name: round(min(run(spark, name, folder) for _ in range(2)), 3) for name in names}
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, best of two warm runs, summed",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus}))


if __name__ == "__main__":
    main()
