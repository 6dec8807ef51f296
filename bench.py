"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""
from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeproof.session import local_session  # noqa: E402
from queries import catalogue  # noqa: E402

# File trees are written by the query itself, so those are timed apart from the rest.
HEADLINE = [
    "inv_key_parse", "inv_new_rows", "inv_candidate_metrics", "candidate_upsert", "load_status_merge",
    "load_plan", "latest_n_partitions", "drift_verdict", "schema_type_report", "remediation_cast",
    "recon_partition_count", "recon_row_count", "recon_partition_set", "recon_checksum",
    "recon_checksum_all", "recon_checksum_strict", "recon_profile", "recon_profile_compare",
    "recon_verified", "recon_rollup", "recon_full", "object_diff", "object_verdict", "object_report",
    "checksum_sample", "sync_plan", "copy_units", "copy_pair_check", "copy_summary",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench", "16g")
    seconds = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            catalogue.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(scale.group(1)) if scale else folder}))


if __name__ == "__main__":
    main()
