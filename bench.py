"""Headline queries at one scale; prints one JSON line.

Every query is written to the ``noop`` sink, so the whole result is computed and nothing is
collected. Each runs once to warm up and then ``BENCH_RUNS`` times (once if the first took over a minute); the best run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F

from maskloom.operators import leakscan
from maskloom.session import local_session
from maskloom.workload.queries import QUERIES, shop

NAMED = (
    "mask_customer mask_orders mask_lineitem redact_documents fake_contact_fields fake_bank_accounts fake_ibans "
    "fake_vat_numbers year_band_orders key_secret_drop page_content_policy scoped_replace shuffle_orders "
    "keyed_position leak_scan_passages leak_scan_passages_by_join leak_scan_names leak_scan_names_by_join coverage_scan "
    "infer_references join_consistency mapping_conflicts module_reconcile manifest_counts manifest_observed bundle_publish stream_mask_events stream_gated_events shuffle_deranged "
    "fake_accounts_bijective"
).split()


def leak_scan_of(count: int):
    """Documents scanned for ``count`` values: passages first, then customer numbers and pairs of words."""

    def run(spark, folder):
        data = shop(spark, folder, "documents", "customer", "benchmark")
        words = data["benchmark"].select(F.explode(F.split("text", r"\. ")).alias("v"))
        names = data["customer"].select(F.col("c_name").alias("v"))
        needles = data["benchmark"].select(F.col("text").alias("v")).unionByName(words).unionByName(names)
        chosen = needles.distinct().orderBy(F.md5("v")).limit(count)
        return leakscan.find_values(leakscan.cells({"documents": data["documents"]}), chosen)

    return run


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, app="maskloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries = {name: QUERIES[name] for name in NAMED}
    queries |= {f"leak_scan_{n}": leak_scan_of(n) for n in (10, 1000, 10000)}
    only = sys.argv[1:] or list(queries)
    seconds = {}
    for name in only:
        times = []
        for _ in range(runs + 1):
            if len(times) == 2 and times[0] > 60:
                break  # a minute each is steady enough
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:]), 3)
        print(f"{name} {[round(t, 2) for t in times]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds_of_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
