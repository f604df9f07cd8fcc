"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Each
query runs from the raw inputs to its last row, written to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from jobweave.session import build_session  # noqa: E402
import jobweave.verify.all_queries  # noqa: E402,F401
from jobweave.verify.registry import QUERIES  # noqa: E402

HEADLINE = [
    "n1_stg_jobs",
    "n3_int_jobs_enriched",
    "n5_int_salary_estimates",
    "n6_int_company_duplicates",
    "n12_fct_job_posting_skills",
    "n14_mart_job_market_benchmarks",
    "n15_mart_salary_trends",
    "n16_mart_skill_demand",
    "n17_mart_company_hiring",
    "c5_skill_flag",
    "c6_skill_count",
    "d5_full_outer_measures",
    "d6_blocked_fuzzy_join",
    "f9_snapshot_number",
    "h3_unpivot_flags",
    "j3_pending",
    "l3_stream_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", int(cpus), {"spark.ui.enabled": "false", "spark.driver.memory": "20g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the executor threads and code generation before the clock runs.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
