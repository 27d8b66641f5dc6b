"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Each query runs
once, to its full result, after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from leadmill import catalog  # noqa: E402
from leadmill.session import local_session  # noqa: E402

HEADLINE = [
    "a2_group_sum", "a3_group_unique", "a5_group_median", "a6_group_agg", "a9_totals", "a11_pivot_group", "o2_drop_duplicates",
    "o6_top_row_per_group", "b2_bins", "b3_split_amounts", "b5_deal_velocity", "t1_website_domain", "n1_clean_names",
    "g1_standardise_country", "l2_job_function", "m1_touch_by_stage", "m2_members_with_opportunities", "m3_by_stage_pivoted",
    "o4_top_channels_by_value", "j4_blocking", "j5_sorted_neighbourhood", "c1_bigram_cosine", "k1_link_provider",
    "k1_link_names", "k5_old_matcher", "k6_potential_matches",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    queries = catalog.runners()

    def run(name: str) -> float:
        started = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    run("a1_group_count")
    took = {name: run(name) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
