"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. A query is timed up to three times, as long as its runs
together stay under REPEAT_UNDER seconds; its median counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

from shelfwright.plans.registry import load_all
from shelfwright.session import build_session

REPEAT_UNDER = 6.0

HEADLINE = [
    # the thirteen consumer queries: search, lookups, joins, pages, counts, products by category
    "search_term", "search_and", "search_fields", "lookup_by_id", "lookup_by_fk", "like_prefix",
    "join_owner", "join_owner_2", "page_1", "page_5", "category_counts", "format_counts",
    "products_by_category",
    # conforming, references, rules
    "join_bridge_category", "explode_children", "alias_normalise", "generated_keys", "dangling_composite",
    "duplicate_in_list", "duplicate_id_pairs", "nearest_term", "marker_lines", "nested_url_extract",
    "findings_tiered", "verdict_counts",
    # changes, lineage, index, reports
    "snapshot_diff", "apply_changes", "child_replace", "assign_ids", "lineage_depth", "lineage_cycles",
    "search_index_terms", "search_stemmed", "index_maintenance", "freshness_summary",
    "coverage_by_format", "link_health", "cache_latest", "translation_stats",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "shelfwright-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = load_all()
    for name in ("row_counts", "join_owner", "duplicate_id_pairs"):  # warm-up: scans, joins, Python workers
        registry[name](spark, folder).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        runs: list[float] = []
        while len(runs) < 3 and sum(runs) < REPEAT_UNDER:
            start = time.perf_counter()
            registry[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(median(runs), 3)
        print(f"{name} {times[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
