"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. Each query is run in full
into a sink that discards rows; the best of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.all import QUERIES  # noqa: E402
from gradeloom.session import local_session  # noqa: E402

HEADLINE = {
    "bac_rows": "year load: clean, derive, check",
    "en_rows": "8th-grade rows with placement",
    "school_rank": "ranking per year",
    "exact_match": "exact school match",
    "fuzzy_match": "school match by edit distance",
    "update_by_key": "keyed update",
    "upsert_by_key": "update or insert",
    "replace_year": "replace one stored year",
    "keep_first": "first row per key",
    "page_rows": "rows of web pages",
    "result_page_rows": "rows of result pages",
    "canonical_id": "identifiers of names and whole texts",
}


def seconds(spark, name: str, sf_dir: str) -> float:
    best = None
    for _ in range(2):
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        best = took if best is None else min(best, took)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    times = {name: seconds(spark, name, sf_dir) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
