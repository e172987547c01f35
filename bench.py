"""Wall-clock seconds of the headline queries, best of three; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the local
cores. Every query is built and run to its last row; one small query first warms
the session up.
"""

from __future__ import annotations

import json
import os
import sys
import time

from newsloom.session import local_session
from workload.queries import QUERIES

HEADLINE = (
    "canonical_urls", "publisher_domains", "content_hashes", "item_rows", "deduplicated_items", "dedupe_statistics",
    "first_items_per_feed", "topic_statistics", "daily_buckets", "representative_items", "topic_keywords",
    "topic_records", "score_breakdown", "top_topics", "feed_scan", "upserted_topics", "density_topics",
    "collected_items", "run_statistics", "text_topics",
)


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def best(spark, name: str, sf_dir: str, tries: int = 3) -> float:
    """The least of some timings: single ones vary by a third."""
    return min(timed(spark, name, sf_dir) for _ in range(tries))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS"))
    timed(spark, "items_per_feed", sf_dir)
    names = sys.argv[1:] or [name for name in HEADLINE if name in QUERIES]
    seconds = {name: best(spark, name, sf_dir) for name in names}
    total = round(sum(seconds.values()), 3)
    line = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir}
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
