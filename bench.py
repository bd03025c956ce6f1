"""Headline queries at one scale; prints one JSON line.

Each query runs from the test tables to its last row, including the pipeline
tables it needs on the way.  One untimed pass over a small query starts the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.session import apply_defaults  # noqa: E402
from workload import registry  # noqa: E402

HEADLINE = [
    "user_activity_rollup",
    "user_activity_merge",
    "ip_location_best_source",
    "ip_domain_obs_from_ranges",
    "ip_domain_scores",
    "device_domain_best",
    "company_activity",
    "enrich_activity",
    "prescoring_rollup",
    "prescoring_merge",
    "unique_urls",
    "scrape_queue",
    "pixel_user_activity",
    "pixel_prescoring",
    "lookup_candidates",
    "lookup_domain_obs",
    "normalize_location",
    "vendor_ip_domain_obs",
    "lead_dedupe_merge",
    "lead_prescoring",
    "campaign_topics",
    "email_prescoring",
    "scrape_results",
    "page_ngrams",
    "tag_brands",
    "title_input",
    "label_context",
    "combine_sources",
    "rolling_stats",
    "intent_score",
    "share_of_total",
    "upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    queries = registry.queries()
    queries["lookup_success"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
