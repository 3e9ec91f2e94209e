"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the no-op sink (every row produced, nothing
collected). Prints one JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from avisflow.registry import QUERIES  # noqa: E402
from avisflow.session import get_session  # noqa: E402

HEADLINE = [
    "stg_reviews", "reviews_enriched", "fact_reviews", "dim_bank", "dim_branch", "dim_location", "dim_sentiment",
    "branch_performance", "customer_insights", "sentiment_trends", "topic_analysis",
    "quality_metrics", "dq_relationships",
    "sentiment_lexicon_score", "language_ngram", "tfidf_terms", "topic_category_match",
    "agency_urls", "page_field_extract", "lda_topics", "topic_assignment",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)
    # warm-up: JVM, codegen caches and the file listing of the inputs
    QUERIES["dim_bank"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float | None] = {}
    failed = []
    for name in names:
        t0 = time.perf_counter()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - report the failure, keep measuring the rest
            times[name] = None
            failed.append(name)
            print(f"# {name}: FAILED {type(exc).__name__}: {str(exc)[:300]}", file=sys.stderr, flush=True)
            continue
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_sec", "value": round(sum(v for v in times.values() if v is not None), 3),
           "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
