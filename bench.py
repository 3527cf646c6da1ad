"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pressmill import queries  # noqa: E402
from pressmill.session import build_session  # noqa: E402

HEADLINE = ["weekly_top_items", "keyword_match", "heuristic_score", "final_score", "top_per_source", "week_window",
            "source_caps", "merge_stored_wins", "remember_and_prune", "sentiment_levels", "media_distributions",
            "media_context", "one_per_outlet", "source_performance", "weak_sources", "coder_agreement",
            "evidence_integrity", "single_place", "usage_totals", "funding_job", "feed_job", "listing_job",
            "similar_titles", "deduplicated", "topic_clusters", "balanced_selection", "call_drafts", "media_collection",
            "batch_budget_cut", "budget_fit"]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus), **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in HEADLINE:
        start = time.time()
        queries.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "headline queries, total seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
