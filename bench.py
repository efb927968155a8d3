"""Headline queries, timed to full results. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from affinora import catalog  # noqa: E402
from affinora.session import local_session  # noqa: E402

HEADLINE = [
    "fbt_rules", "fbt_rules_item", "fbt_flagship", "fbt_co_view_rules", "fbt_fallback", "fbt_final_lists", "fbt_country_text", "fbt_subset_backfill",
    "industry_over_index_view", "industry_over_index_order", "industry_top_items",
    "key_mapping", "active_items", "base_items", "proxy_high_value", "proxy_bulk", "proxy_ratings", "proxy_design_complexity", "all_features",
    "items_dataset", "users_dataset", "interactions_dataset", "popularity_count", "item_to_item", "stratified_user_sample",
    "product_configs", "clean_configs", "color_features", "text_embedding", "config_embeddings",
    "similar_pairs", "rank_substitutes", "precision_at_k", "vector_search",
    "merge_upsert", "merge_changed_rows", "check_duplicates", "events_per_window", "idle_windows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("OFF")
    queries = catalog.queries()
    spark.read.parquet(f"{sf_dir}/part.parquet").count()
    times: dict[str, float] = {}
    for name in names.split(",") if names else HEADLINE:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
        spark.catalog.clearCache()
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
