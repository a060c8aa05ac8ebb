"""Time the headline queries; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "movie_rating_count", "monthly_hot_movies", "movie_avg_score", "genre_top10", "genre_top10_exploded",
    "item_cf_topk", "content_recs", "content_top20", "factor_similarity", "als_user_recs",
    "als_item_similarity", "rmse_join", "log_filter", "user_recent_ratings", "realtime_scores",
    "stream_recs_current", "user_cf_recs", "demographic_recs", "keyword_search", "more_like_this",
    "item_cooccurrence", "sim_candidates", "als_unseen_user_recs", "als_grid_rmse", "chain_recs_current",
    "keyword_search_index", "item_cooccurrence_incremental", "user_recent_ratings_expiring",
]


def main():
    from kinora.queries import QUERIES
    from kinora.session import build_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "kinora-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["movie_rating_count"](spark, sf).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
