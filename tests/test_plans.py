"""Properties of physical plans that must hold at any scale."""

import re

import pytest

from kinora.queries import QUERIES

LAZY = [
    "movie_rating_count", "monthly_hot_movies", "movie_avg_score", "genre_top10", "genre_top10_exploded",
    "item_cf_topk", "item_cooccurrence", "factor_similarity", "content_recs", "content_top20",
    "content_neighbour_counts", "rmse_join", "user_recent_ratings", "realtime_scores", "user_cf_recs",
    "keyword_search", "more_like_this", "user_item_candidates",
]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_joins(spark, sf, name):
    plan = _plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python


@pytest.mark.parametrize("name", ["genre_top10", "genre_top10_exploded", "user_recent_ratings"])
def test_top_k_is_cut_before_the_exchange(spark, sf, name):
    assert re.search(r"WindowGroupLimit .* Partial", _plan(QUERIES[name](spark, sf)))


def test_scans_read_only_what_is_needed(spark, sf):
    plan = _plan(QUERIES["movie_avg_score"](spark, sf))
    columns = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert columns and all("l_extendedprice" not in c and "o_totalprice" not in c for c in columns)
    assert "PushedFilters: [IsNotNull" in plan
