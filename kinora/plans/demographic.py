"""Recommendations from users with the same profile."""

from pyspark.sql import functions as F

from kinora.operators.topk import top_k, top_unseen
from kinora.session import stored

TOP_ITEMS = 10
RANK_DIGITS = 9


def _requests(profiles, attributes):
    """``uid, list_key``, once each.  The key names every attribute with its value, so different profiles never share
    one; a missing value is a value of its own.
    """
    key = F.to_json(F.struct(*attributes), {"ignoreNullFields": "false"})
    return profiles.select("uid", key.alias("list_key")).distinct()


def popular_by_profile(profiles, ratings, attributes):
    """Rating count and mean per profile group and movie."""
    keyed = _requests(profiles, attributes)
    per_user = ratings.groupBy("uid", "mid").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("total"))
    return (
        per_user.join(keyed, "uid")
        .groupBy("list_key", F.col("mid").alias("item"))
        .agg(F.sum("n").alias("n_ratings"), (F.sum("total") / F.sum("n")).alias("avg"))
    )


def recommend(profiles, ratings, attributes, k=TOP_ITEMS):
    """Items most rated (then best rated) in the user's profile group that the user has not rated."""
    popular = stored(
        ratings.sparkSession, popular_by_profile(profiles, ratings, attributes), "profile-popularity"
    )
    order = [F.col("n_ratings").desc(), F.round("avg", RANK_DIGITS).desc(), F.col("item").asc()]

    def prefix(n, keys):
        return top_k(popular.join(keys, "list_key", "left_semi"), ["list_key"], order, n, rank="place").drop("place")

    requests = _requests(profiles, attributes)
    seen = ratings.select("uid", F.col("mid").alias("item"))
    found = top_unseen(requests, prefix, seen, order, k)
    return found.select("uid", "rank", F.col("item").alias("mid"), "n_ratings", "avg")
