"""Recommendations from similar users."""

from pyspark.sql import functions as F

from kinora.operators.pairs import pair_products
from kinora.operators.skew import salted_join
from kinora.operators.topk import top_k
from kinora.session import stored

TOP_USERS, TOP_ITEMS = 20, 10
RANK_DIGITS = 9


def _vectors(ratings):
    vectors = ratings.groupBy("uid", "mid").agg(F.avg("score").alias("w"))
    return stored(ratings.sparkSession, vectors, "user-vectors")


def _similar(vectors, k, **tuning):
    rows = vectors.select(F.col("mid").alias("g"), F.col("uid").alias("e"), "w")
    scales = vectors.groupBy(F.col("uid").alias("e")).agg(F.sum(F.col("w") * F.col("w")).alias("scale"))
    return pair_products(rows, scales, top_k=k, **tuning).select(
        F.col("e").cast("int").alias("uid"), "rank", F.col("f").cast("int").alias("other_uid"), "score"
    )


def similar_users(ratings, k=TOP_USERS, **tuning):
    """The k users with the closest rating vectors (cosine): (uid, rank, other_uid, score)."""
    return _similar(_vectors(ratings), k, **tuning)


def recommend(ratings, users=TOP_USERS, items=TOP_ITEMS, **tuning):
    """Unrated items by the similarity-weighted mean score of similar users: (uid, rank, mid, score)."""
    vectors = _vectors(ratings)
    near = _similar(vectors, users, **tuning).select(
        "uid", "other_uid", F.col("score").alias("closeness")
    )
    near = stored(ratings.sparkSession, near, "near-users")
    rated = vectors.select(F.col("uid").alias("other_uid"), "mid", "w")
    closeness = F.col("closeness")
    # Somebody may be near to a large part of all users.
    votes = salted_join(near, rated, "other_uid").groupBy("uid", "mid").agg(
        F.try_divide(F.sum(closeness * F.col("w")), F.sum(closeness)).alias("score")
    ).where(F.col("score").isNotNull())
    unseen = votes.join(vectors.select("uid", "mid"), ["uid", "mid"], "left_anti")
    order = [F.round("score", RANK_DIGITS).desc(), F.col("mid").asc()]
    return top_k(unseen, ["uid"], order, items).select("uid", "rank", "mid", "score")
