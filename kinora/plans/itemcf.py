"""Item collaborative filtering by co-occurrence of ratings."""

from pyspark.sql import functions as F

from kinora.operators.pairs import pair_products
from kinora.operators.topk import to_nested
from kinora.session import stored

TOP_NEIGHBOURS = 10


def _inputs(ratings, distinct_users):
    # Pre-aggregation: repeated ratings of one user and movie become one weighted row.
    per_pair = ratings.groupBy("uid", "mid").agg(F.count(F.lit(1)).alias("n"))
    per_pair = stored(ratings.sparkSession, per_pair, "item-weights")
    weight = F.lit(1) if distinct_users else F.col("n")
    rows = per_pair.select(F.col("uid").alias("g"), F.col("mid").alias("e"), weight.alias("w"))
    return rows, rows.groupBy("e").agg(F.sum("w").alias("scale"))


def cooccurrence(ratings, distinct_users=False, **tuning):
    """(mid1, mid2, cocount, count1, count2, score) for every pair rated by a common user.

    Counts rating-row pairs by default (m and n repeats of two movies count m * n);
    ``distinct_users`` counts users.  score = cocount / sqrt(count1 * count2).
    """
    rows, counts = _inputs(ratings, distinct_users)
    return _named(pair_products(rows, counts, **tuning))


def summaries(ratings, distinct_users=False, **tuning):
    """Per movie, over all movies with a common user: (mid, n_neighbours, cocounts, best_cocount, mean_score).

    The pairs are summed up in the task that finds them and never shuffled or written.
    """
    return cooccurrence(ratings, distinct_users, **tuning).groupBy(F.col("mid1").alias("mid")).agg(
        F.count(F.lit(1)).alias("n_neighbours"),
        F.sum("cocount").alias("cocounts"),
        F.max("cocount").alias("best_cocount"),
        F.avg("score").alias("mean_score"),
    )


def _named(pairs):
    return pairs.select(
        F.col("e").cast("int").alias("mid1"),
        F.col("f").cast("int").alias("mid2"),
        F.col("dot").cast("long").alias("cocount"),
        F.col("e_scale").cast("long").alias("count1"),
        F.col("f_scale").cast("long").alias("count2"),
        "score",
        *([F.col("rank")] if "rank" in pairs.columns else []),
    )


def neighbours(ratings, k=TOP_NEIGHBOURS, distinct_users=False, **tuning):
    """The k most similar movies of each movie: (mid1, rank, mid2, score, ...)."""
    rows, counts = _inputs(ratings, distinct_users)
    return _named(pair_products(rows, counts, top_k=k, **tuning))


def neighbours_nested(ratings, k=TOP_NEIGHBOURS, **tuning):
    ranked = neighbours(ratings, k, **tuning).withColumnRenamed("mid1", "mid")
    return to_nested(ranked.select("mid", "mid2", "score", "rank"), "mid", item="mid2")
