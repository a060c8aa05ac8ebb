"""Recommendations from a user's newest rating, as set operations over many users at once."""

from pyspark.sql import functions as F

from kinora.operators.similar import best_first
from kinora.operators.topk import to_nested, top_k, top_unseen

RECENT_RATINGS = 20
SIMILAR_MOVIES = 20
MIN_SIMILARITY = 0.7
LIKED_ABOVE = 3


def newest_first():
    return [F.col("timestamp").desc(), F.col("event_id").desc()]


def recent_ratings(events, k=RECENT_RATINGS):
    """Newest k ratings per user: (uid, rank, event_id, mid, score, timestamp)."""
    return top_k(events, ["uid"], newest_first(), k)


def candidates(triggers, similarity, seen, k=SIMILAR_MOVIES):
    """k most similar movies of each trigger (uid, mid) that the user has not rated.

    ``seen``: (uid, item) rows.  Rated movies are left out before the cut.  Result:
    (uid, mid, rank, item, score).
    """
    keyed = similarity.with_group(triggers.select("uid", "mid").distinct(), "mid", "list_key")
    requests = keyed.select("uid", "list_key").distinct()
    # One entry more than asked for: a group's list can hold the trigger movie itself.
    found = top_unseen(requests, similarity.prefix, seen, best_first(), k + 1).drop("rank")
    others = keyed.join(found, ["uid", "list_key"]).where(F.col("item") != F.col("mid"))
    return top_k(others, ["uid", "mid"], best_first(), k).select("uid", "mid", "rank", "item", "score")


def _log10(count):
    return F.ln(count) / F.ln(F.lit(10.0))


def scores(candidate_items, recents, similarity, min_score=MIN_SIMILARITY):
    """Score of each (uid, item) from the user's recent ratings (uid, mid, score).

    Mean of similarity * rating over the recents more similar than ``min_score``, plus log10 of the
    number of liked ones, minus log10 of the number of disliked ones.  Candidates without such a
    neighbour get no row.
    """
    wanted = similarity.with_group(candidate_items.select("uid", "item").distinct(), "item", "source")
    rated = similarity.with_group(
        recents.select("uid", "mid", F.col("score").alias("rating")), "mid", "target"
    )
    close = similarity.pairs.where(F.col("score") > min_score)
    terms = (
        wanted.join(rated, "uid")
        .where(F.col("item") != F.col("mid"))
        .join(close, ["source", "target"])
    )
    liked = F.count_if(F.col("rating") > LIKED_ABOVE)
    disliked = F.count_if(F.col("rating") <= LIKED_ABOVE)
    return terms.groupBy("uid", "item").agg(
        (
            F.avg(F.col("score") * F.col("rating"))
            + _log10(F.greatest(liked, F.lit(1)))
            - _log10(F.greatest(disliked, F.lit(1)))
        ).alias("score")
    )


def recommendations(triggers, recents, similarity, seen):
    """One row per triggering user: (uid, recs), best first; an empty list where nothing scores."""
    scored = scores(candidates(triggers, similarity, seen), recents, similarity)
    # At most SIMILAR_MOVIES entries per user, so the list is bounded.
    ranked = top_k(scored, ["uid"], best_first(), SIMILAR_MOVIES)
    lists = to_nested(ranked, "uid", item="item")
    empty = F.array().cast("array<struct<mid:int,score:double>>")
    return (
        triggers.select("uid").distinct().join(lists, "uid", "left")
        .select("uid", F.coalesce("recs", empty).alias("recs"))
    )
