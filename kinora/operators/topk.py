"""Ranking helpers: deterministic top-k, nested lists, top-k without already-seen items."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from kinora.session import stored


def top_k(df, keys, order, k, rank="rank"):
    """First k rows per key.

    ``order`` must end in a unique column so that ties are settled.  ``row_number() <= k`` is
    planned with a group limit before the exchange, so at most k rows per key leave each task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def to_nested(ranked, key, item="mid", score="score", rank="rank"):
    """Ranked rows (already cut to k per key) as ``key, recs: array<struct<mid, score>>``."""
    entry = F.struct(
        F.col(rank).alias("rank"),
        F.col(item).cast("int").alias("mid"),
        F.col(score).cast("double").alias("score"),
    )
    return (
        ranked.groupBy(key)
        .agg(F.array_sort(F.collect_list(entry)).alias("packed"))
        .select(
            key,
            F.transform("packed", lambda x: F.struct(x["mid"].alias("mid"), x["score"].alias("score"))).alias("recs"),
        )
    )


def from_nested(df, key, recs="recs"):
    """Inverse of :func:`to_nested`: ``key, mid, score`` rows."""
    return df.select(F.col(key).alias("owner"), F.inline(recs)).select(
        F.col("owner").alias(key), "mid", "score"
    )


def top_unseen(requests, prefix, seen, order, k, first=None, growth=8):
    """Best k list entries per request that the user has not seen.  Exact for any history length.

    ``requests``: distinct (uid, list_key).  ``seen``: (uid, item) rows.
    ``prefix(n, keys)`` gives the first n entries of the lists in ``keys`` as rows (list_key, item,
    ...) in the order ``order``.  A short prefix answers nearly every request; requests that still miss entries while
    their list goes on are asked again with a longer prefix, until none is left.
    """
    spark = requests.sparkSession
    length = first or 3 * k
    done = []
    pending = requests
    while True:
        # Read twice, for the answers and for the list lengths.
        entries = stored(spark, prefix(length, pending.select("list_key").distinct()), "prefix")
        sizes = entries.groupBy("list_key").agg(F.count(F.lit(1)).alias("length"))
        unseen = pending.join(entries, "list_key").join(seen, ["uid", "item"], "left_anti")
        # Stored: read more than once, and later rounds start from it.
        found = stored(spark, top_k(unseen, ["uid", "list_key"], order, k), "unseen")
        done.append(found)
        got = found.groupBy("uid", "list_key").agg(F.count(F.lit(1)).alias("got"))
        short = (
            pending.join(got, ["uid", "list_key"], "left")
            .where(F.coalesce("got", F.lit(0)) < k)
            .join(sizes.where(F.col("length") >= length), "list_key")
            .select("uid", "list_key")
        )
        short = stored(spark, short, "short")
        if short.isEmpty():
            break
        done[-1] = found.join(short, ["uid", "list_key"], "left_anti")
        # Only what the remaining users have seen is looked at again; k entries more than that are always enough.
        seen = stored(spark, seen.join(short.select("uid").distinct(), "uid", "left_semi").distinct(), "seen")
        most = seen.groupBy("uid").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        pending, length = short, min(length * growth, k + most)
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result
