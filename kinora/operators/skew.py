"""Equi joins in which a few keys hold a large part of the rows."""

from pyspark.sql import functions as F

from kinora.session import stored

#: Rows of a key that one task joins; at least the MOST_HOT-th part of all rows.
ROWS_PER_KEY = 50_000
MOST_HOT = 100_000


def salted_join(left, right, key, rows_per_key=ROWS_PER_KEY):
    """``left`` inner-joined with ``right`` on ``key``, a key's rows of ``left`` spread over as many tasks as they need.

    The rows of ``right`` of such a key are copied to each of them.  Hot keys number at most MOST_HOT, since each holds more
    than that share of all rows, which bounds the table that is sent to all tasks.  ``left`` is read twice: pass a stored table.
    """
    spark = left.sparkSession
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_per_key)
    limit = max(rows_per_key, left.count() // MOST_HOT)
    hot = counts.where(F.col("n") > limit).select(key, F.ceil(F.col("n") / limit).cast("int").alias("_salts"))
    hot = F.broadcast(stored(spark, hot, "hot-keys"))
    others = [c for c in left.columns if c != key]
    spread = F.pmod(F.xxhash64(*others), F.col("_salts")) if others else F.lit(0)
    dealt = left.join(hot, key, "left").withColumn("_salt", F.coalesce(spread, F.lit(0)).cast("int")).drop("_salts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias("_salt")
    copied = right.join(hot, key, "left").select(*right.columns, copies)
    return dealt.join(copied, [key, "_salt"]).drop("_salt")
