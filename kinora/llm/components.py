"""Connected components of a link table, by alternating stars (large-star, small-star); nothing reaches the driver.

Each round is two grouped minima and joins on the node; hubs are pre-aggregated before the shuffle and split by the
skew join.  Rounds grow with the logarithm of the component size.
"""

from pyspark.sql import functions as F

from kinora.llm.common import partitions, stored

#: Links per task of the small writes of a round.
ROWS_PER_FILE = 100_000


def components(links, a="a", b="b"):
    """``node, root``: every node that has a link, with the smallest node of its component.

    Self links, repeated links and either direction are fine; nulls are left out.
    """
    spark = links.sparkSession
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    edges = links.where(x.isNotNull() & y.isNotNull() & (x != y))
    edges = edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    edges = stored(spark, edges, "links")
    mark, files = None, max(1, min(partitions(spark), edges.count() // ROWS_PER_FILE))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(spark, both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "stars", files=files)
        # Large star: every larger neighbour goes to the smallest of the neighbourhood.
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(spark, large, "links", files=files)
        # Small star: the node and its smaller neighbours go to the smallest of them.
        low = stored(spark, large.groupBy("u").agg(F.min("v").alias("m")), "stars", files=files)
        moved = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(spark, moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links", files=files)
        was, mark = mark, edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if was == mark:
            break
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
