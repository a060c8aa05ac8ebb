"""Item similarity as a table: flat, or factored into groups of identical items."""

from pyspark.sql import functions as F

from kinora.operators.topk import top_k
from kinora.session import stored

RANK_DIGITS = 9


def best_first(score="score", item="item"):
    return [F.round(score, RANK_DIGITS).desc(), F.col(item).asc()]


class ItemSimilarity:
    """Similarity lists ``source -> (target, score)``.

    Flat form: sources and targets are items.  Factored form: they are groups of items that share
    all their neighbours, with ``members`` (mid, source) naming the items of each group.  The
    factored form holds the same lists without writing out every pair: n copies of one item are one
    row instead of n * n.  A group with several members lists itself.
    """

    def __init__(self, pairs, members=None, groups=None):
        self.pairs = pairs
        self.members = members
        # The members again, dealt out by source where the tables are stored so.
        self.groups = members if groups is None else groups

    def store(self):
        """Write the tables to the shared folder, for use by several jobs or micro-batches."""
        spark = self.pairs.sparkSession
        members = None if self.members is None else stored(spark, self.members, "similarity-members")
        return ItemSimilarity(stored(spark, self.pairs, "similarity-pairs"), members)

    def with_group(self, df, item, group):
        """Add the list key of an item column; items unknown to the table drop out."""
        if self.members is None:
            return df.withColumn(group, F.col(item))
        named = self.members.select(F.col("mid").alias(item), F.col("source").alias(group))
        return df.join(named, item)

    def prefix(self, n, keys):
        """First n entries of the lists of ``keys``, best first: (list_key, item, score)."""
        wanted = self.pairs.join(keys.select(F.col("list_key").alias("source")), "source", "left_semi")
        if self.members is None:
            entries = wanted.withColumnRenamed("target", "item")
        else:
            # A group is named by its smallest member, so at most n - 1 groups stand before one that has an entry among
            # the first n: the cut comes before the members.
            wanted = top_k(wanted, ["source"], best_first(item="target"), n, rank="place").drop("place")
            # Members tie on score and rank by id, so n members of a group are enough for any list.
            short = top_k(
                self.groups.select(F.col("source").alias("target"), F.col("mid").alias("item")),
                ["target"], [F.col("item").asc()], n, rank="place",
            ).drop("place")
            entries = wanted.join(short, "target")
        return top_k(entries, ["source"], best_first(), n, rank="place").select(
            F.col("source").alias("list_key"), "item", "score"
        )

    def neighbours(self, k):
        """The k best neighbours of every item: (mid, rank, other_mid, score)."""
        if self.members is None:
            return top_k(self.pairs, ["source"], best_first(item="target"), k).select(
                F.col("source").alias("mid"), "rank", F.col("target").alias("other_mid"), "score"
            )
        keys = self.pairs.select(F.col("source").alias("list_key")).distinct()
        # One list of k + 1 entries per group; each member takes the first k that are not itself.
        entry = F.struct((-F.round("score", RANK_DIGITS)).alias("key"), "item", "score")
        lists = self.prefix(k + 1, keys).groupBy("list_key").agg(
            F.array_sort(F.collect_list(entry)).alias("entries")
        )
        own = self.members.join(lists, F.col("source") == F.col("list_key"))
        others = F.slice(F.filter("entries", lambda x: x["item"] != F.col("mid")), 1, k)
        return own.select("mid", F.posexplode(others).alias("pos", "x")).select(
            "mid", (F.col("pos") + 1).alias("rank"), F.col("x.item").alias("other_mid"), F.col("x.score").alias("score")
        )

    def neighbour_counts(self):
        """Per item: number of neighbours and their mean score, without listing them."""
        if self.members is None:
            sized = self.pairs.groupBy(F.col("source").alias("mid"))
            return sized.agg(F.count(F.lit(1)).alias("n_neighbours"), F.avg("score").alias("mean_score"))
        sizes = self.members.groupBy(F.col("source").alias("target")).agg(F.count(F.lit(1)).alias("n"))
        own = F.col("source") == F.col("target")
        n, total = F.col("n") - F.when(own, 1).otherwise(0), F.col("score")
        per_group = (
            self.pairs.join(sizes, "target")
            .groupBy("source")
            .agg(F.sum(n).alias("n_neighbours"), F.sum(n * total).alias("total"))
        )
        return self.members.join(per_group, "source").select(
            "mid", "n_neighbours", (F.col("total") / F.col("n_neighbours")).alias("mean_score")
        )

    def neighbours_of(self, items):
        """Full, uncapped lists of the given items (mid): (mid, other_mid, score).

        The output is as long as the lists are; use it for the items that are looked at.
        """
        keyed = self.with_group(items.select("mid"), "mid", "source").join(self.pairs, "source")
        if self.members is None:
            return keyed.select("mid", F.col("target").alias("other_mid"), "score")
        named = self.members.select(F.col("source").alias("target"), F.col("mid").alias("other_mid"))
        return keyed.join(named, "target").where(F.col("mid") != F.col("other_mid")).select(
            "mid", "other_mid", "score"
        )
