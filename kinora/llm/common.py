"""Shared helpers of the training-data operators."""

import sys
import types

from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from kinora.session import scratch_path

LEAST_LONG = -(2**63)


def read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def keyed_text(df, key="doc_id", text="text"):
    """Only the key (long) and the text (null: empty), under fixed names."""
    return df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def stored(spark, df, name, compression="zstd", files=None):
    """Write once to the shared folder and read back: cuts the lineage and survives lost executors.

    ``files``: most tasks of the write, for tables known to be small.
    """
    path = scratch_path(spark, name)
    (df.coalesce(files) if files else df).write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark):
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def range_buckets(df, key, count):
    """Column expression source for ordered buckets: ``df`` with ``bucket``, ascending in ``key`` (null: lowest).

    Boundaries are quantiles of the key column alone (``count`` values reach the driver); the bucket of a row is found
    by binary search.  Rows with equal keys share a bucket.
    """
    position = F.coalesce(F.col(key), F.lit(LEAST_LONG)).cast("double")
    keys = df.select(position.alias("at"))
    cuts = keys.approxQuantile("at", [i / count for i in range(1, count)], 1 / (4 * count)) if count > 1 else []
    splits = [-float("inf"), *sorted({c for c in cuts}), float("inf")]
    if len(splits) == 2:
        return df.withColumn("bucket", F.lit(0))
    bucketizer = Bucketizer(splits=splits, inputCol="_at", outputCol="_bucket")
    return (
        bucketizer.transform(df.withColumn("_at", position))
        .withColumn("bucket", F.col("_bucket").cast("int"))
        .drop("_at", "_bucket")
    )


def once_per_worker(name, build, version=None):
    """What ``build`` returns, kept for the later tasks of a reused Python worker (models, caches of bounded size).

    A worker keeps one such thing: what an earlier stage left there goes.
    """
    kept = sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache")).__dict__
    if kept.get("held", (None,))[0] != (name, version):
        kept["held"] = (None, None)  # goes before its successor is built
        kept["held"] = ((name, version), build())
    return kept["held"][1]


class Recent(dict):
    """Cache of about the ``most`` newest entries: ``get_or_make`` of the keys in use keeps them, others go in time.

    Entries live in two generations; the older one is dropped when the younger one is full.
    """

    def __init__(self, make, most):
        super().__init__()
        self.make, self.half, self.old = make, most // 2, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def trim(self):
        """Call between batches: a batch's own entries are never dropped under it."""
        if len(self) > self.half:
            self.old = dict(self)
            self.clear()
