"""Session helper and the shared scratch location."""

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app="kinora", master=None, **conf):
    """A session with the settings every plan here assumes; cluster values win when given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Cut ranked lists before the exchange for long prefixes too (default: up to 1000).
        "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark):
    """The cluster's shared folder from ``spark.checkpoint.dir``.

    A local session without one gets a fresh temporary folder.  On a cluster that would be another folder on every
    machine, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        check_local(spark.sparkContext.master)
        root = tempfile.mkdtemp(prefix="kinora-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def check_local(master):
    """Raise unless ``master`` runs driver and executors on one machine's own folders."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")


def release(spark, *paths):
    """Delete scratch folders (paths of :func:`scratch_path`) whose tables are no longer read."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def scratch_path(spark, name):
    """A new path under the shared folder; never reused between runs."""
    return os.path.join(shared_dir(spark), "kinora", f"{name}-{uuid.uuid4().hex}")


def stored(spark, df, name):
    """Write an intermediate result once to the shared folder and read it back.

    Used where a result is read by several jobs: it survives the loss of executors, and later reads
    prune columns.
    """
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
