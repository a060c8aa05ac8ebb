"""Stored similarity tables: no shuffle on their side, versions replaced as a whole."""

import re

import pytest
from pyspark.sql import functions as F

from kinora.operators.similar import ItemSimilarity
from kinora.plans import content, realtime
from kinora.sources import fixtures as fx
from kinora.streaming import similarity_store


def flat(spark, rows):
    return ItemSimilarity(spark.createDataFrame(rows, "source int, target int, score double"))


def test_versions_are_replaced_as_a_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        similarity_store.current(spark, path)
    similarity_store.publish(flat(spark, [(1, 2, 0.9)]), path, buckets=4)
    old = similarity_store.current(spark, path)
    similarity_store.publish(flat(spark, [(1, 3, 0.8), (3, 1, 0.8)]), path, buckets=4)
    assert {tuple(r) for r in similarity_store.current(spark, path).pairs.collect()} == {(1, 3, 0.8), (3, 1, 0.8)}
    assert {tuple(r) for r in old.pairs.collect()} == {(1, 2, 0.9)}

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(similarity_store.versions, "publish", lost)
        with pytest.raises(RuntimeError):
            similarity_store.publish(flat(spark, [(9, 9, 0.1)]), path, buckets=4)
    assert similarity_store.current(spark, path).pairs.count() == 2


def test_another_session_takes_the_tables_up(spark, tmp_path):
    path = str(tmp_path / "store")
    about = similarity_store.publish(flat(spark, [(1, 2, 0.9), (2, 1, 0.9)]), path, buckets=4)
    spark.sql(f"DROP TABLE {about['pairs']['table']}")  # an external table: the files stay
    again = similarity_store.current(spark, path).pairs
    assert {tuple(r) for r in again.collect()} == {(1, 2, 0.9), (2, 1, 0.9)}


def test_micro_batch_does_not_move_the_stored_tables(spark, sf, tmp_path):
    """With no broadcast at hand, no exchange stands above a stored table before it was cut to the batch's keys."""
    path = str(tmp_path / "store")
    made = content.similarity(fx.movies(spark, sf)).store()
    similarity_store.publish(made, path, buckets=8)
    kept = similarity_store.current(spark, path)
    recents = realtime.recent_ratings(fx.rating_events(spark, sf)).cache()
    triggers = recents.where("rank = 1").select("uid", "mid")
    seen = fx.ratings(spark, sf).select("uid", F.col("mid").alias("item")).distinct()
    wanted = {r["uid"]: r["recs"] for r in realtime.recommendations(triggers, recents, made, seen).collect()}
    assert {r["uid"]: r["recs"] for r in realtime.recommendations(triggers, recents, kept, seen).collect()} == wanted
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.requireAllClusterKeysForCoPartition")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        close = kept.pairs.where("score > 0.7")
        terms = triggers.select("uid", F.col("mid").alias("source")).join(recents.select("uid", F.col("mid").alias("target")), "uid")
        for frame in (kept.with_group(triggers, "mid", "list_key"), terms.join(close, ["source", "target"]), kept.prefix(20, triggers.select(F.col("mid").alias("list_key")))):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            scans = re.findall(r"FileScan parquet [^\n]*kinora_[^\n]*", plan)
            assert scans and all("Bucketed: true" in s for s in scans)
            lines = plan.split("\n")
            for i, line in enumerate(lines):
                if re.search(r"FileScan parquet [^\n]*kinora_(pairs|members)", line):
                    # Up from the scan to its join or ranking.
                    above = next(x for x in reversed(lines[:i]) if re.search(r"Join|Window|Exchange", x))
                    assert "Exchange" not in above, plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
