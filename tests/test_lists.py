"""Expiring lists equal the batch query."""

import random

import pytest
from pyspark.sql import functions as F

from kinora.plans import realtime
from kinora.schema import RATING_EVENT
from kinora.sources import streams
from kinora.streaming import lists, versions


def rows_of(df):
    return sorted((r["uid"], r["rank"], r["event_id"], r["mid"], r["score"], r["timestamp"]) for r in df.collect())


@pytest.fixture(scope="module")
def batches():
    """Many users that come once, some that return after a pause, one in every batch; not in time order."""
    rng = random.Random(1)
    out, number = [], 0
    for b in range(6):
        part = []
        for uid in [0] * 9 + [100 * b + i for i in range(20)] + ([7, 8, 9] * 4 if b in (0, 5) else []):
            part.append((number, uid, rng.randrange(50), float(rng.randrange(1, 6)), rng.randrange(1000)))
            number += 1
        out.append(part)
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, RATING_EVENT)


def test_lists_equal_the_batch_query_and_stay_bounded(spark, tmp_path, batches):
    path, so_far, sizes = str(tmp_path / "lists"), [], []
    for b, rows in enumerate(batches):
        lists.add(table(spark, rows), path, b, keep=5)
        if b == 3:
            lists.add(table(spark, rows), path, b, keep=5)  # repeated
        so_far += rows
        lists.expire(spark, path, idle=2)
        if b == 5:
            lists.add(table(spark, rows), path, b, keep=5)  # repeated after a compaction
            lists.expire(spark, path, idle=2)
        sizes.append(lists.hot_users(spark, path).count())
        if b >= 3:
            assert rows_of(lists.current(spark, path)) == rows_of(realtime.recent_ratings(table(spark, so_far), 5))
    assert max(sizes[2:]) <= 2 * 21 + 3 and len({r[1] for r in so_far}) > 110


def test_expiry_that_dies_loses_nobody(spark, tmp_path, batches, monkeypatch):
    path = str(tmp_path / "lists")
    for b in range(4):
        lists.add(table(spark, batches[b]), path, b, keep=5)
    want = rows_of(realtime.recent_ratings(table(spark, sum(batches[:4], [])), 5))

    def lost(*args, **kwargs):
        raise RuntimeError("lost")

    for step in ("append", "compact"):
        with monkeypatch.context() as patch:
            patch.setattr(versions, step, lost)
            with pytest.raises(RuntimeError):
                lists.expire(spark, path, idle=1)
        assert rows_of(lists.current(spark, path)) == want
    lists.expire(spark, path, idle=1)
    assert rows_of(lists.current(spark, path)) == want


def test_stream_with_expiry(spark, tmp_path, batches):
    source, path, state = (str(tmp_path / n) for n in ("in", "lists", "state"))
    for rows in batches:
        table(spark, rows).coalesce(1).write.mode("append").parquet(source)
    stream = streams.file_source(spark, source, RATING_EVENT, files_per_trigger=1)
    lists.start(stream, path, state, keep=5, idle=1, every=2, availableNow=True).awaitTermination()
    assert rows_of(lists.current(spark, path)) == rows_of(realtime.recent_ratings(table(spark, sum(batches, [])), 5))
    assert lists.hot_users(spark, path).count() < 60


def test_no_events(spark, tmp_path):
    path = str(tmp_path / "lists")
    lists.expire(spark, path, 1)
    assert lists.current(spark, path).count() == 0
    lists.add(table(spark, [(1, None, 1, 1.0, 1)]), path, 0)
    assert lists.current(spark, path).count() == 0
    lists.add(table(spark, [(1, 1, 1, 1.0, 1), (1, 1, 1, 1.0, 1)]), path, 1)
    assert lists.current(spark, path).count() == 1
