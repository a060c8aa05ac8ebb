"""Per-user lists of the newest ratings, kept in stored tables with an expiring hot part.

The hot log holds the lists of users seen lately; it is read in every micro-batch and bounded by their number.  ``expire``
moves the others to the cold log, which is only read for users of a batch that the hot log doesn't know: who returns gets the
stored list back.  No operator state lives in executors, and a lost one loses nothing.

A batch merges its own newest ratings with the lists of its users from before the batch, so a repeated batch gives what
its first run gave.
"""

from pyspark.sql import functions as F

from kinora.operators.topk import top_k
from kinora.plans.realtime import RECENT_RATINGS, newest_first
from kinora.schema import RATING_EVENT
from kinora.session import stored
from kinora.streaming import versions

ENTRY = "struct<event_id:long,mid:int,score:double,timestamp:int>"
LIST = f"uid int, recents array<{ENTRY}>"


def _logs(path):
    return f"{path}/hot", f"{path}/cold"


def _newest(log, users):
    """Newest stored list of each of ``users``."""
    own = log.join(users, "uid", "left_semi")
    return own.groupBy("uid").agg(F.max_by("recents", versions.BATCH).alias("recents"))


def _entries(lists):
    return lists.select("uid", F.inline("recents"))


def add(events, path, batch_id, keep=RECENT_RATINGS):
    """Take a batch of rating events into the lists under ``path``; rows without all fields are left to the caller."""
    spark = events.sparkSession
    hot_path, cold_path = _logs(path)
    columns = [f.name for f in RATING_EVENT.fields]
    complete = events.select(*columns).dropna()
    fresh = stored(spark, top_k(complete, ["uid"], newest_first(), keep).drop("rank"), "fresh-ratings")
    users = fresh.select("uid").distinct()
    hot = stored(spark, _newest(versions.rows(spark, hot_path, LIST).where(F.col(versions.BATCH) < batch_id), users), "hot-lists")
    lists = hot
    away = stored(spark, users.join(hot, "uid", "left_anti"), "away-users")
    if not away.isEmpty():
        lists = hot.unionByName(_newest(versions.rows(spark, cold_path, LIST), away))
    # An event that is in both counts once.
    rows = _entries(lists).unionByName(fresh).dropDuplicates(["uid", "event_id"])
    merged = top_k(rows, ["uid"], newest_first(), keep)
    entry = F.struct("rank", "event_id", "mid", "score", "timestamp")
    packed = merged.groupBy("uid").agg(F.array_sort(F.collect_list(entry)).alias("packed"))  # at most ``keep`` entries
    recents = F.transform("packed", lambda x: F.struct(*(x[c].alias(c) for c in ("event_id", "mid", "score", "timestamp"))))
    versions.append(packed.select("uid", recents.cast(f"array<{ENTRY}>").alias("recents")), hot_path, batch_id)


def expire(spark, path, idle):
    """Move users whom none of the last ``idle`` batches named to the cold log, and fold both logs.

    They are in the cold log before they leave the hot one, so readers find them at any moment.
    """
    hot_path, cold_path = _logs(path)
    seen = versions.batches(spark, hot_path)
    if not seen:
        return
    last = max(seen)
    # The newest batch may be repeated, and then starts from what was there before it.
    newest = versions.rows(spark, hot_path).where(F.col(versions.BATCH) < last).groupBy("uid").agg(
        F.max(versions.BATCH).alias("at"), F.max_by("recents", versions.BATCH).alias("recents")
    )
    idle_lists = stored(spark, newest.where(F.col("at") <= last - idle).select("uid", "recents"), "idle-lists")
    if not idle_lists.isEmpty():
        # Sorted by user: a look-up reads the row groups of its users.
        versions.append(idle_lists.repartitionByRange("uid").sortWithinPartitions("uid"), cold_path, last)
    versions.compact(spark, hot_path, fold=lambda log: _folded(log).where(F.col(versions.BATCH) > last - idle))
    versions.compact(spark, cold_path, "uid")


def _folded(log):
    return log.groupBy("uid").agg(F.max_by("recents", versions.BATCH).alias("recents"), F.max(versions.BATCH).alias(versions.BATCH))


def current(spark, path):
    """(uid, rank, event_id, mid, score, timestamp) of all users' lists, hot and cold."""
    hot, cold = (versions.rows(spark, log, LIST) for log in _logs(path))
    warm = hot.groupBy("uid").agg(F.max_by("recents", versions.BATCH).alias("recents"))
    away = cold.join(warm, "uid", "left_anti").groupBy("uid").agg(F.max_by("recents", versions.BATCH).alias("recents"))
    lists = warm.unionByName(away).select("uid", F.posexplode("recents").alias("pos", "x"))
    return lists.select("uid", (F.col("pos") + 1).alias("rank"), "x.event_id", "x.mid", "x.score", "x.timestamp")


def hot_users(spark, path):
    """Users in the hot log."""
    return versions.rows(spark, _logs(path)[0], LIST).select("uid").distinct()


def start(events, path, checkpoint, keep=RECENT_RATINGS, idle=None, every=10, **trigger):
    """Keep the lists of a stream of rating events; with ``idle`` users expire after so many batches, looked for ``every`` few."""

    def handle(rows, batch_id):
        add(rows, path, batch_id, keep)
        if idle and batch_id % every == every - 1:
            expire(rows.sparkSession, path, idle)

    return (
        events.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "2 seconds"}))
        .foreachBatch(handle)
        .start()
    )
