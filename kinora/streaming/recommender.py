"""Real-time recommendations: rating stream -> newest ratings per user -> keyed results."""

from functools import reduce

from pyspark.sql import functions as F

from kinora.plans.realtime import RECENT_RATINGS, recommendations
from kinora.schema import RATING_EVENT
from kinora.sources.streams import rating_chain
from kinora.streaming import versions
from kinora.streaming.recent import OUTPUT_SCHEMA, STATE_SCHEMA, fold_recent, newest_per_user

DEFAULT_TRIGGER = {"processingTime": "2 seconds"}
REJECT_SCHEMA = "event_id long, stage string, value string"


def _complete():
    return reduce(lambda a, b: a & b, (F.col(f.name).isNotNull() for f in RATING_EVENT.fields))


def incomplete_events(events):
    """Rejects (event_id, stage, value): the events that lack a field, as JSON."""
    fields = F.to_json(F.struct(*(f.name for f in RATING_EVENT.fields)))
    return events.where(~_complete()).select("event_id", F.lit("event").alias("stage"), fields.alias("value"))


def recent_by_user(events, keep=RECENT_RATINGS):
    """Streaming rating events -> one row per user and micro-batch.

    The row holds the user's newest event of the micro-batch and the newest ``keep`` ratings so
    far, in order (timestamp, event_id), whatever the order of arrival.  Events that lack a field are
    :func:`incomplete_events`.
    """
    columns = [f.name for f in RATING_EVENT.fields]
    cut = events.where(_complete()).select(*columns).mapInPandas(newest_per_user(keep), RATING_EVENT)
    return cut.groupBy("uid").applyInPandasWithState(
        fold_recent(keep), OUTPUT_SCHEMA, STATE_SCHEMA, "append", "NoTimeout"
    )


def unpack_recents(rows):
    """(uid, mid, score) rows of the recent lists."""
    zipped = F.arrays_zip(F.col("recent_mids").alias("mid"), F.col("recent_scores").alias("score"))
    return rows.select("uid", F.inline(zipped))


def start_recent_lists(events, path, checkpoint, keep=RECENT_RATINGS, **trigger):
    """Keep a log of every user's recent list."""
    return _start(recent_by_user(events, keep), lambda rows, i: versions.append(rows, path, i), checkpoint, trigger)


def start_recommender(events, similarity, rated, path, checkpoint, keep=RECENT_RATINGS, rejects=None, **trigger):
    """Write fresh recommendations for every user of each micro-batch to the log ``path``.

    ``similarity`` and ``rated`` (uid, item) are functions without arguments: called per
    micro-batch they pick up refreshed tables.  Pass stored tables, they are read every time.
    ``rejects``: log for the events that lack a field.
    """
    return _start_outputs(events, incomplete_events(events) if rejects else None, similarity, rated, path, rejects, checkpoint, keep, trigger)


def start_chain(lines, similarity, rated, path, rejects, checkpoint, keep=RECENT_RATINGS, **trigger):
    """From log lines (event_id, value) to recommendations in one query.

    Two logs are written in each micro-batch: ``path`` gets a row per user with a new rating, ``rejects`` the lines that
    the filter and the parser turn away.  A batch that is repeated after a failure, between the two or after both, takes the
    place of its first run in each.
    """
    events, turned_away = rating_chain(lines)
    return _start_outputs(events, turned_away, similarity, rated, path, rejects, checkpoint, keep, trigger)


def _start_outputs(events, turned_away, similarity, rated, path, rejects, checkpoint, keep, trigger):
    recents = recent_by_user(events, keep)
    both = recents
    if turned_away is not None:
        # One query with one checkpoint: both kinds of rows travel through it side by side.
        both = recents.withColumn("stage", F.lit(None).cast("string")).unionByName(turned_away, allowMissingColumns=True)

    def handle(rows, batch_id):
        rows.persist()
        try:
            fresh = rows
            if turned_away is not None:
                gone = rows.where("stage is not null").select("event_id", "stage", "value")
                versions.append(gone, rejects, batch_id)
                fresh = rows.where("stage is null").select(*recents.columns)
            triggers = fresh.select("uid", "mid")
            recs = recommendations(triggers, unpack_recents(fresh), similarity(), _of_users(rated(), triggers))
            versions.append(recs, path, batch_id)
        finally:
            rows.unpersist()

    return _start(both, handle, checkpoint, trigger)


def _of_users(rated, triggers):
    """Only the users of this micro-batch; their ids prune the stored table."""
    return rated.join(triggers.select("uid").distinct(), "uid", "left_semi")


def _start(rows, handle, checkpoint, trigger):
    return (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .foreachBatch(handle)
        .start()
    )


def current(spark, path, schema=None):
    """Newest row per user; ``schema`` (columns of a row) makes a log that isn't there an empty table."""
    return versions.newest(spark, path, "uid", schema)


def compact(spark, path):
    """Fold the micro-batches of a log; its readers see the same newest row per user at any moment."""
    versions.compact(spark, path, "uid")
