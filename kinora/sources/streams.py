"""Streaming sources and sinks: Kafka topics in production, files in tests."""

from pyspark.sql import functions as F

from kinora.functions.text import after_marker, has_marker, rating_fields

# Topic names and the key of forwarded ratings.
RATING_TOPIC = "recommender"
LOG_TOPIC = "log"
FORWARD_KEY = "logProcessor"

# Arrival number of a Kafka record: offsets stay below 2^44, partitions above them.
_OFFSET_BITS = 44


def kafka_source(spark, servers, topic, starting="latest", **options):
    """Topic as (event_id, value); needs the Kafka connector on the class path."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )
    arrival = F.shiftleft(F.col("partition").cast("long"), _OFFSET_BITS) + F.col("offset")
    return raw.select(arrival.alias("event_id"), F.col("value").cast("string").alias("value"))


def file_source(spark, path, schema, fmt="parquet", files_per_trigger=None, **options):
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def parse_ratings(messages):
    """(event_id, value) -> typed rating events; malformed messages are left out."""
    return _parsed(messages).where("not malformed").drop("malformed", "value")


def rejected_ratings(messages):
    """The messages :func:`parse_ratings` leaves out."""
    return _parsed(messages).where("malformed").select("event_id", "value")


def _parsed(messages):
    fields = messages.select("event_id", "value", *rating_fields(F.col("value")))
    complete = F.lit(True)
    for name in ("uid", "mid", "score", "timestamp"):
        complete = complete & F.col(name).isNotNull()
    return fields.withColumn("malformed", ~complete)


def ratings_from_log(lines, stamp=False):
    """Log lines (value) -> (key, value) rows with the text after the marker, and ``event_id`` where the lines have it.

    Lines with nothing after the marker go to :func:`rejected_lines`.  ``stamp`` adds the processing time.
    """
    text = F.col("value").cast("string")
    named = ["event_id"] if "event_id" in lines.columns else []
    forwarded = lines.where(has_marker(text)).select(
        *named, F.lit(FORWARD_KEY).alias("key"), after_marker(text).alias("value")
    )
    forwarded = forwarded.where(F.length("value") > 0)
    return forwarded.withColumn("processed_at", F.current_timestamp()) if stamp else forwarded


def rejected_lines(lines):
    """The lines whose marker has nothing after it, as they are."""
    text = F.col("value").cast("string")
    return lines.where(has_marker(text) & (F.length(after_marker(text)) == 0))


def rating_chain(lines):
    """Log lines (event_id, value) -> typed rating events, and the rejects (event_id, stage, value) of both steps."""
    messages = ratings_from_log(lines)
    rejects = rejected_lines(lines).select("event_id", F.lit("filter").alias("stage"), "value").unionByName(
        rejected_ratings(messages).select("event_id", F.lit("parse").alias("stage"), "value")
    )
    return parse_ratings(messages), rejects


def start_kafka_sink(rows, servers, checkpoint, topic=RATING_TOPIC, interval="2 seconds"):
    """Forward (key, value) rows to a topic; needs the Kafka connector on the class path."""
    return (
        rows.select(F.col("key").cast("string"), F.col("value").cast("string"))
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval)
        .start()
    )


def start_file_sink(rows, path, checkpoint, fmt="parquet", **trigger):
    """Append rows to files; ``trigger`` as for ``DataStreamWriter.trigger``."""
    return (
        rows.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "2 seconds"}))
        .start()
    )


def start_console_sink(rows, checkpoint, **trigger):
    """Print each micro-batch; for debugging."""
    return (
        rows.writeStream.format("console")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "2 seconds"}))
        .start()
    )
