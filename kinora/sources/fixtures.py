"""The package's table shapes derived from the given parquet tables."""

from pyspark.sql import functions as F

from kinora.functions.dates import naive_seconds
from kinora.functions.text import RATING_MARKER


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark, sf_dir):
    """One rating per order line: the customer rates the part."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("int").alias("uid"),
        F.col("l_partkey").cast("int").alias("mid"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("score"),
        naive_seconds(F.col("l_shipdate")).alias("timestamp"),
    )


def movies(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    empty = F.lit("")
    return part.select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        *[empty.alias(c) for c in ("descri", "timelong", "issue", "shoot")],
        F.col("p_brand").alias("language"),
        F.concat_ws("|", "p_type", F.replace("p_name", F.lit(" "), F.lit("|"))).alias("genres"),
        *[empty.alias(c) for c in ("actors", "directors")],
    )


def events_as_ratings(events):
    """Rating events from the raw event rows (static or streaming)."""
    return events.select(
        "event_id",
        F.col("user_id").cast("int").alias("uid"),
        F.get_json_object("props", "$.k").try_cast("int").alias("mid"),
        (1 + F.pmod(F.floor("value").cast("int"), F.lit(5))).cast("double").alias("score"),
        naive_seconds(F.col("ts")).alias("timestamp"),
    )


def rating_events(spark, sf_dir):
    return events_as_ratings(table(spark, sf_dir, "events"))


def as_message(event):
    """Message text of a rating event: ``uid|mid|score|timestamp``."""
    return F.concat_ws("|", *[event[c].cast("string") for c in ("uid", "mid", "score", "timestamp")])


def events_as_log_lines(events):
    """Raw application log: rating events carry the marker, other events do not."""
    is_rated = F.coalesce(F.col("event_type").isin("view", "purchase", "click"), F.lit(False))
    rated = events_as_ratings(events.where(is_rated))
    lines = rated.select(
        "event_id",
        F.concat(F.lit("INFO app - "), F.lit(RATING_MARKER), F.lit(" "), as_message(rated)).alias("value"),
    )
    plain = events.where(~is_rated).select(
        "event_id", F.concat(F.lit("INFO app - "), F.coalesce("event_type", F.lit(""))).alias("value")
    )
    return lines.unionByName(plain)


def events_as_broken_log_lines(events):
    """The application log with lines that announce a rating and have none: errors nothing at all, signups no movie."""
    said = F.when(F.col("event_type") == "error", F.lit("")).when(
        F.col("event_type") == "signup", F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit("|signup"))
    )
    broken = events.where(F.col("event_type").isin("error", "signup")).select(
        "event_id", F.concat(F.lit("INFO app - "), F.lit(RATING_MARKER), said).alias("value")
    )
    rest = events.where(~F.coalesce(F.col("event_type").isin("error", "signup"), F.lit(False)))
    return events_as_log_lines(rest).unionByName(broken)
