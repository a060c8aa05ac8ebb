"""Time expressions that do not depend on the session zone."""

from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def year_month(seconds):
    """``yyyyMM`` as int for unix seconds, in UTC whatever the session zone is."""
    day = F.date_add(
        F.lit("1970-01-01").cast("date"),
        F.floor(seconds / F.lit(SECONDS_PER_DAY)).cast("int"),
    )
    return (F.year(day) * 100 + F.month(day)).cast("int")


def naive_seconds(ts):
    """Unix seconds of a zone-less timestamp column read as UTC wall time; null beyond 32 bits."""
    return (
        F.unix_date(ts.cast("date")).cast("long") * SECONDS_PER_DAY
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    ).try_cast("int")
