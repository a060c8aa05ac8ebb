"""Parsing of messages, log lines, genre strings and search text; built-ins only."""

from pyspark.sql import functions as F

# Fixed value: the marker that announces a rating in an application log line.
RATING_MARKER = "MOVIE_RATING_PREFIX:"


def _piece(text, separator, index):
    return F.get(F.split(text, separator, -1), F.lit(index))


def _nth_as(text, separator, index, kind):
    return F.trim(_piece(text, separator, index)).try_cast(kind)


def rating_fields(message):
    """``uid|mid|score|timestamp`` as four typed columns; a bad field becomes null."""
    kinds = [("uid", "int"), ("mid", "int"), ("score", "double"), ("timestamp", "int")]
    return [
        _nth_as(message, r"[|]", i, kind).alias(name) for i, (name, kind) in enumerate(kinds)
    ]


def recent_fields(entry):
    """``mid:score`` list entry as two typed columns."""
    return [
        _nth_as(entry, ":", 0, "int").alias("mid"),
        _nth_as(entry, ":", 1, "double").alias("score"),
    ]


def has_marker(line):
    return F.contains(line, F.lit(RATING_MARKER))


def after_marker(line):
    """Text between the first and second marker, trimmed."""
    return F.trim(_piece(line, RATING_MARKER, 1))


def genre_tokens(genres):
    return F.split(genres, r"[|]")


def search_tokens(text):
    """Lower-cased runs of letters and digits of the whole text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")
