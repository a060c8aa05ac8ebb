"""Table shapes.  Every loader casts to one of these; nothing is inferred."""

from pyspark.sql import types as T


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RATING = _struct(
    ("uid", T.IntegerType()),
    ("mid", T.IntegerType()),
    ("score", T.DoubleType()),
    ("timestamp", T.IntegerType()),
)

MOVIE = _struct(
    ("mid", T.IntegerType()),
    ("name", T.StringType()),
    ("descri", T.StringType()),
    ("timelong", T.StringType()),
    ("issue", T.StringType()),
    ("shoot", T.StringType()),
    ("language", T.StringType()),
    ("genres", T.StringType()),
    ("actors", T.StringType()),
    ("directors", T.StringType()),
)

RECOMMENDATION = _struct(("mid", T.IntegerType()), ("score", T.DoubleType()))
RECS = T.ArrayType(RECOMMENDATION, containsNull=False)

USER_RECS = _struct(("uid", T.IntegerType()), ("recs", RECS))
MOVIE_RECS = _struct(("mid", T.IntegerType()), ("recs", RECS))
GENRE_RECS = _struct(("genres", T.StringType()), ("recs", RECS))

# One row of the rating stream after parsing; event_id is the arrival order used to break ties.
RATING_EVENT = _struct(
    ("event_id", T.LongType()),
    ("uid", T.IntegerType()),
    ("mid", T.IntegerType()),
    ("score", T.DoubleType()),
    ("timestamp", T.IntegerType()),
)
