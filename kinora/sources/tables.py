"""Batch tables: typed loaders, nested result lists, overwrite sink."""

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kinora.operators.topk import from_nested
from kinora.schema import MOVIE, MOVIE_RECS, RATING


def conform(df, schema):
    """Select and cast to the given shape; values that do not fit and missing columns become null, missing text empty."""
    columns = []
    for field in schema.fields:
        present = field.name in df.columns
        missing = F.lit("") if field.dataType == StringType() else F.lit(None)
        value = F.col(f"`{field.name}`") if present else missing
        columns.append(value.try_cast(field.dataType).alias(field.name))
    return df.select(*columns)


def read_table(spark, path, schema, fmt="parquet", **options):
    """Read with the declared schema (parquet, orc, json, csv, ...); nothing is inferred."""
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def load_ratings(spark, path, fmt="parquet", **options):
    """Ratings with complete keys and score."""
    return clean_ratings(read_table(spark, path, RATING, fmt, **options))


def clean_ratings(df):
    return conform(df, RATING).dropna(subset=["uid", "mid", "score"])


def load_movies(spark, path, fmt="parquet", **options):
    return clean_movies(read_table(spark, path, MOVIE, fmt, **options))


def clean_movies(df):
    return conform(df, MOVIE).dropna(subset=["mid"])


def load_similarity(spark, path, fmt="parquet", **options):
    """Nested neighbour lists as flat (source, target, score) rows."""
    return flatten_similarity(read_table(spark, path, MOVIE_RECS, fmt, **options))


def flatten_similarity(nested):
    flat = from_nested(nested.withColumnRenamed("mid", "source"), "source")
    return flat.select("source", F.col("mid").alias("target"), "score")


def overwrite(df, path, fmt="parquet", partition_by=None):
    """Replace a result table."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
