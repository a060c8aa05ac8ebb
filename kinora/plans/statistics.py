"""Popularity statistics: counts, monthly ranking, averages, best movies per genre."""

from pyspark.sql import functions as F

from kinora.functions.dates import year_month
from kinora.functions.text import genre_tokens
from kinora.operators.topk import to_nested, top_k

# The genre list of the movie catalogue.
GENRES = [
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary", "Drama", "Family",
    "Fantasy", "Foreign", "History", "Horror", "Music", "Mystery", "Romance", "Science", "Tv",
    "Thriller", "War", "Western",
]
TOP_PER_GENRE = 10


def rating_counts(ratings):
    return ratings.groupBy("mid").agg(F.count("mid").alias("count"))


def monthly_counts(ratings):
    """Ratings per month and movie, newest month first, most rated first."""
    return (
        ratings.groupBy(year_month(F.col("timestamp")).alias("yearmonth"), "mid")
        .agg(F.count("mid").alias("count"))
        .select("mid", "count", "yearmonth")
        .orderBy(F.desc("yearmonth"), F.desc("count"), F.asc("mid"))
    )


def average_scores(ratings):
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg"))


def movies_with_score(movies, ratings):
    """Movies that have ratings, with their average."""
    return movies.join(average_scores(ratings), "mid")


def _by_average(digits=9):
    # Averages are ranked on a rounded value so that ties do not hang on the order of summation.
    return [F.round("avg", digits).desc(), F.col("mid").asc()]


def top_per_genre(movies, ratings, genres=GENRES, k=TOP_PER_GENRE):
    """Best k movies for each listed genre; a genre matches anywhere in the genre string.

    The fixed list is tested per row by a higher-order filter, so no join with it is needed.
    """
    wanted = F.array(*[F.lit(g) for g in genres])
    tagged = movies_with_score(movies.select("mid", "genres"), ratings).select(
        F.explode(
            F.filter(wanted, lambda g: F.contains(F.lower("genres"), F.lower(g)))
        ).alias("genre"),
        "mid",
        "avg",
    )
    return top_k(tagged, ["genre"], _by_average(), k)


def top_per_exact_genre(movies, ratings, k=TOP_PER_GENRE):
    """Best k movies for every genre token that occurs in the catalogue."""
    tagged = movies_with_score(movies.select("mid", "genres"), ratings).select(
        F.explode(F.array_distinct(genre_tokens(F.col("genres")))).alias("genre"), "mid", "avg"
    )
    return top_k(tagged, ["genre"], _by_average(), k)


def top_per_genre_nested(movies, ratings, genres=GENRES, k=TOP_PER_GENRE):
    ranked = top_per_genre(movies, ratings, genres, k).withColumnRenamed("genre", "genres")
    return to_nested(ranked, "genres", score="avg")


def movies_of_category(movies, category):
    """Movies that carry the category as a whole token."""
    return movies.where(F.array_contains(genre_tokens(F.col("genres")), category))
