"""Content similarity: genre TF-IDF vectors and their cosine."""

from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kinora.functions.vectors import l2_norm
from kinora.operators.similar import ItemSimilarity
from kinora.operators.threshold import sparse_threshold
from kinora.session import stored

BUCKETS = 50
MIN_SIMILARITY = 0.6


def words(movies):
    """(mid, words): genre separators become blanks, then lower-case and split on white space."""
    text = movies.where(F.col("genres").isNotNull()).select(
        "mid", F.translate("genres", "|", " ").alias("text")
    )
    return Tokenizer(inputCol="text", outputCol="words").transform(text).select("mid", "words")


def term_frequencies(tokens, buckets=BUCKETS):
    """Adds ``tf``, the hashed term counts."""
    return HashingTF(inputCol="words", outputCol="tf", numFeatures=buckets).transform(tokens)


def fit_idf(tf):
    return IDF(inputCol="tf", outputCol="tfidf").fit(tf)


def nonzero(df, key, vector, value):
    """Vector column as (key, bucket, value) rows."""
    return df.select(key, F.posexplode(vector_to_array(vector)).alias("bucket", value)).where(
        F.col(value) != 0
    )


def idf_table(spark, model):
    """(bucket, df, idf) of the fitted model; as many rows as there are buckets."""
    rows = [
        (i, int(df), float(idf)) for i, (df, idf) in enumerate(zip(model.docFreq, model.idf.toArray()))
    ]
    return spark.createDataFrame(rows, "bucket int, df long, idf double").where("df > 0")


def _exact_weights(groups, n_movies):
    """(source, g, w) of word bags with a vocabulary of the words themselves: w = count * ln((N + 1) / (df + 1))."""
    words = groups.select("source", "n_members", F.explode("words").alias("word"))
    counts = words.groupBy("source", "word").agg(F.count(F.lit(1)).alias("tf"), F.first("n_members").alias("n_members"))
    counts = stored(groups.sparkSession, counts, "word-counts")
    frequency = counts.groupBy("word").agg(F.sum("n_members").alias("df")).withColumn("g", F.monotonically_increasing_id())
    frequency = stored(groups.sparkSession, frequency, "vocabulary")  # numbers are given once
    idf = F.ln((F.lit(n_movies) + 1) / (F.col("df") + 1))
    return counts.join(frequency, "word").select(F.col("source").alias("e"), "g", (F.col("tf") * idf).alias("w"))


def similarity(movies, min_score=MIN_SIMILARITY, buckets=BUCKETS, **tuning):
    """Content similarity above ``min_score`` as a factored :class:`ItemSimilarity`.

    Movies with the same words have the same vector, so vectors, norms and cosines are computed
    once per distinct word bag; a group is named by its smallest movie id.  ``buckets=None`` tells all words apart
    instead of hashing them.
    """
    spark = movies.sparkSession
    tokens = words(movies)
    keyed = tokens.select("mid", F.array_sort("words").alias("words"))
    groups = keyed.groupBy("words").agg(
        F.min("mid").alias("source"), F.count(F.lit(1)).alias("n_members")
    )
    if buckets is None:
        groups = stored(spark, groups, "content-groups")
        rows = stored(spark, _exact_weights(groups, tokens.count()).where("w != 0"), "content-weights")
        groups = groups.join(rows.select(F.col("e").alias("source")).distinct(), "source", "left_semi")
    else:
        model = fit_idf(term_frequencies(tokens, buckets))
        weights = vector_to_array("tfidf")
        groups = model.transform(term_frequencies(groups, buckets)).select(
            "words", "source", "n_members", weights.alias("weights"), (l2_norm(weights)).alias("norm")
        )
        # Zero vectors have no direction and never pass the threshold.
        groups = stored(spark, groups, "content-groups").where((F.col("norm") > 0) & ~F.isnan("norm"))
        rows = groups.select("source", F.posexplode("weights").alias("bucket", "w")).where("w != 0")
        rows = rows.select(F.col("bucket").alias("g"), F.col("source").alias("e"), "w")
    pairs = sparse_threshold(rows, min_score, **tuning).select(
        F.col("e").cast("int").alias("source"), F.col("f").cast("int").alias("target"), "score"
    )
    copies = groups.where(F.col("n_members") > 1).select(
        "source", F.col("source").alias("target"), F.lit(1.0).alias("score")
    )
    members = keyed.join(groups.select("words", "source"), "words").select("mid", "source")
    return ItemSimilarity(pairs.unionByName(copies), members)
