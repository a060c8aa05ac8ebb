"""Registered queries: each reads whole tables of ``sf_dir`` and returns one DataFrame."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinora.functions import vectors
from kinora.functions.text import after_marker, rating_fields, recent_fields
from kinora.operators import products
from kinora.operators.similar import ItemSimilarity
from kinora.operators.topk import to_nested
from kinora.plans import content, demographic, itemcf, lfm, realtime, search, statistics, usercf
from kinora.session import scratch_path, stored
from kinora.sources import fixtures as fx
from kinora.sources import streams, tables
from kinora.streaming import cocounts, recommender, versions
from kinora.streaming import lists as recent_lists

QUERIES = {}

# Genre list for the fixture's catalogue; "old" also matches inside "cold", on purpose.
FIXTURE_GENRES = ["ECONOMY", "PROMO", "ring", "new", "old"]
SEARCH_TERMS = ["system", "water", "number"]
# ALS at a size that suits the fixture; the library defaults are larger.
ALS_RANK = 10
GRID_RANKS = (4, 6, 8, 10)
FACTOR_THRESHOLD = 0.3


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _r6(name):
    return F.round(name, 6).alias(name)


def _ratings(spark, sf):
    return tables.clean_ratings(fx.ratings(spark, sf))


def _movies(spark, sf):
    return tables.clean_movies(fx.movies(spark, sf))


# -- loading and storing -----------------------------------------------------------------------


@query
def ratings_load(spark, sf):
    return _ratings(spark, sf)


@query
def movies_load(spark, sf):
    return _movies(spark, sf)


@query
def sink_overwrite_roundtrip(spark, sf):
    path = scratch_path(spark, "movie-averages")
    averages = statistics.average_scores(_ratings(spark, sf))
    tables.overwrite(averages.limit(0), path)
    tables.overwrite(averages, path)
    return tables.read_table(spark, path, averages.schema).select("mid", _r6("avg"))


# -- statistics --------------------------------------------------------------------------------


@query
def movie_rating_count(spark, sf):
    return statistics.rating_counts(_ratings(spark, sf))


@query
def monthly_hot_movies(spark, sf):
    return statistics.monthly_counts(_ratings(spark, sf))


@query
def movie_avg_score(spark, sf):
    return statistics.average_scores(_ratings(spark, sf)).select("mid", _r6("avg"))


@query
def movie_with_score(spark, sf):
    scored = statistics.movies_with_score(_movies(spark, sf), _ratings(spark, sf))
    return scored.select("mid", "name", "genres", _r6("avg"))


@query
def genre_top10(spark, sf):
    top = statistics.top_per_genre(_movies(spark, sf), _ratings(spark, sf), FIXTURE_GENRES)
    return top.select("genre", "rank", "mid", _r6("avg"))


@query
def genre_top10_exploded(spark, sf):
    top = statistics.top_per_exact_genre(_movies(spark, sf), _ratings(spark, sf))
    return top.select("genre", "rank", "mid", _r6("avg"))


@query
def genre_top10_nested(spark, sf):
    nested = statistics.top_per_genre_nested(_movies(spark, sf), _ratings(spark, sf), FIXTURE_GENRES)
    return _unnested(nested, "genres")


@query
def category_exact_match(spark, sf):
    return statistics.movies_of_category(_movies(spark, sf), "old").select("mid", "name", "genres")


def _unnested(nested, key):
    """Nested lists checked as (key, rank, mid, score) rows; keys with an empty list stay."""
    return nested.select(key, F.posexplode_outer("recs").alias("pos", "x")).select(
        F.col(key).alias("key"), (F.col("pos") + 1).alias("rank"), F.col("x.mid").alias("mid"), F.round("x.score", 6).alias("score")
    )


# -- item CF -----------------------------------------------------------------------------------


@query
def item_cooccurrence(spark, sf):
    return itemcf.cooccurrence(_ratings(spark, sf)).drop("score")


@query
def item_cooccurrence_incremental(spark, sf):
    """The same counts, kept up to date by four micro-batches of the ratings."""
    ratings = stored(spark, _ratings(spark, sf), "ratings")
    path = scratch_path(spark, "cocounts")
    for i in range(4):
        cocounts.add(ratings.where(F.pmod(F.xxhash64("uid", "mid", "timestamp"), F.lit(4)) == i), path, i)
        if i == 2:
            cocounts.compact(spark, path)
    return cocounts.similarity(spark, path).select("mid1", "mid2", "cocount", "count1", "count2")


@query
def item_cf_summary(spark, sf):
    """Per movie, over all its co-occurring movies."""
    return itemcf.summaries(_ratings(spark, sf)).select("mid", "n_neighbours", "cocounts", "best_cocount", _r6("mean_score"))


@query
def item_cf_similarity(spark, sf):
    return itemcf.cooccurrence(_ratings(spark, sf)).select("mid1", "mid2", _r6("score"))


@query
def item_cf_topk(spark, sf):
    top = itemcf.neighbours(_ratings(spark, sf))
    return top.select("mid1", "rank", "mid2", "cocount", "count1", "count2", _r6("score"))


@query
def item_cf_topk_nested(spark, sf):
    return _unnested(itemcf.neighbours_nested(_ratings(spark, sf)), "mid")


# -- vectors -----------------------------------------------------------------------------------


def _factors(spark, sf):
    return fx.table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("int").alias("mid"), F.col("embedding").cast("array<double>").alias("features")
    )


@query
def vector_norms(spark, sf):
    v = F.col("features")
    return _factors(spark, sf).select(
        "mid",
        F.round(vectors.l1_norm(v), 6).alias("l1"),
        F.round(vectors.l2_norm(v), 6).alias("l2"),
        F.round(vectors.lp_norm(v, 3), 6).alias("l3"),
        F.round(vectors.dot(v, v), 6).alias("self_dot"),
        F.round(vectors.squared_distance(v, vectors.centre(v)), 6).alias("centring_distance"),
        F.round(vectors.cosine(v, vectors.centre(v)), 6).alias("centring_cosine"),
    )


@query
def factor_similarity(spark, sf):
    pairs = lfm.factor_similarity(_factors(spark, sf), FACTOR_THRESHOLD)
    return pairs.select("mid", "other_mid", _r6("score"))


@query
def factor_top10(spark, sf):
    pairs = lfm.factor_similarity(_factors(spark, sf), min_score=None, top_k=10)
    return pairs.select("mid", "rank", "other_mid", _r6("score"))


@query
def pearson_similarity(spark, sf):
    pairs = lfm.factor_similarity(_factors(spark, sf), FACTOR_THRESHOLD, centred=True)
    return pairs.select("mid", "other_mid", _r6("score"))


# -- content -----------------------------------------------------------------------------------


@query
def content_tokens(spark, sf):
    return content.words(_movies(spark, sf)).select("mid", F.posexplode("words").alias("pos", "token"))


def _tf(spark, sf):
    return content.term_frequencies(content.words(_movies(spark, sf)))


@query
def content_tf(spark, sf):
    return content.nonzero(_tf(spark, sf), "mid", "tf", "tf_count")


@query
def content_idf(spark, sf):
    return content.idf_table(spark, content.fit_idf(_tf(spark, sf))).select("bucket", "df", _r6("idf"))


@query
def content_tfidf(spark, sf):
    tf = _tf(spark, sf)
    weights = content.nonzero(content.fit_idf(tf).transform(tf), "mid", "tfidf", "weight")
    return weights.select("mid", "bucket", _r6("weight"))


@query
def content_groups(spark, sf):
    return content.similarity(_movies(spark, sf)).members.select("mid", F.col("source").alias("group_mid"))


@query
def content_recs(spark, sf):
    """Whole similarity result above 0.6, one row per pair of distinct word bags."""
    pairs = content.similarity(_movies(spark, sf)).pairs
    return pairs.select(
        F.col("source").alias("group_mid"), F.col("target").alias("other_group_mid"), _r6("score")
    )


@query
def content_recs_exact(spark, sf):
    """The same with a vocabulary of the words themselves instead of hash buckets."""
    pairs = content.similarity(_movies(spark, sf), buckets=None).pairs
    return pairs.select(
        F.col("source").alias("group_mid"), F.col("target").alias("other_group_mid"), _r6("score")
    )


@query
def content_neighbour_counts(spark, sf):
    counts = content.similarity(_movies(spark, sf)).neighbour_counts()
    return counts.select("mid", "n_neighbours", _r6("mean_score"))


@query
def content_top20(spark, sf):
    top = content.similarity(_movies(spark, sf)).neighbours(20)
    return top.select("mid", "rank", "other_mid", _r6("score"))


@query
def content_recs_nested(spark, sf):
    top = content.similarity(_movies(spark, sf)).neighbours(20)
    return _unnested(to_nested(top, "mid", item="other_mid"), "mid")


# -- latent factors ----------------------------------------------------------------------------


@query
def user_item_candidates(spark, sf):
    return lfm.candidate_space(_ratings(spark, sf))


@query
def ratings_split(spark, sf):
    return lfm.hash_split(_ratings(spark, sf)).select("uid", "mid", "score", "timestamp", "is_train")


@query
def als_user_recs(spark, sf):
    return lfm.user_recs(lfm.fit_als(_ratings(spark, sf), rank=ALS_RANK))


@query
def als_unseen_user_recs(spark, sf):
    ratings = _ratings(spark, sf)
    return lfm.unseen_user_recs(lfm.fit_als(ratings, rank=ALS_RANK), ratings)


@query
def als_item_similarity(spark, sf):
    model = lfm.fit_als(_ratings(spark, sf), rank=ALS_RANK)
    return lfm.factor_similarity(lfm.item_factors(model), top_k=20)


@query
def als_predict_pairs(spark, sf):
    split = lfm.hash_split(_ratings(spark, sf))
    model = lfm.fit_als(split.where("is_train"), rank=ALS_RANK)
    return lfm.predict_pairs(model, split.where("not is_train").select("uid", "mid", "score"))


def _grid(spark, sf, keep=None):
    split = lfm.hash_split(_ratings(spark, sf))
    return lfm.grid(split.where("is_train"), split.where("not is_train"), ranks=GRID_RANKS, keep=keep)


@query
def als_grid_rmse(spark, sf):
    return _grid(spark, sf)


@query
def als_grid_best(spark, sf):
    return lfm.best_setting(_grid(spark, sf))


# What the factor models must satisfy, whatever their numbers: a row per user, movie, pair or setting.


@query
def als_normal_equations(spark, sf):
    """The last half-step solves each user's regularised least squares."""
    ratings = _ratings(spark, sf)
    return lfm.user_residuals(lfm.fit_als(ratings, rank=ALS_RANK), ratings, lfm.REGULARISATION).select(
        "uid", "n_ratings", (F.col("residual") <= 1e-3 * (1 + F.col("n_ratings"))).alias("ok")
    )


def _lists_hold(spark, model, listed, seen=None):
    """Whether each user's list is the whole best: as many entries as there are positive products, k at most, with the right
    scores and ranks, and no product left out that is above the last entry.  Counted from the whole users x items product.
    """
    near = 1e-6
    fit = lfm.with_products(model, listed)
    lists = fit.groupBy("uid").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("rank").alias("ranks"),
        F.max("rank").alias("last"),
        F.min("score").alias("least"),
        F.max(F.abs(F.col("product") - F.col("score"))).alias("off"),
    )
    users = model.userFactors.select(F.col("id").cast("long").alias("uid"), F.col("features").cast("array<double>").alias("vec"))
    items = model.itemFactors.select(F.col("id").cast("long").alias("mid"), F.col("features").cast("array<double>").alias("vec"))
    lists = stored(spark, lists.select(F.col("uid").cast("long").alias("uid"), "n", "ranks", "last", "least", "off"), "lists")
    limits = users.join(lists, "uid", "left").select(
        "uid", "vec", F.explode(F.array(F.lit(0.0), F.coalesce(F.col("least"), F.lit(0.0)) + near)).alias("limit")
    )
    counted = products.counts_above(limits, items)
    wide = counted.groupBy("uid").agg(F.min_by("above", "limit").alias("positive"), F.max_by("above", "limit").alias("above"))
    own = fit.join(lists.select(F.col("uid").cast("int").alias("uid"), "least"), "uid").groupBy("uid").agg(
        F.count_if(F.col("product") > F.col("least") + near).alias("own_above")
    )
    wide = wide.join(lists, "uid", "left").join(own, "uid", "left")
    if seen is not None:
        rated = lfm.with_products(model, seen.distinct()).join(lists.select("uid", "least"), "uid", "left")
        gone = rated.groupBy("uid").agg(
            F.count_if(F.col("product") > 0).alias("seen_positive"),
            F.count_if(F.col("product") > F.coalesce(F.col("least"), F.lit(0.0)) + near).alias("seen_above"),
        )
        zero = F.lit(0)
        wide = wide.join(gone, "uid", "left").withColumn("positive", F.col("positive") - F.coalesce("seen_positive", zero))
        wide = wide.withColumn("above", F.col("above") - F.coalesce("seen_above", zero))
    n = F.coalesce("n", F.lit(0))
    whole = n == F.least(F.col("positive"), F.lit(lfm.TOP_PER_USER))
    right = (F.col("ranks") == n) & (F.col("last") == n) & (F.col("off") < near) & (F.col("own_above") == F.col("above"))
    return wide.select(F.col("uid").cast("int").alias("uid"), (whole & F.when(n > 0, right).otherwise(True)).alias("ok"))


@query
def als_user_recs_hold(spark, sf):
    """Lists are the best k positive products of all movies."""
    model = lfm.fit_als(_ratings(spark, sf), rank=ALS_RANK)
    return _lists_hold(spark, model, stored(spark, lfm.user_recs(model), "als-recs"))


@query
def als_unseen_recs_hold(spark, sf):
    """Lists are the best k positive products of the movies that the user has not rated."""
    ratings = _ratings(spark, sf)
    model = lfm.fit_als(ratings, rank=ALS_RANK)
    listed = stored(spark, lfm.unseen_user_recs(model, ratings), "als-unseen")
    seen = ratings.select("uid", "mid")
    repeated = listed.join(seen.distinct(), ["uid", "mid"], "left_semi").groupBy("uid").agg(F.count(F.lit(1)).alias("repeated"))
    held = _lists_hold(spark, model, listed, seen).join(repeated, "uid", "left")
    return held.select("uid", (F.col("ok") & F.col("repeated").isNull()).alias("ok"))


@query
def als_nested_recs_hold(spark, sf):
    """One row per user, with the entries of the flat lists in their order."""
    model = lfm.fit_als(_ratings(spark, sf), rank=ALS_RANK)
    flat = stored(spark, lfm.user_recs(model), "als-recs")
    nested = lfm.nested_user_recs(flat)
    again = nested.select("uid", F.posexplode("recs").alias("pos", "x")).select(
        "uid", (F.col("pos") + 1).alias("rank"), F.col("x.mid").alias("mid"), F.col("x.score").alias("score")
    )
    both = flat.join(again.withColumn("there", F.lit(1)), ["uid", "rank", "mid", "score"], "full")
    sizes = both.groupBy("uid").agg((F.count("there") == F.count(F.lit(1))).alias("ok"))
    return sizes.select("uid", "ok")


@query
def als_item_similarity_hold(spark, sf):
    """Movie lists are the best 20 cosines of all other movies' factors."""
    near = 1e-6
    model = lfm.fit_als(_ratings(spark, sf), rank=ALS_RANK)
    factors = stored(spark, lfm.item_factors(model).select("mid", F.col("features").cast("array<double>").alias("v")), "factors")
    unit = factors.withColumn("v", vectors.scale(F.col("v"), 1 / vectors.l2_norm(F.col("v"))))
    listed = stored(spark, lfm.factor_similarity(lfm.item_factors(model), min_score=-2.0, top_k=20), "item-lists")
    both = listed.join(unit, "mid").join(unit.toDF("other_mid", "w"), "other_mid")
    cosine = F.aggregate(F.zip_with("v", "w", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    least = F.min("score").over(Window.partitionBy("mid"))
    lists = both.withColumn("cosine", cosine).withColumn("least", least).groupBy("mid").agg(
        F.count_distinct("rank").alias("n"),
        F.max("rank").alias("last"),
        F.max(F.abs(F.col("cosine") - F.col("score"))).alias("off"),
        F.min("least").alias("least"),
        F.count_if(F.col("cosine") > F.col("least") + near).alias("own_above"),
    )
    lists = stored(spark, lists, "lists")
    asked = unit.join(lists, "mid").select(F.col("mid").cast("long").alias("uid"), F.col("v").alias("vec"), (F.col("least") + near).alias("limit"))
    counted = products.counts_above(asked, unit.select("mid", F.col("v").alias("vec"))).select(F.col("uid").alias("mid"), "above")
    others = factors.count() - 1
    own = F.when(F.col("least") + near < 1, 1).otherwise(0)  # a movie's cosine with itself
    whole = (F.col("n") == F.least(F.lit(others), F.lit(20))) & (F.col("last") == F.col("n"))
    right = (F.col("off") < near) & (F.col("above") - own == F.col("own_above"))
    return lists.join(counted, "mid").select(F.col("mid").cast("int").alias("mid"), (whole & right).alias("ok"))


@query
def als_predicted_pairs(spark, sf):
    """Pairs that get a prediction: held-out ones whose user and movie were trained on."""
    split = lfm.hash_split(_ratings(spark, sf))
    model = lfm.fit_als(split.where("is_train"), rank=ALS_RANK)
    predicted = lfm.predict_pairs(model, split.where("not is_train").select("uid", "mid", "score"))
    return predicted.where("prediction is not null and not isnan(prediction)").groupBy("uid", "mid").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def als_grid_holds(spark, sf):
    """Every setting's error is that of its own predictions, summed rating by rating; the best one has the least."""
    kept = {}

    def keep(rank, reg, predicted):
        kept[rank, reg] = stored(spark, predicted, "grid-predictions")
        return kept[rank, reg]

    measured = stored(spark, _grid(spark, sf, keep), "grid")
    test = lfm.hash_split(_ratings(spark, sf)).where("not is_train")
    errors = [
        test.join(predicted, ["uid", "mid"]).select(
            F.lit(rank).alias("rank"), F.lit(reg).alias("lambda"), F.pow(F.col("score") - F.col("prediction"), 2).alias("error")
        )
        for (rank, reg), predicted in kept.items()
    ]
    again = reduce(DataFrame.unionByName, errors).groupBy("rank", "lambda").agg(F.sqrt(F.avg("error")).alias("again"))
    best = lfm.best_setting(measured).select(F.col("rmse").alias("least"))
    sound = (F.abs(F.col("rmse") - F.col("again")) < 1e-9) & (F.col("rmse") > 0) & (F.col("again") >= F.col("least") - 1e-9)
    return measured.join(again, ["rank", "lambda"]).join(F.broadcast(best)).select("rank", F.col("lambda"), sound.alias("ok"))


def _predicted(ratings):
    value = (1 + F.pmod(F.col("uid") * 7 + F.col("mid") * 13, F.lit(5))).cast("double")
    return ratings.select("uid", "mid", value.alias("prediction"))


@query
def rmse_join(spark, sf):
    ratings = _ratings(spark, sf)
    return lfm.rmse(ratings, _predicted(ratings)).select(_r6("rmse"), "n_terms")


@query
def rmse_join_multiplicity(spark, sf):
    ratings = _ratings(spark, sf)
    return lfm.rmse(ratings, _predicted(ratings), multiplicity=True).select(_r6("rmse"), "n_terms")


# -- ingest ------------------------------------------------------------------------------------


@query
def log_filter(spark, sf):
    """Log lines through the streaming filter into a file sink."""
    events = fx.table(spark, sf, "events")
    stream = streams.file_source(spark, f"{sf}/events*.parquet", events.schema)
    out = scratch_path(spark, "forwarded")
    forwarded = streams.ratings_from_log(fx.events_as_log_lines(stream)).select("key", "value")
    streams.start_file_sink(
        forwarded, out, scratch_path(spark, "log-filter"), availableNow=True
    ).awaitTermination()
    return spark.read.schema("key string, value string").parquet(out)


@query
def rating_chain(spark, sf):
    """From log lines to rating events, in one go."""
    ratings, _ = streams.rating_chain(fx.events_as_log_lines(fx.table(spark, sf, "events")))
    return ratings


@query
def rating_rejects(spark, sf):
    """What the parser turns away when the filter is left out: the lines that announce no rating."""
    lines = fx.events_as_log_lines(fx.table(spark, sf, "events"))
    text = F.col("value")
    return streams.rejected_ratings(lines.withColumn("value", F.coalesce(after_marker(text), text)))


@query
def rating_parse(spark, sf):
    lines = fx.events_as_log_lines(fx.table(spark, sf, "events"))
    fields = rating_fields(after_marker(F.col("value")))
    parsed = lines.select("event_id", *fields)
    # Fields that cannot be parsed are shown as -1.
    return parsed.fillna(-1)


@query
def recent_entry_parse(spark, sf):
    recents = realtime.recent_ratings(fx.rating_events(spark, sf))
    entry = F.concat(F.lit(" "), F.concat_ws(" : ", "mid", "score"))
    return recents.select("uid", "rank", entry.alias("entry")).select(
        "uid", "rank", *recent_fields(F.col("entry"))
    )


@query
def rating_stream(spark, sf):
    """Messages through the streaming parser."""
    events = fx.table(spark, sf, "events")
    stream = fx.events_as_ratings(streams.file_source(spark, f"{sf}/events*.parquet", events.schema))
    messages = stream.select("event_id", fx.as_message(stream).alias("value"))
    parsed = streams.parse_ratings(messages)
    out = scratch_path(spark, "parsed")
    streams.start_file_sink(
        parsed, out, scratch_path(spark, "rating-stream"), availableNow=True
    ).awaitTermination()
    return spark.read.schema(parsed.schema).parquet(out)


# -- real time ---------------------------------------------------------------------------------


@query
def user_recent_ratings(spark, sf):
    recents = realtime.recent_ratings(fx.rating_events(spark, sf))
    return recents.select("uid", "rank", "event_id", "mid", "score", "timestamp")


@query
def user_recent_ratings_stream(spark, sf):
    """The same lists from streaming state."""
    events = fx.table(spark, sf, "events")
    stream = fx.events_as_ratings(streams.file_source(spark, f"{sf}/events*.parquet", events.schema))
    out = scratch_path(spark, "recents")
    recommender.start_recent_lists(
        stream, out, scratch_path(spark, "recents-state"), availableNow=True
    ).awaitTermination()
    lists = recommender.current(spark, out)
    zipped = F.arrays_zip("recent_ids", "recent_mids", "recent_scores")
    return lists.select("uid", F.posexplode(zipped).alias("pos", "x")).select(
        "uid",
        (F.col("pos") + 1).alias("rank"),
        F.col("x.recent_ids").alias("event_id"),
        F.col("x.recent_mids").alias("mid"),
        F.col("x.recent_scores").alias("score"),
    )


@query
def sim_matrix_flatten(spark, sf):
    """Nested item lists written, read back and flattened."""
    path = scratch_path(spark, "movie-recs")
    tables.overwrite(itemcf.neighbours_nested(_ratings(spark, sf)), path)
    return tables.load_similarity(spark, path).select("source", "target", _r6("score"))


def _seen(spark, sf):
    return _ratings(spark, sf).select("uid", F.col("mid").alias("item"))


def _recents(spark, sf):
    """Recent lists, stored because triggers and scores both read them."""
    return stored(spark, realtime.recent_ratings(fx.rating_events(spark, sf)), "recent-ratings")


def _newest(recents):
    return recents.where("rank = 1").select("uid", "mid")


@query
def user_recent_ratings_expiring(spark, sf):
    """The same lists from stored tables, with users that expire between four micro-batches and come back."""
    events = stored(spark, fx.rating_events(spark, sf), "events")
    path = scratch_path(spark, "expiring-lists")
    for i in range(4):
        recent_lists.add(events.where(F.pmod(F.xxhash64("event_id"), F.lit(4)) == i), path, 2 * i)
        recent_lists.add(events.limit(0), path, 2 * i + 1)  # a batch without anybody: all are idle
        recent_lists.expire(spark, path, idle=1)
    return recent_lists.current(spark, path).select("uid", "rank", "event_id", "mid", "score", "timestamp")


@query
def sim_candidates(spark, sf):
    similarity = content.similarity(_movies(spark, sf)).store()
    found = realtime.candidates(_newest(_recents(spark, sf)), similarity, _seen(spark, sf))
    return found.select("uid", "mid", "rank", "item", _r6("score"))


@query
def sim_candidates_flat(spark, sf):
    """Candidates from a flat similarity table (item CF lists)."""
    pairs = itemcf.neighbours(_ratings(spark, sf), k=50).select(
        F.col("mid1").alias("source"), F.col("mid2").alias("target"), "score"
    )
    found = realtime.candidates(_newest(_recents(spark, sf)), ItemSimilarity(pairs).store(), _seen(spark, sf))
    return found.select("uid", "mid", "rank", "item", _r6("score"))


@query
def realtime_scores(spark, sf):
    similarity = content.similarity(_movies(spark, sf)).store()
    recents = _recents(spark, sf)
    found = stored(
        spark, realtime.candidates(_newest(recents), similarity, _seen(spark, sf)), "candidates"
    )
    scored = realtime.scores(found, recents, similarity)
    return scored.select("uid", "item", _r6("score"))


@query
def stream_recs_current(spark, sf):
    """Events through the streaming recommender; newest list per user."""
    events = fx.table(spark, sf, "events")
    stream = fx.events_as_ratings(streams.file_source(spark, f"{sf}/events*.parquet", events.schema))
    similarity = content.similarity(_movies(spark, sf)).store()
    out = scratch_path(spark, "stream-recs")
    recommender.start_recommender(
        stream, lambda: similarity, lambda: _seen(spark, sf), out,
        scratch_path(spark, "stream-recs-state"), availableNow=True,
    ).awaitTermination()
    return _unnested(recommender.current(spark, out), "uid")


def _chain(spark, sf):
    """The whole chain over the event log: (recommendations, rejects), each a log of micro-batches."""
    events = fx.table(spark, sf, "events")
    lines = fx.events_as_broken_log_lines(streams.file_source(spark, f"{sf}/events*.parquet", events.schema))
    similarity = content.similarity(_movies(spark, sf)).store()
    out, rejects = scratch_path(spark, "chain-recs"), scratch_path(spark, "chain-rejects")
    recommender.start_chain(
        lines, lambda: similarity, lambda: _seen(spark, sf), out, rejects, scratch_path(spark, "chain-state"), availableNow=True
    ).awaitTermination()
    return out, rejects


@query
def chain_recs_current(spark, sf):
    """From log lines to the newest list per user, in one running query."""
    out, _ = _chain(spark, sf)
    return _unnested(recommender.current(spark, out), "uid")


@query
def chain_rejects(spark, sf):
    """What the same query turns away, by step."""
    _, rejects = _chain(spark, sf)
    return versions.rows(spark, rejects).select("event_id", "stage", "value")


# -- products known from documentation -----------------------------------------------------------


@query
def user_cf_neighbours(spark, sf):
    near = usercf.similar_users(_ratings(spark, sf))
    return near.select("uid", "rank", "other_uid", _r6("score"))


@query
def user_cf_recs(spark, sf):
    return usercf.recommend(_ratings(spark, sf)).select("uid", "rank", "mid", _r6("score"))


@query
def demographic_recs(spark, sf):
    profiles = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("uid"), "c_nationkey", "c_mktsegment"
    )
    recs = demographic.recommend(profiles, _ratings(spark, sf), ["c_nationkey", "c_mktsegment"])
    return recs.select("uid", "rank", "mid", "n_ratings", _r6("avg"))


@query
def keyword_search(spark, sf):
    found = search.keyword_search(fx.table(spark, sf, "documents"), SEARCH_TERMS)
    return found.select("doc_id", _r6("score"))


@query
def keyword_search_index(spark, sf):
    """Two edits, from a stored index."""
    index = search.build_index(fx.table(spark, sf, "documents"), max_edits=2)
    return index.search(SEARCH_TERMS).select("doc_id", _r6("score"))


@query
def more_like_this(spark, sf):
    seeds = fx.table(spark, sf, "benchmark").select(F.col("item_id").alias("seed_id"), "text")
    found = search.more_like_this(seeds, fx.table(spark, sf, "documents"))
    return found.select("seed_id", "rank", "doc_id", _r6("score"))
