"""Hand-computed cases for every decision that is easy to get wrong."""

import math

from pyspark.sql import functions as F

from kinora.functions.text import after_marker, has_marker, rating_fields, recent_fields
from kinora.functions.vectors import cosine
from kinora.operators.similar import ItemSimilarity
from kinora.operators.topk import from_nested, to_nested, top_k, top_unseen
from kinora.plans import content, demographic, itemcf, lfm, realtime, search, statistics, usercf
from kinora.sources import streams, tables

RATING = "uid int, mid int, score double, timestamp int"


def _ratings(spark, *rows):
    return spark.createDataFrame([(u, m, float(s), t) for u, m, s, t in rows], RATING)


def _movies(spark, *rows):
    return spark.createDataFrame(rows, "mid int, genres string")


def test_genre_is_a_substring_and_ties_go_to_the_smaller_id(spark):
    movies = _movies(spark, (1, "cold"), (2, "OLD|war"), (3, None), (4, "new"), (5, "old"))
    ratings = _ratings(spark, (1, 1, 4, 0), (1, 2, 4, 0), (1, 3, 5, 0), (1, 4, 5, 0))
    top = statistics.top_per_genre(movies, ratings, ["Old", "none"], k=1).collect()
    assert [(r.genre, r.mid, r.avg) for r in top] == [("Old", 1, 4.0)]
    both = statistics.top_per_genre(movies, ratings, ["Old"], k=5).collect()
    assert {r.mid for r in both} == {1, 2}  # unrated 5 and null 3 drop out


def test_month_boundary_is_utc_whatever_the_session_zone(spark):
    midnight = 1580515200  # 2020-02-01T00:00:00Z
    ratings = _ratings(spark, (1, 1, 3, midnight - 1), (1, 1, 3, midnight), (2, 1, 3, midnight))
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        rows = statistics.monthly_counts(ratings).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(r.yearmonth, r["count"]) for r in rows] == [(202002, 2), (202001, 1)]


def test_cooccurrence_counts_rows_or_users(spark):
    ratings = _ratings(spark, (1, 10, 3, 0), (1, 10, 4, 1), (1, 20, 3, 0), (2, 10, 3, 0), (2, 20, 1, 0))
    rows = {(r.mid1, r.mid2): r for r in itemcf.cooccurrence(ratings).collect()}
    assert (rows[10, 20].cocount, rows[10, 20].count1, rows[10, 20].count2) == (3, 3, 2)
    assert math.isclose(rows[20, 10].score, 3 / math.sqrt(6))
    users = {(r.mid1, r.mid2): r.cocount for r in itemcf.cooccurrence(ratings, distinct_users=True).collect()}
    assert users == {(10, 20): 2, (20, 10): 2}


def test_item_lists_are_cut_by_score_then_id(spark):
    ratings = _ratings(spark, *[(1, m, 3, 0) for m in (9, 7, 5, 3)])
    rows = itemcf.neighbours(ratings, k=2).where("mid1 = 5").orderBy("rank").collect()
    assert [r.mid2 for r in rows] == [3, 7]
    nested = itemcf.neighbours_nested(ratings, k=2)
    assert [x.mid for x in nested.where("mid = 5").first().recs] == [3, 7]


def test_zero_vectors_have_no_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0])], "a array<double>, b array<double>")
    assert df.select(cosine(F.col("a"), F.col("b")).alias("c")).first().c is None


def test_content_copies_unknown_words_and_null_genres(spark):
    movies = _movies(spark, (1, "a|b"), (2, "B|A"), (3, "c"), (4, None), (5, "a|b"), (6, "d"))
    similar = content.similarity(movies)
    lists = {(r.mid, r.other_mid) for r in similar.neighbours_of(movies).collect()}
    assert lists == {(1, 2), (2, 1), (1, 5), (5, 1), (2, 5), (5, 2)}
    top = similar.neighbours(1).orderBy("mid").collect()
    assert [(r.mid, r.other_mid) for r in top] == [(1, 2), (2, 1), (5, 1)]
    counts = {r.mid: (r.n_neighbours, round(r.mean_score, 9)) for r in similar.neighbour_counts().collect()}
    assert counts == {1: (2, 1.0), 2: (2, 1.0), 5: (2, 1.0)}


def test_identical_catalogue_has_no_similarity(spark):
    movies = _movies(spark, (1, "a"), (2, "a"))
    assert content.similarity(movies).pairs.count() == 0  # idf is zero everywhere


def test_content_equals_brute_force(spark, sf):
    import numpy as np
    from pyspark.ml.functions import vector_to_array

    from kinora.sources import fixtures as fx

    movies = fx.movies(spark, sf)
    tf = content.term_frequencies(content.words(movies))
    rows = content.fit_idf(tf).transform(tf).select("mid", vector_to_array("tfidf").alias("v")).collect()
    ids = np.array([r.mid for r in rows])
    unit = np.array([r.v for r in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    cos = unit @ unit.T
    want = {(ids[i], ids[j]) for i, j in zip(*np.nonzero(cos > 0.6)) if i != j}
    got = content.similarity(movies, block_size=20).neighbours_of(movies)
    assert {(r.mid, r.other_mid) for r in got.collect()} == want


def test_malformed_messages_are_rejected_not_fatal(spark):
    texts = ["1|2|3.5|100", "1|x|3|100", "1|2|3", "", "1| 2 |3|4"]
    messages = spark.createDataFrame(list(enumerate(texts)), "event_id long, value string")
    good = streams.parse_ratings(messages).orderBy("event_id").collect()
    assert [(r.event_id, r.uid, r.mid, r.score, r.timestamp) for r in good] == [(0, 1, 2, 3.5, 100), (4, 1, 2, 3.0, 4)]
    assert sorted(r.event_id for r in streams.rejected_ratings(messages).collect()) == [1, 2, 3]
    assert messages.select(*rating_fields(F.col("value"))).columns == ["uid", "mid", "score", "timestamp"]


def test_log_lines(spark):
    mark = "MOVIE_RATING_PREFIX:"
    texts = [f"x {mark} 1|2|3|4 ", f"{mark}a{mark}b", f"x {mark}", "no marker", None]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    got = streams.ratings_from_log(lines).collect()
    assert [(r.key, r.value) for r in got] == [("logProcessor", "1|2|3|4"), ("logProcessor", "a")]
    raw = lines.select(F.col("value").cast("binary").alias("value"))
    assert streams.ratings_from_log(raw, stamp=True).columns == ["key", "value", "processed_at"]
    assert lines.where(has_marker(F.col("value"))).select(after_marker(F.col("value"))).count() == 3


def test_recent_entries(spark):
    df = spark.createDataFrame([(" 12 : 3.5 ",), ("x:1",)], "entry string").select(*recent_fields(F.col("entry")))
    assert [tuple(r) for r in df.collect()] == [(12, 3.5), (None, 1.0)]


def test_score_formula(spark):
    pairs = spark.createDataFrame(
        [(1, m, 0.8) for m in (11, 12, 13)] + [(1, 14, 0.7), (2, 11, 0.9), (3, 14, 0.75)],
        "source int, target int, score double",
    )
    recents = spark.createDataFrame([(7, 11, 5.0), (7, 12, 4.0), (7, 13, 3.0), (7, 14, 1.0)], "uid int, mid int, score double")
    items = spark.createDataFrame([(7, 1), (7, 2), (7, 3), (7, 4)], "uid int, item int")
    got = {r.item: r.score for r in realtime.scores(items, recents, ItemSimilarity(pairs)).collect()}
    assert math.isclose(got[1], 0.8 * 4 + math.log10(2) - math.log10(1))  # 0.7 is not above 0.7
    assert math.isclose(got[2], 4.5)
    assert math.isclose(got[3], 0.75)
    assert 4 not in got


def test_ten_liked_ratings_add_one(spark):
    pairs = spark.createDataFrame([(1, 11, 1.0)], "source int, target int, score double")
    recents = spark.createDataFrame([(7, 11, 4.0)] * 10, "uid int, mid int, score double")
    items = spark.createDataFrame([(7, 1)], "uid int, item int")
    assert math.isclose(realtime.scores(items, recents, ItemSimilarity(pairs)).first().score, 5.0)


def test_candidates_drop_rated_before_the_cut(spark):
    pairs = spark.createDataFrame(
        [(1, m, 1.0 - m / 1000) for m in range(2, 400)], "source int, target int, score double"
    )
    seen = spark.createDataFrame([(7, m) for m in range(2, 390)], "uid int, item int")
    triggers = spark.createDataFrame([(7, 1), (8, 1), (9, 999)], "uid int, mid int")
    got = realtime.candidates(triggers, ItemSimilarity(pairs), seen, k=20).collect()
    assert sorted(r.item for r in got if r.uid == 7) == list(range(390, 400))
    assert sorted(r.item for r in got if r.uid == 8) == list(range(2, 22))
    assert not [r for r in got if r.uid == 9]  # unknown movie: nothing, no failure


def test_grouped_candidates_skip_the_trigger_itself(spark):
    pairs = spark.createDataFrame([(1, 1, 1.0), (1, 4, 0.9), (4, 1, 0.9)], "source int, target int, score double")
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4)], "mid int, source int")
    seen = spark.createDataFrame([(7, 3)], "uid int, item int")
    triggers = spark.createDataFrame([(7, 2)], "uid int, mid int")
    got = realtime.candidates(triggers, ItemSimilarity(pairs, members), seen).orderBy("rank").collect()
    assert [(r.rank, r.item, r.score) for r in got] == [(1, 1, 1.0), (2, 4, 0.9)]


def test_top_unseen_grows_until_complete(spark):
    lists = spark.createDataFrame([("a", i) for i in range(100)], "list_key string, item int")
    calls = []

    def prefix(n, keys):
        calls.append(n)
        return top_k(lists.join(keys, "list_key", "left_semi"), ["list_key"], ["item"], n, rank="place").drop("place")

    seen = spark.createDataFrame([(1, i) for i in range(60)], "uid int, item int")
    requests = spark.createDataFrame([(1, "a"), (2, "a")], "uid int, list_key string")
    got = top_unseen(requests, prefix, seen, ["item"], 3).collect()
    assert sorted((r.uid, r.item) for r in got) == [(1, 60), (1, 61), (1, 62), (2, 0), (2, 1), (2, 2)]
    assert calls == [9, 63]  # k more than the 60 seen items are always enough


def test_users_without_candidates_keep_an_empty_list(spark):
    pairs = spark.createDataFrame([(1, 2, 0.9)], "source int, target int, score double")
    seen = spark.createDataFrame([(7, 2)], "uid int, item int")
    triggers = spark.createDataFrame([(7, 1)], "uid int, mid int")
    recents = spark.createDataFrame([(7, 1, 5.0)], "uid int, mid int, score double")
    rows = realtime.recommendations(triggers, recents, ItemSimilarity(pairs), seen).collect()
    assert [(r.uid, r.recs) for r in rows] == [(7, [])]


def test_rmse_multiplicity(spark):
    actual = spark.createDataFrame([(1, 1, 5.0), (1, 1, 3.0), (1, 2, 4.0), (2, 2, 1.0)], "uid int, mid int, score double")
    predicted = spark.createDataFrame([(1, 1, 4.0), (1, 1, 4.0), (1, 2, 2.0)], "uid int, mid int, prediction double")
    once = lfm.rmse(actual, predicted).first()
    assert once.n_terms == 3 and math.isclose(once.rmse, math.sqrt(6 / 3))
    many = lfm.rmse(actual, predicted, multiplicity=True).first()
    assert many.n_terms == 5 and math.isclose(many.rmse, math.sqrt((2 + 2 + 4) / 5))


def test_user_cf(spark):
    ratings = _ratings(spark, (1, 1, 5, 0), (1, 2, 5, 0), (2, 1, 5, 0), (2, 2, 5, 0), (2, 3, 4, 0), (3, 9, 1, 0))
    got = usercf.recommend(ratings).collect()
    assert [(r.uid, r.mid, round(r.score, 9)) for r in got if r.uid == 1] == [(1, 3, 4.0)]
    assert not [r for r in got if r.uid == 3]


def test_demographic(spark):
    profiles = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "uid int, grp string")
    ratings = _ratings(spark, (1, 1, 5, 0), (2, 1, 5, 0), (2, 2, 4, 0), (3, 3, 5, 0))
    got = {(r.uid, r.mid) for r in demographic.recommend(profiles, ratings, ["grp"]).collect()}
    assert got == {(1, 2)}


def test_search(spark):
    docs = spark.createDataFrame(
        [(1, "Water, water!"), (2, "wate r"), (3, "fire"), (4, "wader")], "doc_id long, text string"
    )
    assert [r.doc_id for r in search.keyword_search(docs, ["water"], max_edits=1).collect()] == [1, 2, 4]
    assert [r.doc_id for r in search.keyword_search(docs, ["water"], max_edits=0).collect()] == [1]
    seeds = spark.createDataFrame([(1, "fire water")], "seed_id long, text string")
    assert [r.doc_id for r in search.more_like_this(seeds, docs).orderBy("rank").collect()] == [1, 3]


def test_nested_round_trip(spark):
    flat = spark.createDataFrame([(1, 5, 0.5), (1, 6, 0.9), (2, 5, 0.1)], "owner int, mid int, score double")
    nested = to_nested(top_k(flat, ["owner"], [F.desc("score")], 10), "owner")
    assert [x.mid for x in nested.where("owner = 1").first().recs] == [6, 5]
    assert from_nested(nested, "owner").exceptAll(flat).count() == 0


def test_loaders_cast_and_drop_incomplete_rows(spark, tmp_path):
    path = str(tmp_path / "ratings.json")
    spark.createDataFrame([("1", "2", "3.5", "7"), (None, "2", "1", "7")], "uid string, mid string, score string, timestamp string").write.json(path)
    text = spark.read.json(path)
    assert [tuple(r) for r in tables.clean_ratings(text).collect()] == [(1, 2, 3.5, 7)]
    csv = str(tmp_path / "ratings.csv")
    _ratings(spark, (1, 2, 3, 4)).write.csv(csv, header=True)
    assert [tuple(r) for r in tables.load_ratings(spark, csv, "csv", header=True).collect()] == [(1, 2, 3.0, 4)]
    movies = tables.clean_movies(_movies(spark, (1, "a")))
    assert len(movies.columns) == 10 and movies.first().actors == ""
