"""The same results in plain SQL over the same tables, written without this package's shortcuts."""

from kinora.queries import FACTOR_THRESHOLD, FIXTURE_GENRES, GRID_RANKS, SEARCH_TERMS

# Bucket of each catalogue token under a 50-bucket hash.
TOKEN_BUCKETS = {
    "anvil": 44, "blue": 18, "bolt": 40, "cold": 20, "economy": 17, "gear": 45, "gizmo": 42,
    "hot": 43, "large": 22, "medium": 42, "new": 35, "old": 33, "plate": 25, "promo": 49, "red": 2,
    "ring": 46, "rod": 32, "small": 22, "standard": 17, "widget": 19,
}

RATINGS = """ratings AS (
  SELECT CAST(o_custkey AS INTEGER) AS uid, CAST(l_partkey AS INTEGER) AS mid,
         CAST(ceil(l_quantity / 10) AS DOUBLE) AS score, CAST(floor(epoch(l_shipdate)) AS INTEGER) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

MOVIES = """movies AS (
  SELECT CAST(p_partkey AS INTEGER) AS mid, p_name AS name, p_brand AS language,
         concat_ws('|', p_type, replace(p_name, ' ', '|')) AS genres
  FROM part)"""

AVERAGES = 'averages AS (SELECT mid, avg(score) AS "avg" FROM ratings GROUP BY mid)'

EVENTS = """rating_events AS (
  SELECT event_id, CAST(user_id AS INTEGER) AS uid, CAST(json_extract_string(props, '$.k') AS INTEGER) AS mid,
         CAST(1 + (CAST(floor(value) AS INTEGER) % 5 + 5) % 5 AS DOUBLE) AS score,
         CAST(floor(epoch(ts)) AS INTEGER) AS "timestamp", event_type
  FROM events)"""

RECENTS = """recents AS (
  SELECT * FROM (
    SELECT uid, CAST(row_number() OVER (PARTITION BY uid ORDER BY "timestamp" DESC, event_id DESC) AS INTEGER) AS rank,
           event_id, mid, score, "timestamp" FROM rating_events)
  WHERE rank <= 20)"""

_values = ", ".join(f"('{t}', {b})" for t, b in TOKEN_BUCKETS.items())
TFIDF = f"""buckets(token, bucket) AS (VALUES {_values}),
tokens AS (
  SELECT mid, unnest(string_split(lower(replace(genres, '|', ' ')), ' ')) AS token,
         unnest(range(len(string_split(genres, '|')))) AS pos FROM movies),
tf AS (
  SELECT mid, CAST(bucket AS INTEGER) AS bucket, CAST(count(*) AS DOUBLE) AS tf_count
  FROM tokens JOIN buckets USING (token) GROUP BY mid, bucket),
idf AS (
  SELECT bucket, count(*) AS df, ln(((SELECT count(*) FROM movies) + 1.0) / (count(*) + 1.0)) AS idf
  FROM tf GROUP BY bucket),
weights AS (SELECT mid, bucket, tf_count * idf AS weight FROM tf JOIN idf USING (bucket)),
norms AS (SELECT mid, sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY mid),
sims AS (
  SELECT * FROM (
    SELECT d.mid, d.other_mid, dot / (a.norm * b.norm) AS score
    FROM (SELECT a.mid, b.mid AS other_mid, sum(a.weight * b.weight) AS dot
          FROM weights a JOIN weights b USING (bucket) WHERE a.mid <> b.mid GROUP BY a.mid, b.mid) d
    JOIN norms a ON a.mid = d.mid JOIN norms b ON b.mid = d.other_mid)
  WHERE score > 0.6),
bags AS (SELECT mid, list_sort(list(token)) AS bag FROM tokens GROUP BY mid),
grouped AS (SELECT mid, min(mid) OVER (PARTITION BY bag) AS group_mid, count(*) OVER (PARTITION BY bag) AS n FROM bags)"""

CONTENT_TOP20 = """SELECT mid, rank, other_mid, round(score, 6) AS score FROM (
  SELECT mid, other_mid, score,
         CAST(row_number() OVER (PARTITION BY mid ORDER BY round(score, 9) DESC, other_mid) AS INTEGER) AS rank
  FROM sims) WHERE rank <= 20"""

ITEM_PAIRS = """counts AS (SELECT mid, count(*) AS n FROM ratings GROUP BY mid),
pairs AS (
  SELECT a.mid AS mid1, b.mid AS mid2, count(*) AS cocount
  FROM ratings a JOIN ratings b USING (uid) WHERE a.mid <> b.mid GROUP BY a.mid, b.mid),
item_sims AS (
  SELECT mid1, mid2, cocount, c1.n AS count1, c2.n AS count2,
         cocount / sqrt(CAST(c1.n AS DOUBLE) * CAST(c2.n AS DOUBLE)) AS score
  FROM pairs JOIN counts c1 ON c1.mid = mid1 JOIN counts c2 ON c2.mid = mid2),
item_ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY mid1 ORDER BY round(score, 9) DESC, mid2) AS INTEGER) AS rank
  FROM item_sims)"""

CANDIDATES = """newest AS (SELECT uid, mid FROM recents WHERE rank = 1),
unseen AS (
  SELECT n.uid, n.mid, l.other_mid AS item, l.score
  FROM newest n JOIN lists l ON l.mid = n.mid
  WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.uid = n.uid AND r.mid = l.other_mid)),
candidates AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY uid ORDER BY round(score, 9) DESC, item) AS INTEGER) AS rank
    FROM unseen) WHERE rank <= 20)"""

CANDIDATE_ROWS = "SELECT uid, mid, rank, item, round(score, 6) AS score FROM candidates"

SCORES = """scored AS (
  SELECT c.uid, c.item,
         avg(s.score * r.score)
         + ln(greatest(count(*) FILTER (r.score > 3), 1)) / ln(10)
         - ln(greatest(count(*) FILTER (r.score <= 3), 1)) / ln(10) AS score
  FROM candidates c JOIN recents r ON r.uid = c.uid JOIN sims s ON s.mid = c.item AND s.other_mid = r.mid
  WHERE s.score > 0.7 GROUP BY c.uid, c.item)"""

FACTORS = """factors AS (
  SELECT CAST(vec_id AS INTEGER) AS mid, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
centred AS (SELECT mid, v, [x - list_sum(v) / len(v) for x in v] AS c FROM factors)"""


def _vector_pairs(column):
    return f"""vector_pairs AS (
  SELECT a.mid, b.mid AS other_mid, list_cosine_similarity(a.{column}, b.{column}) AS score
  FROM centred a JOIN centred b ON a.mid <> b.mid)"""


LINES = """lines AS (
  SELECT event_id, event_type, concat_ws('|', uid, mid, CAST(score AS VARCHAR), "timestamp") AS message,
         event_type IN ('view', 'purchase', 'click') AS rated,
         event_type IN ('error', 'signup') AS plain FROM rating_events)"""

USER_PAIRS = """vectors AS (SELECT uid, mid, avg(score) AS w FROM ratings GROUP BY uid, mid),
lengths AS (SELECT uid, sum(w * w) AS scale FROM vectors GROUP BY uid),
user_sims AS (
  SELECT d.uid, d.other_uid, dot / sqrt(a.scale * b.scale) AS score
  FROM (SELECT a.uid, b.uid AS other_uid, sum(a.w * b.w) AS dot
        FROM vectors a JOIN vectors b USING (mid) WHERE a.uid <> b.uid GROUP BY a.uid, b.uid) d
  JOIN lengths a ON a.uid = d.uid JOIN lengths b ON b.uid = d.other_uid),
near AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY uid ORDER BY round(score, 9) DESC, other_uid) AS INTEGER) AS rank
    FROM user_sims) WHERE rank <= 20)"""

DOC_TOKENS = """doc_tokens AS (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS token FROM documents),
postings AS (SELECT doc_id, token, count(*) AS tf FROM doc_tokens WHERE token <> '' GROUP BY doc_id, token),
doc_idf AS (
  SELECT token, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) AS idf FROM postings GROUP BY token)"""


def _with(*parts):
    *ctes, body = parts
    return f"WITH {', '.join(ctes)} {body}"


def _genre_top(tagged):
    return _with(RATINGS, MOVIES, AVERAGES, f"""
SELECT genre, rank, mid, round("avg", 6) AS "avg" FROM (
  SELECT genre, mid, "avg",
         CAST(row_number() OVER (PARTITION BY genre ORDER BY round("avg", 9) DESC, mid) AS INTEGER) AS rank
  FROM ({tagged})) WHERE rank <= 10""")


_genres = ", ".join(f"('{g}')" for g in FIXTURE_GENRES)
_substring = f"""SELECT genre, mid, "avg" FROM (VALUES {_genres}) g(genre) JOIN movies ON contains(lower(genres), lower(genre))
  JOIN averages USING (mid)"""
_exact = """SELECT DISTINCT genre, mid, "avg" FROM (
  SELECT mid, unnest(string_split(genres, '|')) AS genre FROM movies) JOIN averages USING (mid)"""

_predicted = """predicted AS (
  SELECT DISTINCT uid, mid, CAST(1 + (uid * 7 + mid * 13) % 5 AS DOUBLE) AS prediction FROM ratings)"""
_near_terms = " OR ".join(f"levenshtein(token, '{t}') <= 1" for t in SEARCH_TERMS)

ORACLES = {
    "ratings_load": _with(RATINGS, "SELECT * FROM ratings"),
    "movies_load": _with(MOVIES, """
SELECT mid, name, language, genres, '' AS descri, '' AS timelong, '' AS issue, '' AS shoot,
       '' AS actors, '' AS directors FROM movies"""),
    "sink_overwrite_roundtrip": _with(RATINGS, AVERAGES, 'SELECT mid, round("avg", 6) AS "avg" FROM averages'),
    "movie_rating_count": _with(RATINGS, 'SELECT mid, count(*) AS "count" FROM ratings GROUP BY mid'),
    "monthly_hot_movies": _with(RATINGS, """
SELECT mid, count(*) AS "count", CAST(strftime(to_timestamp("timestamp") AT TIME ZONE 'UTC', '%Y%m') AS INTEGER) AS yearmonth
FROM ratings GROUP BY mid, yearmonth ORDER BY yearmonth DESC, "count" DESC, mid"""),
    "movie_avg_score": _with(RATINGS, AVERAGES, 'SELECT mid, round("avg", 6) AS "avg" FROM averages'),
    "movie_with_score": _with(RATINGS, MOVIES, AVERAGES, """
SELECT mid, name, genres, round("avg", 6) AS "avg" FROM movies JOIN averages USING (mid)"""),
    "genre_top10": _genre_top(_substring),
    "genre_top10_exploded": _genre_top(_exact),
    "genre_top10_nested": f'SELECT genre AS key, rank, mid, "avg" AS score FROM ({_genre_top(_substring)})',
    "category_exact_match": _with(MOVIES, """
SELECT mid, name, genres FROM movies WHERE list_contains(string_split(genres, '|'), 'old')"""),
    "item_cooccurrence": _with(RATINGS, ITEM_PAIRS, "SELECT mid1, mid2, cocount, count1, count2 FROM item_sims"),
    "item_cf_similarity": _with(RATINGS, ITEM_PAIRS, "SELECT mid1, mid2, round(score, 6) AS score FROM item_sims"),
    "item_cf_topk": _with(RATINGS, ITEM_PAIRS, """
SELECT mid1, rank, mid2, cocount, count1, count2, round(score, 6) AS score FROM item_ranked WHERE rank <= 10"""),
    "item_cf_topk_nested": _with(RATINGS, ITEM_PAIRS, """
SELECT mid1 AS key, rank, mid2 AS mid, round(score, 6) AS score FROM item_ranked WHERE rank <= 10"""),
    "vector_norms": _with(FACTORS, """
SELECT mid, round(list_sum([abs(x) for x in v]), 6) AS l1,
       round(sqrt(list_sum([x * x for x in v])), 6) AS l2,
       round(pow(list_sum([pow(abs(x), 3) for x in v]), 1.0 / 3), 6) AS l3,
       round(list_dot_product(v, v), 6) AS self_dot,
       round(pow(list_distance(v, c), 2), 6) AS centring_distance,
       round(list_cosine_similarity(v, c), 6) AS centring_cosine FROM centred"""),
    "factor_similarity": _with(FACTORS, _vector_pairs("v"), f"""
SELECT mid, other_mid, round(score, 6) AS score FROM vector_pairs WHERE score > {FACTOR_THRESHOLD}"""),
    "factor_top10": _with(FACTORS, _vector_pairs("v"), """
SELECT mid, rank, other_mid, round(score, 6) AS score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY mid ORDER BY round(score, 9) DESC, other_mid) AS INTEGER) AS rank
  FROM vector_pairs) WHERE rank <= 10"""),
    "pearson_similarity": _with(FACTORS, _vector_pairs("c"), f"""
SELECT mid, other_mid, round(score, 6) AS score FROM vector_pairs WHERE score > {FACTOR_THRESHOLD}"""),
    "content_tokens": _with(MOVIES, TFIDF, "SELECT mid, CAST(pos AS INTEGER) AS pos, token FROM tokens"),
    "content_tf": _with(MOVIES, TFIDF, "SELECT mid, bucket, tf_count FROM tf"),
    "content_idf": _with(MOVIES, TFIDF, "SELECT bucket, df, round(idf, 6) AS idf FROM idf"),
    "content_tfidf": _with(MOVIES, TFIDF, "SELECT mid, bucket, round(weight, 6) AS weight FROM weights"),
    "content_groups": _with(MOVIES, TFIDF, "SELECT mid, group_mid FROM grouped"),
    "content_recs": _with(MOVIES, TFIDF, """
SELECT mid AS group_mid, other_mid AS other_group_mid, round(score, 6) AS score FROM sims
WHERE mid IN (SELECT group_mid FROM grouped) AND other_mid IN (SELECT group_mid FROM grouped)
UNION ALL SELECT DISTINCT group_mid, group_mid, 1.0::DOUBLE FROM grouped WHERE n > 1"""),
    "content_neighbour_counts": _with(MOVIES, TFIDF, """
SELECT mid, count(*) AS n_neighbours, round(avg(score), 6) AS mean_score FROM sims GROUP BY mid"""),
    "content_top20": _with(MOVIES, TFIDF, CONTENT_TOP20),
    "content_recs_nested": f"SELECT mid AS key, rank, other_mid AS mid, score FROM ({_with(MOVIES, TFIDF, CONTENT_TOP20)})",
    "user_item_candidates": _with(RATINGS, """
SELECT users, items, users * items AS candidates FROM (
  SELECT count(DISTINCT uid) AS users, count(DISTINCT mid) AS items FROM ratings)"""),
    "ratings_split": _with(RATINGS, "SELECT *, substr(md5(concat_ws('|', uid, mid)), 1, 2) < 'cd' AS is_train FROM ratings"),
    "rmse_join": _with(RATINGS, _predicted, """
SELECT round(sqrt(avg((score - prediction) * (score - prediction))), 6) AS rmse, count(*) AS n_terms
FROM ratings JOIN predicted USING (uid, mid)"""),
    "rmse_join_multiplicity": _with(RATINGS, """
predicted AS (SELECT uid, mid, CAST(1 + (uid * 7 + mid * 13) % 5 AS DOUBLE) AS prediction FROM ratings)""", """
SELECT round(sqrt(avg((score - prediction) * (score - prediction))), 6) AS rmse, count(*) AS n_terms
FROM ratings JOIN predicted USING (uid, mid)"""),
    "log_filter": _with(EVENTS, LINES, "SELECT 'logProcessor' AS key, message AS value FROM lines WHERE rated"),
    "rating_parse": _with(EVENTS, LINES, """
SELECT e.event_id, CASE WHEN rated THEN uid ELSE -1 END AS uid, CASE WHEN rated THEN mid ELSE -1 END AS mid,
       CASE WHEN rated THEN score ELSE -1 END AS score, CASE WHEN rated THEN "timestamp" ELSE -1 END AS "timestamp"
FROM rating_events e JOIN lines l USING (event_id) WHERE rated OR plain"""),
    "recent_entry_parse": _with(EVENTS, RECENTS, "SELECT uid, rank, mid, score FROM recents"),
    "rating_stream": _with(EVENTS, 'SELECT event_id, uid, mid, score, "timestamp" FROM rating_events'),
    "user_recent_ratings": _with(EVENTS, RECENTS, "SELECT * FROM recents"),
    "user_recent_ratings_stream": _with(EVENTS, RECENTS, "SELECT uid, rank, event_id, mid, score FROM recents"),
    "sim_matrix_flatten": _with(RATINGS, ITEM_PAIRS, """
SELECT mid1 AS source, mid2 AS target, round(score, 6) AS score FROM item_ranked WHERE rank <= 10"""),
    "sim_candidates": _with(
        RATINGS, MOVIES, EVENTS, RECENTS, TFIDF, "lists AS (SELECT * FROM sims)", CANDIDATES, CANDIDATE_ROWS),
    "sim_candidates_flat": _with(
        RATINGS, EVENTS, RECENTS, ITEM_PAIRS,
        "lists AS (SELECT mid1 AS mid, mid2 AS other_mid, score FROM item_ranked WHERE rank <= 50)",
        CANDIDATES, CANDIDATE_ROWS),
    "realtime_scores": _with(
        RATINGS, MOVIES, EVENTS, RECENTS, TFIDF, "lists AS (SELECT * FROM sims)", CANDIDATES, SCORES,
        "SELECT uid, item, round(score, 6) AS score FROM scored"),
    "stream_recs_current": _with(
        RATINGS, MOVIES, EVENTS, RECENTS, TFIDF, "lists AS (SELECT * FROM sims)", CANDIDATES, SCORES, """
SELECT n.uid AS key, CASE WHEN s.uid IS NOT NULL THEN CAST(row_number() OVER
         (PARTITION BY n.uid ORDER BY round(s.score, 9) DESC, s.item) AS INTEGER) END AS rank,
       s.item AS mid, round(s.score, 6) AS score
FROM newest n LEFT JOIN scored s ON s.uid = n.uid"""),
    "user_cf_neighbours": _with(RATINGS, USER_PAIRS, "SELECT uid, rank, other_uid, round(score, 6) AS score FROM near"),
    "user_cf_recs": _with(RATINGS, USER_PAIRS, """
votes AS (
  SELECT n.uid, v.mid, sum(n.score * v.w) / sum(n.score) AS score
  FROM near n JOIN vectors v ON v.uid = n.other_uid
  WHERE NOT EXISTS (SELECT 1 FROM vectors o WHERE o.uid = n.uid AND o.mid = v.mid)
  GROUP BY n.uid, v.mid)""", """
SELECT uid, rank, mid, round(score, 6) AS score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY uid ORDER BY round(score, 9) DESC, mid) AS INTEGER) AS rank FROM votes)
WHERE rank <= 10"""),
    "demographic_recs": _with(RATINGS, """
profiles AS (SELECT CAST(c_custkey AS INTEGER) AS uid, c_nationkey, c_mktsegment FROM customer),
popular AS (
  SELECT c_nationkey, c_mktsegment, mid, count(*) AS n_ratings, avg(score) AS "avg"
  FROM ratings JOIN profiles USING (uid) GROUP BY ALL)""", """
SELECT uid, rank, mid, n_ratings, round("avg", 6) AS "avg" FROM (
  SELECT uid, mid, n_ratings, "avg",
         CAST(row_number() OVER (PARTITION BY uid ORDER BY n_ratings DESC, round("avg", 9) DESC, mid) AS INTEGER) AS rank
  FROM profiles u JOIN popular USING (c_nationkey, c_mktsegment)
  WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.uid = u.uid AND r.mid = popular.mid))
WHERE rank <= 10"""),
    "keyword_search": _with(DOC_TOKENS, f"""
SELECT doc_id, round(score, 6) AS score FROM (
  SELECT doc_id, sum(tf * idf) AS score FROM postings JOIN doc_idf USING (token) WHERE {_near_terms} GROUP BY doc_id)
ORDER BY round(score, 9) DESC, doc_id LIMIT 10"""),
    "more_like_this": _with(DOC_TOKENS, """
seed_tokens AS (
  SELECT item_id AS seed_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS token FROM benchmark),
seed_weights AS (
  SELECT seed_id, token, count(*) * any_value(idf) AS weight, any_value(idf) AS idf
  FROM seed_tokens JOIN doc_idf USING (token) GROUP BY seed_id, token),
heaviest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY round(weight, 9) DESC, token) AS place FROM seed_weights)
  WHERE place <= 25)""", """
SELECT seed_id, rank, doc_id, round(score, 6) AS score FROM (
  SELECT seed_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY seed_id ORDER BY round(score, 9) DESC, doc_id) AS INTEGER) AS rank
  FROM (SELECT seed_id, doc_id, sum(weight * tf * h.idf) AS score
        FROM postings JOIN heaviest h USING (token) GROUP BY seed_id, doc_id))
WHERE rank <= 10"""),
}

# Factor models: the answers that any right model has.
_USERS_HOLD = f"WITH {RATINGS} SELECT DISTINCT uid, true AS ok FROM ratings"
ORACLES.update(
    als_normal_equations=f"WITH {RATINGS} SELECT uid, count(*) AS n_ratings, true AS ok FROM ratings GROUP BY uid",
    als_user_recs_hold=_USERS_HOLD,
    als_unseen_recs_hold=_USERS_HOLD,
    als_nested_recs_hold=_USERS_HOLD,
    als_item_similarity_hold=f"WITH {RATINGS} SELECT DISTINCT mid, true AS ok FROM ratings",
    als_predicted_pairs=f"""WITH {RATINGS},
split AS (SELECT uid, mid, substr(md5(concat_ws('|', uid, mid)), 1, 2) < 'cd' AS is_train FROM ratings)
SELECT uid, mid, count(*) AS n FROM split
WHERE NOT is_train AND uid IN (SELECT uid FROM split WHERE is_train) AND mid IN (SELECT mid FROM split WHERE is_train)
GROUP BY uid, mid""",
    als_grid_holds=f"""SELECT CAST(r AS INTEGER) AS rank, CAST(l AS DOUBLE) AS lambda, true AS ok
FROM (SELECT unnest([{', '.join(map(str, GRID_RANKS))}]) AS r), (SELECT unnest([0.01, 0.1, 1.0]) AS l)""",
)

ORACLES.update(
    rating_chain=_with(EVENTS, LINES, """
SELECT event_id, uid, mid, score, "timestamp" FROM rating_events JOIN lines USING (event_id) WHERE rated"""),
    rating_rejects="""
SELECT event_id, 'INFO app - ' || event_type AS value FROM events WHERE event_type IN ('error', 'signup')""",
)

_RATED = EVENTS.replace("FROM events)", "FROM events WHERE event_type IN ('view', 'purchase', 'click'))")
ORACLES.update(
    chain_recs_current=ORACLES["stream_recs_current"].replace(EVENTS, _RATED),
    chain_rejects="""
SELECT event_id, CASE event_type WHEN 'error' THEN 'filter' ELSE 'parse' END AS stage,
       CASE event_type WHEN 'error' THEN 'INFO app - MOVIE_RATING_PREFIX:' ELSE user_id || '|signup' END AS value
FROM events WHERE event_type IN ('error', 'signup')""",
)

ORACLES["keyword_search_index"] = ORACLES["keyword_search"].replace("<= 1", "<= 2")

ORACLES["item_cooccurrence_incremental"] = ORACLES["item_cooccurrence"]

_EXACT = TFIDF.replace(f"buckets(token, bucket) AS (VALUES {_values}),\n", "").replace(
    "CAST(bucket AS INTEGER) AS bucket", "token AS bucket").replace("JOIN buckets USING (token) GROUP BY mid, bucket", "GROUP BY mid, token")
ORACLES.update(
    content_recs_exact=ORACLES["content_recs"].replace(TFIDF, _EXACT),
    item_cf_summary=_with(RATINGS, ITEM_PAIRS, """
SELECT mid1 AS mid, count(*) AS n_neighbours, CAST(sum(cocount) AS BIGINT) AS cocounts, max(cocount) AS best_cocount,
       round(avg(score), 6) AS mean_score FROM item_sims GROUP BY mid1"""),
)
ORACLES["user_recent_ratings_expiring"] = ORACLES["user_recent_ratings"]
