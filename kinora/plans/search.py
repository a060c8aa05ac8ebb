"""Text search over whole texts: fuzzy keywords and more-like-this, scored by TF-IDF."""

from functools import reduce

from pyspark.sql import functions as F

from kinora.functions.text import search_tokens
from kinora.operators.impact import FOUND, SeedIndex, best_of_task, count_terms
from kinora.operators.topk import top_k
from kinora.session import stored

TOP_DOCS = 10
TOP_TERMS = 25
RANK_DIGITS = 9
#: Tokens up to this length are found by their deletions; the few longer ones are compared with every term.
LONGEST_INDEXED = 40
#: Rows (seed, token) of a block of seeds; each block is a pass over the documents.
SEED_BLOCK = 1 << 17


def _postings(tokens, key):
    return tokens.groupBy(key, "token").agg(F.count(F.lit(1)).alias("tf"))


def _idf(postings, docs):
    """(token, idf) with idf = ln((N + 1) / (df + 1)); N is a scalar subquery."""
    n_docs = docs.agg(F.count(F.lit(1)).alias("n_docs")).scalar()
    frequency = postings.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    return frequency.select("token", F.ln((n_docs + 1) / (F.col("df") + 1)).alias("idf"))


def deletions(token, edits):
    """Column: what up to ``edits`` deletions leave of a token, itself included.

    Two strings within that many edits have one of these in common.
    """
    variants = F.array(token)
    for _ in range(edits):
        places = lambda v: F.sequence(F.lit(1), F.greatest(F.length(v), F.lit(1)))
        shorter = F.transform(
            variants, lambda v: F.transform(places(v), lambda i: F.concat(F.substr(v, F.lit(1), i - 1), F.substr(v, i + 1)))
        )
        variants = F.array_distinct(F.concat(variants, F.flatten(shorter)))
    return variants


def _asked(spark, terms, max_edits):
    """(term, variant) of the query terms; as long as the query is."""
    asked = spark.createDataFrame([(t,) for t in sorted(set(terms))], "term string")
    return asked.select("term", F.explode(deletions(F.col("term"), max_edits)).alias("variant"))


def _close(pairs, max_edits):
    """The tokens of (token, term) pairs that are within the edits: one comparison per distinct pair."""
    near = pairs.distinct().where(F.levenshtein("token", "term", max_edits) >= 0)
    return near.select("token").distinct()


def _length_fits(terms, max_edits):
    sizes = [len(t) for t in terms] or [-1 - max_edits]
    return lambda token: F.length(token).between(min(sizes) - max_edits, max(sizes) + max_edits)


def near_tokens(words, terms, max_edits):
    """The tokens of ``words`` (token, each once) within ``max_edits`` edits of a term, by their common deletions."""
    fits, asked = _length_fits(terms, max_edits), _asked(words.sparkSession, terms, max_edits)
    variants = words.where(fits(F.col("token"))).select("token", F.explode(deletions(F.col("token"), max_edits)).alias("variant"))
    return _close(variants.join(F.broadcast(asked), "variant").select("token", "term"), max_edits)


def _keyword_scores(postings, idf, k):
    scored = postings.join(idf, "token").groupBy("doc_id").agg(F.sum(F.col("tf") * F.col("idf")).alias("score"))
    return scored.orderBy(F.round("score", RANK_DIGITS).desc(), "doc_id").limit(k)


def keyword_search(docs, terms, max_edits=1, k=TOP_DOCS):
    """Best k documents (doc_id, text) for the terms, each matching within ``max_edits`` edits.

    Edits are counted once per distinct token that shares a deletion with a term.  Tokens of other lengths stop at the
    scan, and only postings of matching tokens are shuffled.
    """
    fits = _length_fits(terms, max_edits)
    tokens = docs.select("doc_id", F.explode(F.filter(search_tokens(F.col("text")), fits)).alias("token"))
    matched = stored(docs.sparkSession, near_tokens(tokens.select("token").distinct(), terms, max_edits), "near-tokens")
    postings = stored(docs.sparkSession, _postings(tokens.join(matched, "token", "left_semi"), "doc_id"), "keyword-postings")
    return _keyword_scores(postings, _idf(postings, docs), k)


class FuzzyIndex:
    """A stored index for many searches: postings and document frequencies by token, tokens by their deletions."""

    def __init__(self, postings, words, variants, n_docs, max_edits):
        self.postings, self.words, self.variants = postings, words, variants
        self.n_docs, self.max_edits = n_docs, max_edits

    def near(self, terms, max_edits):
        """Tokens within the edits; the index is read only where its sorted variants can match."""
        if max_edits > self.max_edits:
            raise ValueError(f"the index holds deletions for {self.max_edits} edits")
        spark = self.words.sparkSession
        asked = _asked(spark, terms, max_edits)
        found = self.variants.join(F.broadcast(asked), "variant").select("token", "term")
        long = self.words.where((F.length("token") > LONGEST_INDEXED) & _length_fits(terms, max_edits)(F.col("token")))
        compared = long.select("token", F.explode(F.array(*map(F.lit, terms)) if terms else F.array().cast("array<string>")).alias("term"))
        return _close(found.unionByName(compared), max_edits)

    def search(self, terms, max_edits=None, k=TOP_DOCS):
        """As :func:`keyword_search`, from the index."""
        near = stored(self.words.sparkSession, self.near(terms, self.max_edits if max_edits is None else max_edits), "near-tokens")
        idf = self.words.join(near, "token").select("token", F.ln((self.n_docs + 1) / (F.col("df") + 1)).alias("idf"))
        return _keyword_scores(self.postings, idf, k)


def build_index(docs, max_edits=1):
    """A :class:`FuzzyIndex` of documents (doc_id, text) for searches with up to ``max_edits`` edits."""
    spark = docs.sparkSession
    postings = _postings(docs.select("doc_id", F.explode(search_tokens(F.col("text"))).alias("token")), "doc_id")
    # Sorted by token: a search reads the row groups of its tokens.
    postings = stored(spark, postings.repartitionByRange("token").sortWithinPartitions("token"), "postings")
    words = stored(spark, postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")), "words")
    short = words.where(F.length("token") <= LONGEST_INDEXED)
    variants = short.select(F.explode(deletions(F.col("token"), max_edits)).alias("variant"), "token")
    variants = stored(spark, variants.repartitionByRange("variant").sortWithinPartitions("variant"), "variants")
    return FuzzyIndex(postings, words, variants, docs.count(), max_edits)


def more_like_this(seeds, docs, n_terms=TOP_TERMS, k=TOP_DOCS, block=SEED_BLOCK):
    """Best k documents (doc_id, text) for each seed text (seed_id, text): (seed_id, rank, doc_id, score).

    A seed is represented by its ``n_terms`` heaviest terms; the score is the sum of weight
    products over shared terms.  See ``operators.impact`` for how documents are left out.
    """
    found = more_like_this_counted(seeds, docs, n_terms, k, block)
    return found.select("seed_id", "rank", "doc_id", "score")


def more_like_this_counted(seeds, docs, n_terms=TOP_TERMS, k=TOP_DOCS, block=SEED_BLOCK):
    """:func:`more_like_this` with ``scored``: how many documents the task of this row scored for the seed."""
    spark = docs.sparkSession
    seed_postings = stored(
        spark, _postings(seeds.select("seed_id", F.explode(search_tokens(F.col("text"))).alias("token")), "seed_id"), "seed-postings"
    )
    tokens = docs.where("doc_id is not null").select("doc_id", search_tokens(F.col("text")).alias("tokens"))
    n_docs = docs.count()
    blocks = seed_postings.count() // block + 1
    parts = []
    for i in range(blocks):
        own = seed_postings.where(F.pmod(F.xxhash64("seed_id"), F.lit(blocks)) == i) if blocks > 1 else seed_postings
        parts.append(_like_block(spark, own, tokens, n_docs, n_terms, k))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _like_block(spark, seed_postings, tokens, n_docs, n_terms, k):
    # A block of seeds: about SEED_BLOCK rows, so its vocabulary and its weights may be held and sent.
    vocabulary = sorted(r["token"] for r in seed_postings.select("token").distinct().collect())
    numbers = spark.createDataFrame([(t, i) for i, t in enumerate(vocabulary)], "token string, term int")
    counted = tokens.mapInArrow(count_terms(spark.sparkContext.broadcast(vocabulary)), "doc_id long, terms array<int>, counts array<int>")
    bags = stored(spark, counted, "bags")
    entries = bags.select("doc_id", F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("tf"))))
    stats = entries.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("tf").alias("most"))
    stats = stored(spark, stats.withColumn("idf", F.ln((F.lit(n_docs) + 1) / (F.col("df") + 1))), "term-stats")
    weighted = seed_postings.join(numbers, "token").join(stats, "term").select(
        "seed_id", "token", "term", "idf", "most", (F.col("tf") * F.col("idf")).alias("weight")
    )
    heaviest = top_k(weighted, ["seed_id"], [F.round("weight", RANK_DIGITS).desc(), F.col("token").asc()], n_terms)
    heaviest = stored(spark, heaviest.select("seed_id", "term", "most", (F.col("weight") * F.col("idf")).alias("weight")), "heaviest")
    # The heads of the postings: what k documents surely reach.
    heads = top_k(entries, ["term"], [F.col("tf").desc(), F.col("doc_id").asc()], k).drop("rank")
    sure = heads.join(heaviest, "term").groupBy("seed_id", "doc_id").agg(F.sum(F.col("weight") * F.col("tf")).alias("score"))
    sure = top_k(sure, ["seed_id"], [F.col("score").desc(), F.col("doc_id").asc()], k)
    reach = {r["seed_id"]: r["score"] for r in sure.where(F.col("rank") == k).collect()}  # one row a seed of the block
    rows = heaviest.collect()  # at most n_terms rows a seed of the block
    ids = sorted({r["seed_id"] for r in rows}, key=lambda x: (x is None, x))
    place = {x: i for i, x in enumerate(ids)}
    index = SeedIndex(
        [(place[r["seed_id"]], r["term"], r["weight"]) for r in rows], {place[x]: s for x, s in reach.items() if x in place},
        {r["term"]: r["most"] for r in rows}, len(vocabulary), len(ids),
    )
    best = bags.mapInArrow(best_of_task(spark.sparkContext.broadcast(index), k, RANK_DIGITS), FOUND)
    named = spark.createDataFrame([(i, x) for x, i in place.items()], "seed int, seed_id long")
    ranked = top_k(best, ["seed"], [F.floor(F.col("score") * 10.0**RANK_DIGITS + 0.5).desc(), F.col("doc_id").asc()], k)
    return ranked.join(named, "seed").select("seed_id", "rank", "doc_id", "score", "scored")
