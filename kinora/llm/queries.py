"""The queries of this subpackage: each applies an operator to its whole table."""

import zlib
from pathlib import Path

import public_tokenizers
from pyspark.sql import functions as F

from kinora.llm import bytebpe, contentsort, idstore, imatch, lexical, licenses, packing, periodic, pii, quality, setjoin, toxicity, urls
from kinora.llm.common import read
from kinora.session import scratch_path

#: The pattern that splits text before the merges of the rank files.
PATTERN = public_tokenizers.PATTERN
QUERIES, ORACLES = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name):
    return Path(public_tokenizers.path(name)).read_text()


@query
def op3_pack_sequences(spark, sf):
    packed = packing.pack(read(spark, sf, "documents"), vocabulary("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op8_token_id_store(spark, sf):
    path = scratch_path(spark, "token-ids")
    docs = read(spark, sf, "documents")
    parts = idstore.write(docs, path, vocabulary("word_bpe_49k.json"))
    found = idstore.contents(spark, path, docs, parts)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op6_byte_bpe(spark, sf):
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    both = bytebpe.round_trip(read(spark, sf, "documents"), ranks, PATTERN)
    return both.select("doc_id", "n_tokens", F.sha2("written", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op4_license_rules(spark, sf):
    return licenses.scan(read(spark, sf, "documents")).drop("spans")


@query
def op7_imatch(spark, sf):
    return imatch.fingerprints(read(spark, sf, "documents"))


#: Score from which a document counts as toxic.
TOXIC_FROM = 0.3


@query
def op5_toxicity(spark, sf):
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out()))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).alias("predicted"),
    )


@query
def op9_quality_rules(spark, sf):
    return quality.judge(read(spark, sf, "documents"), read(spark, sf, "labels"))


@query
def op10_jaccard_join(spark, sf):
    return setjoin.groups(read(spark, sf, "documents"), words=3, share=(90, 100))


@query
def op2_pii(spark, sf):
    found = pii.scan(read(spark, sf, "documents"))
    return found.select(
        "doc_id",
        *(f"n_{kind}" for kind in pii.KINDS),
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.col("spans")).alias("spans"),
        "n_spans",
    )


#: The rules that decide urls before the method does.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@query
def op1_url_verdicts(spark, sf):
    return urls.judge(read(spark, sf, "pages"), URL_RULES)


@query
def op11_content_sort(spark, sf):
    return contentsort.groups(read(spark, sf, "documents"), keep="largest")


def looped(key, words):
    """The fixed edit of the query: one text in ten repeats a stretch of its own to the end.

    With h = crc32 of the decimal key and g = h // 10: if h % 10 = 0, word i >= a becomes word a + (i - a) % p, where
    a = g % n and p = 1 + (n - a) // (3 + g % 8).  A null key has no decimal form and no edit.
    """
    h, n = zlib.crc32(str(key).encode()), len(words)
    if key is None or not n or h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


@query
def op12_periodic_runs(spark, sf):
    found = periodic.find(read(spark, sf, "documents"), edit=looped)
    best = F.col("best")
    return found.withColumn("best", periodic.strongest()).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(periodic.written(), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_lexical_search(spark, sf):
    return lexical.search(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


ORACLES["op11_content_sort"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

#: Terms of a text in SQL.
_SQL_TERMS = r"""regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLES["op13_lexical_search"] = f"""
WITH item_terms AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({_SQL_TERMS.format(text="text")}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY item_id, term
), docs AS (
  SELECT doc_id, {_SQL_TERMS.format(text="coalesce(text, '')")} AS terms FROM documents
), totals AS (
  SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM docs WHERE len(terms) > 0
), occurrences AS (
  SELECT doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM docs) GROUP BY doc_id, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM occurrences, totals WHERE term IN (SELECT term FROM item_terms) GROUP BY term, n_docs
), scored AS (
  SELECT item_id, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM item_terms JOIN weights USING (term) JOIN occurrences USING (term), totals
  GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
