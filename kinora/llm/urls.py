"""URL verdicts: host and path rules first, a learnt verdict for the rest.

The learnt verdict reads words.  Names in hosts are run together ("tionble"), so every host label is split by a unigram Viterbi
over word counts of the pages' own texts; the words of host and path are then scored by multinomial naive Bayes.  Its
classes are learnt from the urls that a rule decides: their rule says what they are.

Host words come from a join, not from a broadcast dictionary: each distinct label lists its substrings, the substrings meet the
word counts, and each label is split from its own substrings.  Token weights meet the urls in a join too; frequent
tokens are split by the skew join.

Defined cases: a null url or one without ``://`` has an empty host and path; such urls, and all urls if the rules decide none of
both classes, get the verdict that rules give more often (allow on a tie); labels longer than ``MAX_LABEL`` are no DNS labels and stay one
word; an unknown substring costs as much as its letters; repeated rows and null keys stay rows of their own; an empty table gives no rows.
"""

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinora.llm.common import stored
from kinora.operators.skew import salted_join

#: Urls of a host that one task joins with its words.
URLS_PER_HOST = 200
MAX_LABEL, MAX_WORD = 63, 20
SMOOTHING = 1.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(url):
    """(host, path) columns: what lies between the first ``://`` and ``/ ? #``, and from there up to ``? #``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"(?s)^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def ruled(host, path, rules):
    """The longest rule that fits as struct<rule, verdict>, else null.  ``rules``: (verdict, "host/path") pairs."""
    fits = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        domain, _, start = rule.partition("/")
        own = (host == domain) | F.endswith(host, F.lit("." + domain))
        fits.append(F.when(own & F.startswith(path, F.lit("/" + start)), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def word_counts(pages, html="html"):
    """``word, n``: lower-case letter runs of the pages' texts, tags and markup left out."""
    text = F.lower(F.regexp_replace(F.coalesce(F.col(html), F.lit("")), r"(?s)<(script|style)\b.*?</\1\s*>|<[^>]*>|&\w+;", " "))
    words = pages.select(F.explode(F.split(text, r"\P{L}+")).alias("word"))
    return words.where((F.length("word") > 1) & (F.length("word") <= MAX_WORD)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def best_split(label, words, counts, total, longest=MAX_WORD):
    """The most probable split of ``label`` into words; a letter run outside the counts costs a tenth per letter."""
    known = dict(zip(words, counts))
    best = [(0.0, 0)]
    for end in range(1, len(label) + 1):
        options = []
        for start in range(max(0, end - longest), end):
            piece = label[start:end]
            share = known[piece] / total if piece in known else 10.0 / (total * 10.0 ** len(piece))
            options.append((best[start][0] + math.log(share), start))
        best.append(max(options))
    out, end = [], len(label)
    while end:
        start = best[end][1]
        out.append(label[start:end])
        end = start
    return out[::-1]


def segmented(hosts, counts):
    """``label, words``: every distinct label of ``hosts`` (column host) with its split."""
    spark = hosts.sparkSession
    labels = hosts.select(F.explode(F.split("host", r"[^\p{L}\p{N}]+")).alias("label")).where("label != ''").distinct()
    total = counts.agg(F.sum("n")).first()[0] or 1
    short = F.when(F.length("label") <= MAX_LABEL, F.col("label")).otherwise("")
    pieces = F.transform(
        F.sequence(F.lit(0), F.length(short) * MAX_WORD - 1),
        lambda i: F.substring("label", F.floor(i / MAX_WORD).cast("int") + 1, i % MAX_WORD + 1),
    )
    found = (
        labels.select("label", F.explode(F.array_distinct(F.when(F.length(short) > 0, pieces))).alias("word"))
        .join(counts, "word")
        .groupBy("label")
        .agg(F.collect_list(F.struct("word", "n")).alias("found"))  # at most MAX_LABEL * MAX_WORD
    )

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def split(label, words, n):
        return label.combine(words, lambda x, w: (x, w)).combine(
            n, lambda x, c: best_split(x[0], x[1], c, total) if len(x[0]) <= MAX_LABEL else [x[0]]
        )

    none = F.expr("cast(array() as array<struct<word:string,n:bigint>>)")
    known = labels.join(found, "label", "left").withColumn("found", F.coalesce("found", none))
    return stored(spark, known.select("label", split("label", "found.word", "found.n").alias("words")), "labels")


def judge(pages, rules, key="page_id", url="url", html="html"):
    """One row per page: page_id, host, path, rule, verdict and score (log odds of block; null where a rule decides)."""
    spark = pages.sparkSession
    host, path = parsed(F.col(url))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("hit", ruled(F.col("host"), F.col("path"), rules)).withColumn("row", F.monotonically_increasing_id())
    rows = stored(spark, rows, "urls")
    labels = segmented(rows.select("host").distinct(), stored(spark, word_counts(pages, html), "word-counts"))
    # Host words, one row per distinct host; a label counts as often as the host has it.
    hosts = (
        rows.select("host").distinct()
        .select("host", F.explode(F.split("host", r"[^\p{L}\p{N}]+")).alias("label"))
        .join(labels, "label", "left")
        .groupBy("host")
        .agg(F.flatten(F.collect_list("words")).alias("host_words"))
    )
    digits = F.transform(F.filter(F.split(F.lower("path"), r"[^\p{L}\p{N}]+"), lambda x: x != ""), lambda x: F.regexp_replace(x, "[0-9]+", "0"))
    tokens = F.concat(
        F.transform(F.coalesce("host_words", F.array().cast("array<string>")), lambda x: F.concat(F.lit("h:"), x)),
        F.transform(digits, lambda x: F.concat(F.lit("p:"), x)),
    )
    hosted = salted_join(rows, hosts, "host", URLS_PER_HOST)  # a host may have a third of all urls
    tokens = stored(spark, hosted.select("row", F.col("hit.verdict").alias("known"), tokens.alias("tokens")), "url-tokens")
    blocked = F.col("known") == "block"
    listed = tokens.where("known is not null").select("known", F.explode("tokens").alias("token"))
    weights = listed.groupBy("token").agg(F.count_if(blocked).alias("block"), F.count_if(~blocked).alias("allow"))
    weights = stored(spark, weights, "token-counts")
    sums = weights.agg(F.sum("block"), F.sum("allow"), F.count(F.lit(1))).first()
    urls = tokens.agg(F.count_if(blocked), F.count_if(F.col("known") == "allow")).first()
    prior = 0.0
    usual = "block" if urls[0] > urls[1] else "allow"
    if urls[0] and urls[1]:
        prior = math.log(urls[0] / urls[1])
        rate = {c: (F.col(c) + SMOOTHING) / F.lit(float((total or 0) + SMOOTHING * (sums[2] + 1))) for c, total in (("block", sums[0]), ("allow", sums[1]))}
        weights = weights.select("token", F.log(rate["block"] / rate["allow"]).alias("weight"))
    else:
        weights = weights.select("token", F.lit(0.0).alias("weight")).limit(0)
    scored = (
        tokens.where("known is null")
        .select("row", F.explode("tokens").alias("token"))
        .groupBy("row", "token")
        .agg(F.count(F.lit(1)).alias("times"))
        .join(weights, "token")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("weight")).alias("evidence"))
    )
    score = F.when(F.col("hit").isNull(), F.coalesce("evidence", F.lit(0.0)) + prior)
    learnt = F.when(F.col("evidence").isNull(), usual).when(F.col("score") > 0, "block").otherwise("allow")
    return (
        rows.join(scored, "row", "left")
        .withColumn("score", score)
        .select("page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", learnt).alias("verdict"), "score")
    )
