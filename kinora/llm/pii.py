"""Personal data: exact patterns, and terms that give away what the patterns protect.  DataFrame functions only.

Patterns find the protected entities (mail and IP addresses, card and phone numbers).  Then, over the whole corpus, a term's
disclosure of an entity is their pointwise mutual information as a share of the entity's information content: 1 means
that the term is as good as the entity.  The conditional probability is an estimate shrunk by one prior document, and an
entity or a pair counts only if it is seen in two different texts, so rarity alone proves nothing.  In texts that name the entity,
terms from ``generalise`` on are replaced by a general placeholder and terms from ``remove`` on are removed.  Texts without a
protected entity stay as they are.

What grows: the term counts are one pre-aggregated shuffle; entity-term pairs are made only for texts with a shared entity,
once per distinct text, and only for terms rare enough to reach the threshold (an exact bound).

Defined cases: null and empty texts have no spans (a null text stays null); null and repeated keys stay rows of their own; equal texts
get equal spans; where spans overlap, base spans stay and term spans are dropped; an empty table gives no rows.
"""

from pyspark.sql import functions as F

from kinora.llm.common import stored

GENERALISE, REMOVE = 0.8, 0.95
LEAST_TEXTS = 2
CHUNK = 256
KINDS = ["email", "ip", "card", "phone"]

# Java forms of the base patterns.  Possessive and anchored to the start of a run, they find the same matches without
# backtracking through long runs.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Something that every match has, cheaply looked for.
NEEDS = {"email": "@", "phone": "+"}
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _luhn(digits):
    """Whether a digit string passes the Luhn check."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc + _luhn_value(F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int"), i % 2 == 0),
    )
    return total % 10 == 0


def _luhn_value(digit, doubled):
    return F.when(doubled, 2 * digit - F.when(digit > 4, 9).otherwise(0)).otherwise(digit)


def _valid(kind, match):
    if kind == "ip":
        return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(match, "[ -]", "")
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(10, 15)
    return F.lit(True)


def with_matches(df, name, text, pattern, needs=None):
    """``df`` with ``name``: the matches of ``pattern`` as array<struct<start, end, match>>, in code points, end exclusive.

    ``pattern`` is a column too.  Matches and the pieces between them alternate, so their lengths add up to the
    positions; sums run within chunks of matches, then over the chunks.
    """
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    if needs:
        matches = F.when(F.contains(text, F.lit(needs)), matches)
    df = df.withColumn("_m", matches)
    m = F.col("_m")
    # Columns that lambdas read are read outside them too: Spark copies a column that is read once into its reader,
    # and in a lambda it would be computed for every element.
    df = df.withColumn("_p", F.when(F.size(m) > 0, F.split(text, pattern, -1)))
    df = df.withColumn(
        "_z",
        F.transform(
            F.when((F.size(m) > 0) & (F.size("_p") > 0), m),
            lambda x, i: F.struct(F.length(F.get("_p", i)).alias("gap"), F.length(x).alias("len"), x.alias("match")),
        ),
    )
    df = df.withColumn(
        "_c",
        F.transform(F.sequence(F.lit(0), F.floor((F.size("_z") - 1) / CHUNK).cast("int")), lambda c: F.slice("_z", c * CHUNK + 1, CHUNK)),
    )
    sums = F.transform("_c", lambda part: F.aggregate(part, F.lit(0), lambda acc, x: acc + x["gap"] + x["len"]))
    df = df.withColumn("_s", F.aggregate(sums, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))))
    none = F.expr("cast(array() as array<struct<start:int,end:int,match:string>>)")

    def place(acc, x):
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), (start + x["len"]).alias("end"), x["match"].alias("match"))
        return F.struct((start + x["len"]).alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    spans = F.flatten(
        F.transform("_c", lambda part, c: F.aggregate(part, F.struct(F.get("_s", c).alias("at"), none.alias("spans")), place)["spans"])
    )
    return df.withColumn(name, F.when(F.size("_s") > 0, F.coalesce(spans, none)).otherwise(none)).drop("_m", "_p", "_z", "_c", "_s")


def _spans_of(matches, kind, rank):
    """The valid matches of a kind as spans."""

    def span(x):
        return F.struct(
            x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"), x["match"].alias("match")
        )

    return F.transform(F.filter(matches, lambda x: _valid(kind, x["match"])), span)


def with_base(df, text):
    """``df`` with ``base``: the valid spans of all kinds as array<struct<start, rank, end, kind, match>> in order."""
    for rank, kind in enumerate(KINDS):
        df = with_matches(df, f"_{kind}", text, F.lit(PATTERNS[kind]), NEEDS.get(kind))
        df = df.withColumn(f"_{kind}", _spans_of(f"_{kind}", kind, rank))
    found = [f"_{kind}" for kind in KINDS]
    # The row number keeps Spark from moving filters on the result, and with them copies of all these steps, below it.
    columns = [c for c in df.columns if c not in found]
    return df.select(*columns, F.sort_array(F.concat(*found)).alias("base"), F.monotonically_increasing_id().alias("_row"))


def written(spans):
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def words_of(text):
    """Distinct lower-case letter runs."""
    return F.array_except(F.array_distinct(F.split(F.lower(text), r"\P{L}+")), F.array(F.lit("")))


def _telling_terms(spark, private, rows, generalise, remove):
    """Terms that give an entity away, per distinct text: ``tid, terms map<term, removed>``.

    ``private``: tid, text, base of rows with entities; ``rows``: all rows with text.
    """
    total = rows.count()
    texts = stored(
        spark,
        private.groupBy("tid").agg(F.first("text").alias("text"), F.first("base").alias("base"), F.count(F.lit(1)).alias("copies")),
        "private-texts",
    )
    entity = lambda x: F.concat_ws(":", x["kind"], F.lower(x["match"]))
    named = texts.select("tid", "copies", F.explode(F.array_distinct(F.transform("base", entity))).alias("entity"))
    shared = named.groupBy("entity").agg(F.sum("copies").alias("df_c"), F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= LEAST_TEXTS)
    named = stored(spark, named.join(shared.select("entity", "df_c"), "entity"), "entities")
    # Terms of texts with a shared entity, with their document count in the whole corpus.
    corpus = rows.select(F.explode(words_of(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df_t"))
    terms = (
        texts.join(named.select("tid").distinct(), "tid", "left_semi")
        .select("tid", F.explode(words_of(F.col("text"))).alias("term"))
        .join(corpus, "term")
    )
    p_c = F.col("df_c") / F.lit(total)
    # A conditional probability is at most 1, so a term's share cannot exceed the entity's share to this power.
    rare = F.col("df_t") / F.lit(total) <= F.pow(p_c, F.lit(generalise))
    pairs = stored(
        spark,
        terms.join(named, "tid").where(rare).select("tid", "copies", "entity", "df_c", "term", "df_t"),
        "entity-terms",
    )
    given = (F.col("df_ct") + p_c) / (F.col("df_t") + 1)
    telling = (
        pairs.groupBy("entity", "term", "df_c", "df_t")
        .agg(F.sum("copies").alias("df_ct"), F.count(F.lit(1)).alias("texts"))
        .where((F.col("texts") >= LEAST_TEXTS) & (F.col("df_c") < total))
        .withColumn("disclosure", F.log(given / p_c) / -F.log(p_c))
        .where(F.col("disclosure") >= generalise)
        .select("entity", "term", (F.col("disclosure") >= remove).alias("removed"))
    )
    return (
        pairs.join(telling, ["entity", "term"])
        .groupBy("tid", "term")
        .agg(F.max("removed").alias("removed"))
        .groupBy("tid")
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "removed"))).alias("terms"))
        .join(texts, "tid")
    )


def _term_spans(telling):
    """``tid, spans``: where the telling terms stand, outside base spans."""
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(F.map_keys("terms"), "|"), F.lit(r")(?!\p{L})"))
    placed = with_matches(telling.withColumn("pattern", pattern), "hits", F.col("text"), F.col("pattern"))
    free = F.filter("hits", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    spans = F.transform(
        free,
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), x["end"].alias("end"),
            F.when(F.element_at("terms", F.lower(x["match"])), "removed").otherwise("term").alias("kind"), x["match"].alias("match"),
        ),
    )
    return placed.select("tid", spans.alias("more"))


def find(rows, generalise=GENERALISE, remove=REMOVE):
    """``rows`` (any columns, with ``text``) with ``base`` and ``spans``: base spans, and those with the method's added."""
    spark = rows.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    named = (F.size("base") > 0) & (F.col("_row") >= 0)
    found = with_base(rows, text).withColumn("tid", F.when(named, F.sha2(text, 256))).drop("_row")
    private = stored(spark, found.where("tid is not null"), "private")
    telling = _telling_terms(spark, private.select("tid", "text", "base"), rows, generalise, remove)
    terms = stored(spark, _term_spans(telling), "term-spans")
    joined = private.join(terms, "tid", "left").withColumn(
        "spans", F.sort_array(F.concat("base", F.coalesce("more", F.slice("base", 1, 0))))
    )
    clean = found.where("tid is null").withColumn("spans", F.col("base"))
    return clean.drop("tid").unionByName(joined.drop("tid", "more"))


def _is(kind):
    return lambda x: x["kind"] == kind


def scan(docs, key="doc_id", text="text", generalise=GENERALISE, remove=REMOVE):
    """One row per document: counts per kind and of all spans, base and all spans."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = [F.size(F.filter("base", _is(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    more = F.size("spans").cast("long").alias("n_spans")
    return find(rows, generalise, remove).select("doc_id", *counts, "base", "spans", more)


def _redacted(text, spans):
    """The text with every span replaced; overlapping spans are replaced as one."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, x):
        shown = F.when(x["kind"] == "removed", "").otherwise(F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
        before = F.substring(text, acc["at"] + 1, x["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when(x["start"] >= acc["at"], F.concat(acc["out"], F.array(before, shown))).otherwise(acc["out"]).alias("out"),
        )

    return F.aggregate(
        spans, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text)))
    )


def sanitise(docs, text="text", generalise=GENERALISE, remove=REMOVE):
    """``docs`` with their own columns (whatever their names), personal data and telling terms replaced in the text."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    found = find(docs.select(row, F.col(text).alias("text")), generalise, remove)
    clean = F.when(F.size("spans") > 0, _redacted(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    return found.withColumn("clean", clean).select(
        *(F.col("clean").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns)
    )
