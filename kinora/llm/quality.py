"""Quality rules whose cutoffs are chosen with a guarantee, in DataFrame functions only.

Base counts (words, symbols, repeated lines, words in repeated five-word windows) reject a document outright.  Beyond
them each rule compares one measure with a cutoff.  For every stratum (language) the labelled good documents that pass
the base are a holdout: with ``n`` of them, ``k`` above a cutoff, the exact binomial probability of at most ``k`` under a
false-rejection rate of ``risk`` / rules is the p-value of that cutoff.  Cutoffs are tested from the mildest on and the
last one before the first failure is taken (fixed sequence); strata and rules share the error ``error`` (Bonferroni).  So with
probability 1 - ``error`` no stratum loses more than ``risk`` of its good documents to the rules.  A stratum with too few
labels for any proof has no rule.

Defined cases: null and empty texts have no words and fail the base; a null stratum and an empty one are one stratum; a null label
is no label; a document labelled twice counts twice; without labels only the base rejects; an empty table gives no rows.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from kinora.llm.common import stored

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
RISK, ERROR = 0.05, 0.1

#: Rule -> measure and its cutoffs, mildest first; a document above the cutoff is rejected.
CUTOFFS = {
    "symbols": [1.0, 0.7, 0.5, 0.3, 0.2, 0.1, 0.05],  # symbols per word
    "capitals": [0.9, 0.7, 0.5, 0.3, 0.2],  # capital letters per character in words
    "shouts": [1.0, 0.7, 0.5, 0.3, 0.2, 0.1],  # exclamation marks per word
    "lines": [0.7, 0.5, 0.3, 0.2, 0.1, 0.05],  # repeated lines per line
    "long_words": [40.0, 25.0, 20.0, 15.0, 12.0],  # characters per word
    "repeats": [0.18, 0.15, 0.12, 0.1, 0.07, 0.05],  # words in repeated windows per word
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _dropped(text, chars):
    """How many of ``chars`` the text has."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def with_counts(docs, text="text"):
    """``docs`` with the base counts, ``base_failed`` and the measure of each rule, under a prefix-free struct ``q``."""
    content = F.coalesce(F.col(text), F.lit(""))
    # One column a step, so that what a later step reads several times is computed once.
    lines = F.filter(F.split(content, "\n"), lambda line: F.translate(line, SPACE, "") != "")
    words = F.filter(F.split(content, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    step = docs.withColumns({"_words": words, "_lines": lines})
    n = F.size("_words")
    windows = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), n - WINDOW),
            lambda i: F.xxhash64(*(F.get("_words", i + d) for d in range(WINDOW))),
        ),
    )
    step = step.withColumn("_windows", windows)
    # Only texts with a repeated window are sorted.
    pairs = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    step = step.withColumn("_pairs", pairs)
    repeated = F.filter(
        "_pairs",
        lambda x, j: (x["h"] == F.get("_pairs", j + 1)["h"]) | ((j > 0) & (x["h"] == F.get("_pairs", j - 1)["h"])),
    )
    step = step.withColumn("_at", F.sort_array(F.transform(repeated, lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("_at", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", j + 1) - p, F.lit(WINDOW)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    counted = {
        "n_words": n,
        "word_chars": F.length(F.translate(content, SPACE, "")),
        "n_symbols": _dropped(content, SYMBOLS),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
        "n_lines": F.size("_lines"),
        "n_capitals": _dropped(content, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "n_shouts": _dropped(content, "!"),
    }
    # A row number, which is never negative, is part of the verdict: it keeps Spark from moving later filters, and with
    # them copies of all these steps, below this point.
    step = step.select(
        *docs.columns, *(c.cast("long").alias(f"_{name}") for name, c in counted.items()), F.monotonically_increasing_id().alias("_barrier")
    )
    q = {name: F.col(f"_{name}") for name in counted}

    def share(a, b):
        return F.when(q[b] > 0, q[a] / q[b]).otherwise(F.lit(0.0))

    failed = (q["n_words"] < LEAST_WORDS) | (100 * q["n_repeat_words"] > MOST_REPEATED * q["n_words"]) | (F.col("_barrier") < 0)
    measures = {
        "symbols": share("n_symbols", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
        "shouts": share("n_shouts", "n_words"),
        "lines": share("n_dup_lines", "n_lines"),
        "long_words": share("word_chars", "n_words"),
        "repeats": share("n_repeat_words", "n_words"),
    }
    made = [*(q[name].alias(name) for name in COUNTS), failed.alias("base_failed"), *(m.alias(name) for name, m in measures.items())]
    return step.select(*docs.columns, F.struct(*made).alias("q"))


def at_most(k, n, rate):
    """Exact binomial probability of at most ``k`` in ``n`` at ``rate``; 1 where ``k`` is above the mean."""
    odds = F.lit(rate / (1 - rate))
    first = n * F.log1p(F.lit(-rate))
    start = F.struct(first.alias("log"), F.exp(first).alias("sum"))

    def add(acc, i):
        log = acc["log"] + F.log((n - i + 1) / i * odds)
        return F.struct(log.alias("log"), (acc["sum"] + F.exp(log)).alias("sum"))

    total = F.aggregate(F.sequence(F.lit(1).cast("long"), k), start, add)["sum"]
    return F.when(k > n * rate, F.lit(1.0)).when(k < 1, F.exp(first)).otherwise(F.least(total, F.lit(1.0)))


def cutoffs(counted, labels, key="doc_id", stratum="lang", label="quality", risk=RISK, error=ERROR):
    """One row per stratum with a proven rule: ``stratum`` and a column per rule (null: no cutoff is proven).

    ``counted``: rows of :func:`with_counts`, of which only key, stratum and ``q`` are read.
    """
    spark = counted.sparkSession
    good = labels.select(F.col(key).cast("long").alias("id"), F.col(label).alias("good")).where("good > 0").select("id")
    held = counted.select(
        F.col(key).cast("long").alias("id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), "q"
    ).where(~F.col("q.base_failed"))
    tests = [(rule, i, cut) for rule, cuts in CUTOFFS.items() for i, cut in enumerate(cuts)]
    above = [F.count_if(F.col(f"q.{rule}") > cut).alias(f"k{j}") for j, (rule, _, cut) in enumerate(tests)]
    counts = held.join(good, "id").groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *above)
    listed = F.array(
        *(
            F.struct(F.lit(rule).alias("rule"), F.lit(i).alias("at"), F.lit(cut).alias("cut"), F.col(f"k{j}").alias("k"))
            for j, (rule, i, cut) in enumerate(tests)
        )
    )
    counts = stored(spark, counts, "holdout-counts")
    strata = max(1, counts.count())
    rate, level = risk / len(CUTOFFS), error / (len(CUTOFFS) * strata)
    tested = counts.select("stratum", "n", F.inline(listed)).withColumn("p", at_most(F.col("k"), F.col("n"), rate))
    sequence = Window.partitionBy("stratum", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    proven = tested.withColumn("worst", F.max("p").over(sequence)).where(F.col("worst") <= level)
    strictest = [F.min(F.when(F.col("rule") == rule, F.col("cut"))).alias(rule) for rule in CUTOFFS]
    return stored(spark, proven.groupBy("stratum").agg(*strictest), "cutoffs")


def judged(counted, rules, stratum="lang"):
    """``counted`` with ``kept``: the base holds and no rule of the row's stratum fires.

    ``rules`` is a stored table of one row per stratum, which Spark broadcasts if its size allows.
    """
    rules = rules.select(F.col("stratum").alias("rule_stratum"), F.struct(*CUTOFFS).alias("rule"))
    fires = F.lit(False)
    for rule in CUTOFFS:
        fires = fires | F.coalesce(F.col(f"q.{rule}") > F.col(f"rule.{rule}"), F.lit(False))
    own = F.coalesce(F.col(stratum).cast("string"), F.lit(""))
    joined = counted.join(rules, own == F.col("rule_stratum"), "left")
    return joined.withColumn("kept", ~F.col("q.base_failed") & ~fires).drop("rule_stratum", "rule")


def judge(docs, labels, key="doc_id", text="text", stratum="lang", label="quality", risk=RISK, error=ERROR):
    """One row per document: key, base counts, base_failed and kept."""
    counted = with_counts(
        docs.select(F.col(key).cast("long").alias("doc_id"), F.col(stratum).alias("lang"), F.col(text).alias("text"))
    ).select("doc_id", "lang", "q")
    counted = stored(docs.sparkSession, counted, "quality-counts")
    rules = cutoffs(counted, labels.withColumnRenamed(key, "doc_id"), label=label, risk=risk, error=error)
    return judged(counted, rules).select("doc_id", *(f"q.{c}" for c in COUNTS), "q.base_failed", "kept")


def kept_rows(docs, labels, key="doc_id", text="text", stratum="lang", label="quality", risk=RISK, error=ERROR):
    """The documents that are kept, with their own columns (whatever their names)."""
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(key).alias("doc_id"),
        F.col(stratum).alias("lang"),
        F.col(text).alias("text"),
    )
    counted = with_counts(rows)
    rules = cutoffs(counted, labels.withColumnRenamed(key, "doc_id"), label=label, risk=risk, error=error)
    return judged(counted, rules).where("kept").select("row.*")
