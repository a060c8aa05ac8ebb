"""Quality rules where cutoffs are proven, against a recount."""

import random

from pyspark.sql import functions as F
from test_texts import base_counts, tail

from kinora.llm import quality


def measures(text):
    n_words, chars, symbols, dup_lines, repeats, _ = base_counts(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    capitals = sum("A" <= c <= "Z" for c in text)
    parts = {
        "symbols": (symbols, n_words), "capitals": (capitals, chars), "shouts": (text.count("!"), n_words), "lines": (dup_lines, len(lines)),
        "long_words": (chars, n_words), "repeats": (repeats, n_words),
    }
    return {rule: a / b if b else 0.0 for rule, (a, b) in parts.items()}


def recount(rows, good):
    """({stratum: {rule: cutoff}}, kept keys) of rows (key, text, stratum) and the keys labelled good, repeats included."""
    texts = {key: (text, stratum or "") for key, text, stratum in rows}
    held = {}
    for key in good:
        if key in texts and not base_counts(texts[key][0])[-1]:
            held.setdefault(texts[key][1], []).append(measures(texts[key][0]))
    level, proven = quality.ERROR / (len(quality.CUTOFFS) * len(held)), {}
    for stratum, found in held.items():
        for rule, cuts in quality.CUTOFFS.items():
            for cut in cuts:  # mildest first, up to the first failure
                if tail(sum(m[rule] > cut for m in found), len(found), quality.RISK / len(quality.CUTOFFS)) > level:
                    break
                proven.setdefault(stratum, {})[rule] = cut
    kept = set()
    for key, (text, stratum) in texts.items():
        m = measures(text)
        if not base_counts(text)[-1] and not any(m[rule] > cut for rule, cut in proven.get(stratum, {}).items()):
            kept.add(key)
    return proven, kept


def test_proven_cutoffs_match_recount(spark, docs_of):
    rng = random.Random(11)
    words = [a + b + c for a in "bdfg" for b in "aeiou" for c in ("l", "rst", "nding")]

    def text(odd):
        lines = [" ".join(rng.choices(words, k=rng.randrange(4, 8))) for _ in range(rng.randrange(3, 7))]
        if rng.random() < odd:
            lines += [rng.choice([lines[0], "# $ % " * rng.randrange(1, 6), "!! ! " * rng.randrange(1, 5), "LOUD " * rng.randrange(1, 4), "x" * rng.randrange(60, 900)])]
        if rng.random() < odd / 4:
            lines = [x.upper() for x in lines]
        return "\n".join(lines)

    rows, docs, labels = [], None, []
    for at, (stratum, n) in enumerate([("en", 1500), ("de", 1000), (None, 200)]):
        own = [(10_000 * at + i, text(0.03 if i < n else 0.9)) for i in range(n + 300)]
        rows += [(key, t, stratum) for key, t in own]
        labels += [(key, 1) for key, _ in own[:n]] + [(key, rng.choice([0, None])) for key, _ in own[n : n + 100]]
        part = docs_of(own, lang=stratum)
        docs = part if docs is None else docs.unionByName(part)
    labels += [(3, 1), (4, 1), (99_999, 1)]
    proven, kept = recount(rows, [key for key, good in labels if good])
    assert set(proven) == {"en", "de"} and all(len(cuts) >= 3 for cuts in proven.values())
    assert any(cut != quality.CUTOFFS[rule][-1] for cuts in proven.values() for rule, cut in cuts.items())  # some are stopped on the way
    base = {key for key, t, _ in rows if not base_counts(t)[-1]}
    assert kept < base and len(base - kept) > 50
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.judge(docs, table).collect()
    assert len(got) == len(rows) and {r["doc_id"] for r in got if r["kept"]} == kept
    assert {r["doc_id"] for r in quality.kept_rows(docs, table).collect()} == kept
    counted = quality.with_counts(docs.select("doc_id", "lang", F.col("text")))
    rules = {r["stratum"]: {c: r[c] for c in quality.CUTOFFS if r[c] is not None} for r in quality.cutoffs(counted, table).collect()}
    assert rules == proven
