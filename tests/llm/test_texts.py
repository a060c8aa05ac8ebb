"""Text operators against brute force."""

import hashlib
import math
import re
import random
from collections import Counter

import numpy as np
import pytest

from kinora.llm import imatch, licenses, pii, quality, setjoin, toxicity, urls
from kinora.llm.components import components
from kinora.llm.queries import QUERIES, URL_RULES

LICENSE_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# -- urls --------------------------------------------------------------------------------------


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_url_rules(spark):
    rows = [
        (1, "HTTPS://WWW.Example.com/en/a?x", ""), (2, "http://example.com/en/a#b", ""), (3, "http://a.net/es/", ""), (4, "http://a.net", ""),
        (5, None, None), (6, "no scheme", ""), (7, "http://com/en?q=://x/es/", ""), (8, "x://notexample.com/en/", ""), (None, "", ""), (2, "http://example.com/en/a#b", ""),
    ]
    got = sorted((r["page_id"] or 0, r["host"], r["path"], r["rule"]) for r in urls.judge(pages_of(spark, rows), URL_RULES).collect())
    assert got == sorted([
        (1, "www.example.com", "/en/a", "www.example.com/en/"), (2, "example.com", "/en/a", "example.com/en/"), (2, "example.com", "/en/a", "example.com/en/"),
        (3, "a.net", "/es/", "net/es/"), (4, "a.net", "", None), (5, "", "", None), (6, "", "", None), (7, "com", "/en", "com/"), (8, "notexample.com", "/en/", "com/"), (0, "", "", None),
    ])
    assert {g[0]: g[3] for g in got} == {0: None, 1: "www.example.com/en/", 2: "example.com/en/", 3: "net/es/", 4: None, 5: None, 6: None, 7: "com/", 8: "com/"}
    assert urls.judge(pages_of(spark, []), URL_RULES).count() == 0


def test_segmentation_is_the_best_split():
    counts = {"the": 50, "them": 5, "me": 9, "theme": 2, "park": 7}

    def cost(words, total=80):
        return sum(math.log(counts[w] / total) if w in counts else math.log(10 / (total * 10 ** len(w))) for w in words)

    def splits(text):
        return [[]] if not text else [[text[:i], *rest] for i in range(1, len(text) + 1) for rest in splits(text[i:])]

    for label in ("themepark", "thexpark", "zz", "methem"):
        best = urls.best_split(label, list(counts), list(counts.values()), 80)
        assert "".join(best) == label and cost(best) == pytest.approx(max(map(cost, splits(label))))


def test_url_verdicts_match_naive_bayes(spark):
    html = "<p>good good news shop shop spam spam</p>"
    rows = [(i, f"http://goodnews.com/a{i}", html) for i in range(5)] + [(9 + i, f"http://spamshop.net/es/b{i}", html) for i in range(5)]
    rows += [(20, "http://goodnews.org/a", html), (21, "http://spamshop.org/b", html)]
    got = {r["page_id"]: r["verdict"] for r in urls.judge(pages_of(spark, rows), URL_RULES).collect()}
    assert got[20] == "allow" and got[21] == "block" and got[1] == "allow" and got[9] == "block"


# -- personal data -----------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            valid = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15,
            }[kind]
            if valid:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def written(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def test_base_spans(spark, docs_of, odd):
    rng = random.Random(3)
    noise = ["".join(rng.choice("ab1@._ +-()9é\n") for _ in range(rng.randrange(60))) for _ in range(400)]
    fixed = [
        "a@b.c_d@e.f x@y..z@q.w", "1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (386) 555-3733 +12",
        "é\U0001f600 me@x.org +1 386 555 37331", "5 " * 3000, "a" * 5000 + "@", "1." * 3000, " ".join(f"u{i}@m.example.com" for i in range(700)),
    ]
    texts = [*odd, *enumerate([*noise, *fixed], 100)]
    for r in pii.scan(docs_of(texts)).collect():
        want = {written(base_spans(t)) for k, t in texts if k == r["doc_id"]}
        assert written([(s["start"], s["rank"], s["end"], s["kind"]) for s in r["base"]]) in want


def disclosed(texts):
    """Brute force of the co-occurrence rule: {(text, term): removed}."""
    total, df, seen = len(texts), Counter(), {}
    for t in texts:
        df.update(set(re.split(r"[\W\d_]+", t.lower())) - {""})
    count, pair, pair_texts, text_of = Counter(), Counter(), {}, {}
    for t in texts:
        entities = {f"{k}:{t[s:e].lower()}" for s, _, e, k in base_spans(t)}
        for c in entities:
            count[c] += 1
            text_of.setdefault(c, set()).add(t)
            for term in set(re.split(r"[\W\d_]+", t.lower())) - {""}:
                pair[c, term] += 1
                pair_texts.setdefault((c, term), set()).add(t)
    for (c, term), n in pair.items():
        p = count[c] / total
        if len(text_of[c]) < 2 or len(pair_texts[c, term]) < 2 or p == 1 or df[term] / total > p**0.8:
            continue
        share = math.log((n + p) / (df[term] + 1) / p) / -math.log(p)
        if share >= 0.8:
            for t in pair_texts[c, term]:
                seen[t, term] = seen.get((t, term), False) or share >= 0.95
    return seen


def test_telling_terms(docs_of):
    rng = random.Random(5)
    common = ["alpha", "beta", "gamma", "delta", "omega"]
    texts = [" ".join(rng.choices(common, k=12)) for _ in range(300)]
    texts += [f"zorblax {' '.join(rng.choices(common, k=6))} sees me@x.org Quibble {i}" for i in range(4)]
    texts += [f"{' '.join(rng.choices(common, k=5))} you@y.org lonely{i}word" for i in range(2)]
    want = disclosed(texts)
    for text, term in list(want):  # terms within a base span stay part of it
        free = list(text.lower())
        for s, _, e, _ in base_spans(text):
            free[s:e] = " " * (e - s)
        if not re.search(rf"(?<![^\W\d_]){term}(?![^\W\d_])", "".join(free)):
            del want[text, term]
    assert want and {term for _, term in want} >= {"zorblax", "quibble", "sees"}
    got = {}
    for r in pii.scan(docs_of(list(enumerate(texts)))).collect():
        for s in r["spans"]:
            if s["kind"] in ("term", "removed"):
                got[texts[r["doc_id"]], texts[r["doc_id"]][s["start"] : s["end"]].lower()] = s["kind"] == "removed"
    assert got == want


def test_sanitised_texts(docs_of, odd):
    docs = docs_of([*odd, (20, "mail me@x.org or +1 386 555 3733 now"), (21, "4111 1111 1111 1111")])
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert got[20] == "mail [EMAIL] or [PHONE] now" and got[21] == "[CARD]" and got[1] is None and got[7] == dict(odd)[7]
    assert pii.sanitise(docs_of([])).count() == 0


# -- licenses ----------------------------------------------------------------------------------


def test_license_base_and_suppression(docs_of, odd):
    texts = [
        *odd, (20, "Under the MIT-license, under the mit license. Apache License: version 2"), (21, "cc by-nc cc BY nc 4.0 license"),
        (22, "licensed under the GNU Lesser General Public License v3 or later"), (23, "SPDX-License-Identifier: GPL-2.0-only"), (24, "the éapache license version 2"),
    ]
    got = {r["doc_id"]: r for r in licenses.scan(docs_of(texts)).collect()}
    for key, text in texts:
        words, places = LICENSE_WORDS.findall(low(text)), []
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
        r = got[key]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(words), len(places), ",".join(sorted({x for _, x in places})))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1
    assert got[22]["labels"] == "lgpl-3" and got[23]["labels"] == "gpl-2" and got[4]["score"] == 0
    for r in got.values():  # no kept span inside another of at least its confidence
        spans = [(s["start"], s["end"], s["confidence"]) for s in r["spans"]]
        assert not any(a != b and b[0] <= a[0] and a[1] <= b[1] and b[2] >= a[2] for a in spans for b in spans)
    assert licenses.scan(docs_of([])).count() == 0 and len(licenses.rules()) > 200


# -- toxicity ----------------------------------------------------------------------------------


def test_toxicity_learns_words(spark, docs_of, odd):
    rng = random.Random(1)
    plain = ["sun", "river", "stone", "cloud", "green", "paper", "light"]
    texts = [" ".join(rng.choices(plain, k=20)) + (" scoundrel" if i % 3 == 0 else "") for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(160)] + [(3, None)], "doc_id long, toxic int")
    docs = docs_of(list(enumerate(texts)))
    model = toxicity.train(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert all((scores[i] >= 0.3) == (i % 3 == 0) for i in range(160, 240))
    assert toxicity.filtered(docs, model, 0.3).columns == docs.columns
    assert {r["doc_id"] for r in toxicity.filtered(docs, model, 0.3).collect()} == {i for i in scores if scores[i] < 0.3}
    assert toxicity.score(docs_of(odd), model).count() == len(odd)
    none = toxicity.train(docs, labels.limit(0))
    assert all(r["score"] < 1e-6 for r in toxicity.score(docs, none).collect())
    assert toxicity.score(docs_of([]), model).count() == 0


# -- fingerprints ------------------------------------------------------------------------------


def test_fingerprints(docs_of, odd):
    got = sorted(imatch.fingerprints(docs_of(odd)).collect(), key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0)))
    rows = sorted(odd, key=lambda x: (x[0] is None, -(x[0] or 0)))
    for i, r in enumerate(got):
        text, following = rows[i][1] or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert r["doc_id"] == rows[i][0] and r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    by_text = {}
    for (_, text), r in zip(rows, got):
        by_text.setdefault(text or "", set()).add(r["fingerprint"])
    assert all(len(x) == 1 for x in by_text.values()) and len({x for s in by_text.values() for x in s}) == len(by_text)
    assert imatch.fingerprints(docs_of([])).count() == 0
    assert imatch.fingerprints(docs_of([(5, "alone here now")])).first()["near_next"] == 1.0


# -- quality -----------------------------------------------------------------------------------


def base_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    counts = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
    return *counts, counts[0] < 10 or 100 * counts[4] > 20 * counts[0]


def test_quality_counts(spark, docs_of, odd):
    rng = random.Random(2)
    noise = ["".join(rng.choice(["a ", "b ", "c\n", "# ", "\x0b", "\x85", "é "]) for _ in range(rng.randrange(80))) for _ in range(300)]
    texts = [*odd, *enumerate(noise, 100)]
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.judge(docs_of(texts), labels).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = {base_counts(t) for k, t in texts if k == r["doc_id"]}
        assert (*(r[c] for c in quality.COUNTS), r["base_failed"]) in want and r["kept"] == (not r["base_failed"])
    assert quality.judge(docs_of([]), labels).count() == 0


def tail(k, n, p):
    return 1.0 if k > n * p else min(1.0, sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))


def test_binomial_bound(spark):
    cases = [(k, n) for n in (0, 1, 10, 300, 5000) for k in (0, 1, 3, 20, 49) if k <= n]
    df = spark.createDataFrame(cases, "k long, n long")
    for r in df.select("k", "n", quality.at_most(df.k, df.n, 0.01).alias("p")).collect():
        assert r["p"] == pytest.approx(tail(r["k"], r["n"], 0.01), rel=1e-9)


def test_cutoffs_are_proven_per_stratum(spark, docs_of):
    good = [(i, "plain words that stand here in a row of ten and more " + str(i)) for i in range(900)]
    bad = [(1000 + i, "$$$ ### *** %%% words &&& that $$$ stand ||| here <<< " * 1 + str(i)) for i in range(50)]
    few = docs_of([(5000 + i, t) for i, t in bad], lang=None)
    docs = docs_of([*good, *bad]).unionByName(few)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    kept = {r["doc_id"] for r in quality.kept_rows(docs, labels).collect()}
    assert kept >= {i for i, _ in good} and not kept & {i for i, _ in bad}
    assert kept >= {5000 + i for i, _ in bad}  # a stratum without labels has no rule
    assert quality.kept_rows(docs, labels).columns == docs.columns


# -- joins -------------------------------------------------------------------------------------


def brute_groups(texts, k, num, den):
    sets = {}
    for key, text in texts:
        w = WORDS.findall(low(text))
        sets[key] = frozenset(tuple(w[i : i + min(k, len(w))]) for i in range(len(w) - min(k, len(w)) + 1)) if w else frozenset()
    root = {key: key for key in sets}
    keys = sorted(sets)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if x and y and den * len(x & y) >= num * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {key: (len(sets[key]), find(key)) for key in keys}


@pytest.mark.parametrize("k,share", [(3, (90, 100)), (5, (80, 100)), (1, (60, 100))])
def test_groups_match_brute_force(docs_of, k, share):
    rng = random.Random(k)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for size in (2, 4, 9, 11, 14, 19, 24, 40, 90, 250):
        for _ in range(3):
            words = [rng.choice(vocabulary) for _ in range(size + k - 1)]
            for _ in range(6):
                copy = list(words)
                for _ in range(rng.randrange(0, 1 + size // 12 + 1)):
                    at = rng.randrange(len(copy))
                    copy[at : at + 1] = rng.choice([[], [rng.choice(vocabulary)], [copy[at], rng.choice(vocabulary)]])
                texts.append(" ".join(copy))
            texts.append(" ".join(words).upper())
    rng.shuffle(texts)
    texts = [*enumerate(texts), (9990, None), (9991, ""), (9992, " ")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in setjoin.groups(docs_of(texts), words=k, share=share).collect()}
    assert got == brute_groups(texts, k, *share)


def test_group_edges(docs_of, odd):
    rows = setjoin.groups(docs_of(odd)).collect()
    assert len(rows) == len(odd)
    got = {r["doc_id"]: r["component_id"] for r in rows}
    assert got[5] == 4 and got[9] == 8 and got[1] == 1 and got[2] == 2 and got[None] is None
    kept = setjoin.first_of_group(docs_of(odd))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 4, 6, 7, 8]
    assert setjoin.groups(docs_of([])).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, None), (7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- queries and pipeline ----------------------------------------------------------------------


def test_query_columns(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in ("op2_pii", "op4_license_rules", "op5_toxicity", "op7_imatch", "op9_quality_rules", "op10_jaccard_join"):
        assert QUERIES[name](spark, sf).count() == documents, name
    assert QUERIES["op1_url_verdicts"](spark, sf).count() == spark.read.parquet(f"{sf}/pages.parquet").count()


def test_pipeline(spark, sf, monkeypatch):
    """Every stage against brute force on what its predecessor kept."""
    import corpus_pipeline
    from test_tokens import WORDS as TOKENIZER
    from tokenizers import Tokenizer

    models = []
    train = toxicity.train
    monkeypatch.setattr(toxicity, "train", lambda *args: models.append(train(*args)) or models[-1])
    docs, columns = spark.read.parquet(f"{sf}/documents.parquet"), None
    texts = {}
    for name, stage in corpus_pipeline.STAGES:
        before, columns = texts or {r["doc_id"]: r["text"] for r in docs.collect()}, columns or docs.columns
        docs = corpus_pipeline.stored(spark, stage(spark, docs, sf), f"test-{name}")
        rows = docs.collect()
        if name != "packing":
            assert docs.columns == columns
            texts = {r["doc_id"]: r["text"] for r in rows}
            assert len(rows) == len(texts) and set(texts) <= set(before)
        if name == "quality":  # too few labels here to prove a cutoff
            assert set(texts) == {i for i, t in before.items() if not base_counts(t)[-1]}
        if name == "toxicity":
            weights = dict(zip(models[0].buckets.tolist(), models[0].weights.tolist()))
            grams = toxicity.Grams()
            with np.errstate(over="ignore"):
                odds = {i: models[0].intercept + sum(weights.get(g, 0.0) for g in set(grams(t).tolist())) for i, t in before.items()}
            assert set(texts) == {i for i, x in odds.items() if 1 / (1 + math.exp(-x)) < 0.3}
        if name == "near_duplicates":
            assert set(texts) == {i for i, (_, root) in brute_groups(list(before.items()), 5, 80, 100).items() if root == i}
        if name == "personal_data":
            assert set(texts) == set(before)
            for i, t in before.items():
                spans = base_spans(t)
                assert (texts[i] == t) == (not spans)
                assert all(t[s:e] not in texts[i] for s, _, e, kind in spans if kind == "email")
                assert all(r["n_chars"] == len(r["text"]) for r in rows)
    tokenizer = Tokenizer.from_str(TOKENIZER)
    tokenizer.encode_special_tokens = True
    covered = Counter()
    for r in rows:
        covered[r["doc_id"]] += r["length"]
        assert r["doc_tokens"] == len(tokenizer.encode(before[r["doc_id"]], add_special_tokens=False).ids) + 1
    assert covered == {r["doc_id"]: r["doc_tokens"] for r in rows} and set(covered) == set(before)


def test_gram_sets():
    """Distinct n-grams against a plain loop over the text."""
    grams, text = toxicity.Grams(), "Ab cab CAB é\U0001f600"
    low_text = text.lower()
    count = len({low_text[i : i + n] for n in toxicity.SIZES for i in range(len(low_text) - n + 1)})
    with np.errstate(over="ignore"):
        found = grams(text)
        assert len(found) == len(set(found.tolist())) == count
        assert set(grams("xyz").tolist()) == set(grams("XYZ").tolist()) and len(grams("xy")) == 0
