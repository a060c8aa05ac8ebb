"""Whole results of op1, op5 and op7 against recounts by hand."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from kinora.llm import imatch, toxicity, urls
from kinora.llm.idstore import mix
from kinora.llm.queries import URL_RULES

PARTS = re.compile(r"[^\W_]+")


# -- urls ---------------------------------------------------------------------------------------


def split_url(url):
    _, there, rest = (url or "").partition("://")
    if not there:
        return "", ""
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path):
    fits = []
    for verdict, rule in URL_RULES:
        domain, _, start = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def verdicts(rows):
    """page -> (rule, verdict, score) by counting words and tokens."""
    counts = Counter(w for _, _, html in rows for w in re.findall(r"[^\W\d_]+", re.sub(r"<[^>]*>", " ", html.lower())) if 1 < len(w) <= urls.MAX_WORD)
    total = sum(counts.values()) or 1
    tokens, known = {}, {}
    for page, url, _ in rows:
        host, path = split_url(url)
        words = []
        for label in PARTS.findall(host):
            words += urls.best_split(label, list(counts), list(counts.values()), total) if len(label) <= urls.MAX_LABEL else [label]
        tokens[page] = ["h:" + w for w in words] + ["p:" + re.sub("[0-9]+", "0", w) for w in PARTS.findall(path.lower())]
        known[page] = rule_of(host, path)
    by = {c: Counter(t for p in tokens for t in tokens[p] if known[p][1] == c) for c in ("block", "allow")}
    n = {c: sum(1 for p in known if known[p][1] == c) for c in by}
    vocabulary = set(by["block"]) | set(by["allow"])

    def weight(token):
        rate = {c: (by[c][token] + 1) / (sum(by[c].values()) + len(vocabulary) + 1) for c in by}
        return math.log(rate["block"] / rate["allow"])

    out = {}
    for page in tokens:
        rule, verdict = known[page]
        if rule:
            out[page] = (rule, verdict, None)
            continue
        seen = [t for t in tokens[page] if t in vocabulary]
        score = sum(map(weight, seen)) + math.log(n["block"] / n["allow"])
        usual = "block" if n["block"] > n["allow"] else "allow"
        out[page] = (None, usual if not seen else "block" if score > 0 else "allow", score)
    return out


def test_url_verdicts_equal_a_recount(spark):
    rng = random.Random(3)
    good, bad = ["sun", "river", "stone", "paper"], ["spam", "shop", "cheap", "deal"]
    rows = []
    for i in range(240):
        words = rng.choice([good, bad])
        name = "".join(rng.choices(words, k=2)) + rng.choice(["", "-" + rng.choice(good + bad), "." + rng.choice(words)])
        end = rng.choice([".com", ".net/es", ".net/fr", ".org", ".org", ".info"])
        path = "/".join(["", *(rng.choice(good + bad) + str(rng.randrange(30)) for _ in range(rng.randrange(3)))])
        html = f"<p class='x'>{' '.join(rng.choices(good + bad, k=20))}</p>"
        rows.append((i, f"http://{name}{end}{path or '/'}", html))
    rows += [(900, "x://shop.shop.shop.org/", ""), (901, "nothing", ""), (902, None, ""), (903, "x://" + "sun" * 30 + ".org/" + "deal/" * 500, "")]
    rows += [(1000 + i, "http://hothost.org/spam", "") for i in range(700)]  # a hot host
    clash = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "page_id long, url string, html string, host string, row int, tokens string")
    got = {r["page_id"]: (r["rule"], r["verdict"], r["score"]) for r in urls.judge(clash, URL_RULES).collect()}
    want = verdicts(rows)
    assert set(got) == set(want) and len({v for _, v, s in want.values() if s is not None}) == 2
    for page, (rule, verdict, score) in want.items():
        assert got[page][0] == rule
        assert (got[page][2] is None) == (score is None)
        if score is not None:
            assert got[page][2] == pytest.approx(score)
        if score is None or abs(score) > 1e-9:
            assert got[page][1] == verdict, page


# -- fingerprints ---------------------------------------------------------------------------------


def digest(text, lexicon):
    """The fingerprint of a text, subset by subset and term by term."""
    folded = re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    words = set(folded.split(" ")) - {""}
    named = {w: xxhash.xxh64_intdigest(w.encode(), imatch.SEED) for w in words}
    terms = [h for w, h in named.items() if w in lexicon]
    if len(terms) < imatch.FEW:
        terms = list(named.values()) or ([xxhash.xxh64_intdigest(text.encode(), imatch.SEED)] if text else [])
    out = []
    with np.errstate(over="ignore"):
        for i, rate in enumerate(imatch.RATES):
            salt = mix(np.uint64(i + 1) * np.uint64(0x9E3779B97F4A7C15))
            mixed = [mix(np.uint64(h) + salt) for h in terms]
            held = [x for x in mixed if rate >= 1 or int(x) < int(rate * 2**64)]
            total = sum(int(mix(x)) for x in held) % 2**64
            out.append(int(mix(np.uint64(total))) % 65535 + 1 if held else 0)
    return out


def test_fingerprints_equal_a_recount(docs_of):
    rng = random.Random(4)
    vocabulary = [f"term{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    rows = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(60)))) for i in range(80)] + [(90, "Ünï Ünï, lone"), (91, ""), (92, None), (93, "...")]
    least, most = 0.05, 0.4
    of = {i: set(re.findall(r"[^\W_]+", (t or "").lower())) for i, t in rows}
    df = Counter(w for words in of.values() for w in words)
    lexicon = {w for w, n in df.items() if least * len(rows) <= n <= most * len(rows)}
    assert 10 < len(lexicon) < len(df)
    texts = {i: t or "" for i, t in rows}
    order = sorted(texts, reverse=True)
    got = {r["doc_id"]: r for r in imatch.fingerprints(docs_of(rows), least_share=least, most_share=most).collect()}
    for i, key in enumerate(order):
        text, following = texts[key], texts[order[(i + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other, after = digest(text, lexicon), digest(edited, lexicon), digest(following, lexicon)
        r = got[key]
        assert r["fingerprint"] == "".join(f"{x:04x}" for x in own) and r["edited_fingerprint"] == "".join(f"{x:04x}" for x in other)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for near, b in (("near_edited", other), ("near_next", after)):
            held = [(x, y) for x, y in zip(own, b) if x or y]
            assert r[near] == pytest.approx(sum(x == y for x, y in held) / len(held) if held else 1.0)


# -- toxicity ---------------------------------------------------------------------------------------


def test_toxicity_fit_equals_a_recount(spark, docs_of):
    """Class counts and log ratios by hand; the weights are where the gradient of the penalised loss is zero."""
    rng = random.Random(5)
    plain, foul = ["sun", "river", "stone", "cloud"], ["scoundrel", "villain"]
    texts = [" ".join(rng.choices(plain, k=12) + (rng.choices(foul, k=2) if i % 3 == 0 else [])) for i in range(150)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id long, toxic int")
    model = toxicity.train(docs_of(list(enumerate(texts))), labels)
    grams = toxicity.Grams()
    with np.errstate(over="ignore"):
        rows = [set(grams(t).tolist()) for t in texts[:120]]
    y = np.array([i % 3 == 0 for i in range(120)], float)
    count = {c: Counter(b for r, label in zip(rows, y) if label == c for b in r) for c in (0, 1)}
    ratio = {}
    for b in set(count[0]) | set(count[1]):
        p = (count[1][b] + toxicity.SMOOTHING) / (y.sum() + 2 * toxicity.SMOOTHING)
        q = (count[0][b] + toxicity.SMOOTHING) / ((1 - y).sum() + 2 * toxicity.SMOOTHING)
        ratio[b] = math.log(p / q)
    kept = {b for b in ratio if count[0][b] + count[1][b] >= toxicity.LEAST_TEXTS}
    assert set(model.buckets.tolist()) == kept  # fewer than the most
    features = np.array([[ratio[b] * (b in r) for b in model.buckets.tolist()] for r in rows])
    share = np.array([ratio[b] for b in model.buckets.tolist()])
    weights = np.where(share != 0, model.weights / np.where(share == 0, 1, share), 0.0)
    error = 1 / (1 + np.exp(-(features @ weights + model.intercept))) - y
    gradient = features.T @ error / len(y) + toxicity.PENALTY * weights
    assert np.abs(gradient).max() < 1e-3 and abs(error.mean()) < 1e-3
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs_of(list(enumerate(texts))), model).collect()}
    assert got[0] == pytest.approx(1 / (1 + math.exp(-(features[0] @ weights + model.intercept))), rel=1e-6)
