"""Content sort, periodic runs and lexical search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from kinora.llm import contentsort, lexical, periodic
from kinora.llm.queries import ORACLES, QUERIES, looped

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# -- content sort --------------------------------------------------------------------------------


def copies(rows, keep):
    """{(key, text): (keep, size, times kept)} by hand."""
    of_text = defaultdict(list)
    for key, text in rows:
        of_text[text or ""].append(key)
    best = {}
    for text, keys in of_text.items():
        known = [k for k in keys if k is not None]
        best[text] = ((max if keep == "largest" else min)(known) if known else None, len(keys))
    return {(k, t or ""): best[t or ""] for k, t in rows}


def check_copies(got, rows, keep):
    want = copies(rows, keep)
    sha = {hashlib.sha256((t or "").encode()).hexdigest(): t or "" for _, t in rows}
    assert len(got) == len(rows)
    kept = Counter()
    for r in got:
        text = sha[r["text_sha256"]]
        assert (r["keep_id"], r["group_size"]) == want[r["doc_id"], text]
        if r["kept"]:
            kept[text] += 1
            assert r["doc_id"] == r["keep_id"]
    assert kept == Counter({t: 1 for t in sha.values()})


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("heavy", [contentsort.HEAVY, 2])
def test_content_sort(spark, docs_of, odd, keep, heavy):
    """Odd rows, a text of a third of all rows over many tasks, long common beginnings; with the salted way and without."""
    rng = random.Random(1)
    lead = "the same long beginning " * 20
    rows = odd + [(100 + i, "hot" if i % 3 == 0 else lead + str(rng.randrange(40))) for i in range(600)]
    rng.shuffle(rows)
    found = contentsort.groups(docs_of(rows).repartition(7), keep=keep, heavy=heavy)
    check_copies(found.collect(), rows, keep)


def test_content_sort_normal_and_whole_rows(spark, docs_of):
    docs = docs_of([(3, "A b"), (1, "a  B"), (2, "c"), (None, "C"), (None, None), (None, "")])
    found = contentsort.deduplicated(docs, normal=lambda text: F.lower(F.regexp_replace(text, r"\s+", " ")))
    assert found.schema == docs.schema
    assert sorted((r["doc_id"] or 0, (r["text"] or "").lower()) for r in found.collect()) == [(0, ""), (1, "a  b"), (2, "c")]
    assert contentsort.groups(docs_of([])).count() == 0
    assert contentsort.deduplicated(docs_of([])).columns == docs.columns


def test_content_sort_runs_cross_batches(spark, docs_of):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = [(i, f"t{i % 4}") for i in range(50)]
        check_copies(contentsort.groups(docs_of(rows).coalesce(2), heavy=1).collect(), rows, "smallest")
        check_copies(contentsort.groups(docs_of(rows).coalesce(1)).collect(), rows, "smallest")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


# -- periodic runs ---------------------------------------------------------------------------------


def all_runs(words):
    """Every run by trying all periods and stretches."""
    found = []
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            start, length = i - q, j - i + q
            stretch = words[start:j]
            smallest = next(p for p in range(1, q + 1) if all(stretch[k] == stretch[k - p] for k in range(p, length)))
            if smallest == q and length >= max(6, 4 * q):
                found.append((start, length, q))
            i = j
    return sorted(found)


def test_runs_match_brute_force():
    rng = random.Random(2)
    for case in range(1500):
        words = []
        while len(words) < rng.choice([5, 20, 60, 140]):
            part = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randrange(1, 13))]
            words += part * rng.choice([1, 1, 2, 3, 4, 5, 9])
            if rng.random() < 0.2 and len(words) < 50:
                words = (words + [9]) * rng.choice([1, 4, 5])  # runs within runs
        words = words[: rng.randrange(1, len(words) + 1)]
        assert periodic.runs(words) == all_runs(words), words


def test_lag_classes_cover_all_lags():
    for words in (0, 5, 6, 7, 8, 100, 5000):
        lags = [q for low, high, _ in periodic.lag_classes(words) for q in range(low, high + 1)]
        assert lags == list(range(1, len(lags) + 1)) and all(q <= len(lags) for q in range(1, words // 4 + 1) if words >= 6)
        for low, high, context in periodic.lag_classes(words):
            assert 2 * high - 1 <= context <= max(5, 3 * low)


def expected(key, text):
    words = WORDS.findall(text or "")
    h, n = zlib.crc32(str(key).encode()), len(words)
    if key is not None and n and h % 10 == 0:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = all_runs(words) if len(words) < 2000 else periodic.runs([hash(w) for w in words])
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    text_of_runs = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(found), *best, best[1] and 1000 * best[1] // best[2], *(hashlib.sha256(x.encode()).hexdigest() for x in (text_of_runs, kept)))


def test_runs_query(spark, docs_of, odd, tmp_path):
    rng = random.Random(3)
    rows = odd + [(100 + i, " ".join(f"w{rng.randrange(6)}" for _ in range(rng.randrange(200)))) for i in range(150)]
    rows += [(900, "a\tb\n" * 300), (901, "ha " * 50), (902, "x y x y x y x y x y x y z " * 5)]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert sorted(((r["doc_id"], *(r[n] for n in names)) for r in got), key=str) == sorted(((k, *expected(k, t)) for k, t in rows), key=str)
    assert any(r["n_runs"] > 0 for r in got)


def test_runs_operator(spark, docs_of):
    rows = [(1, "go " * 8 + "stop"), (2, None), (None, "a b " * 4), (1, "go " * 8 + "stop")]
    got = sorted((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.find(docs_of(rows)).collect())
    assert got == [(0, 8, [(0, 8, 2)], "a b"), (1, 9, [(0, 8, 1)], "go stop"), (1, 9, [(0, 8, 1)], "go stop"), (2, 0, [], "")]
    assert periodic.find(docs_of([])).count() == 0


def test_one_word_repeated_is_not_quadratic():
    assert periodic.runs([7] * 200_000) == [(0, 200_000, 1)]


def test_edit_of_the_query():
    key = next(k for k in range(1000) if zlib.crc32(str(k).encode()) % 10 == 0)
    words = [str(i).encode() for i in range(40)]
    g = zlib.crc32(str(key).encode()) // 10
    a = g % 40
    p = 1 + (40 - a) // (3 + g % 8)
    assert looped(key, words) == [words[i] if i < a else words[a + (i - a) % p] for i in range(40)]
    assert looped(None, words) == words and looped(key, []) == []


# -- lexical search ----------------------------------------------------------------------------------


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def ranked(rows, items, k=20):
    docs = [(key, Counter(TERMS.findall(low(text)))) for key, text in rows]
    n_docs = sum(1 for _, bag in docs if bag)
    n_terms = sum(sum(bag.values()) for _, bag in docs)
    df = Counter(t for _, bag in docs for t in bag)
    out = []
    wanted = defaultdict(Counter)
    for item, text in set(items):
        wanted[item].update(TERMS.findall(low(text)))
    for item, terms in wanted.items():
        scores = []
        for key, bag in docs:
            m = 75 + (25 * sum(bag.values()) * n_docs) // max(1, n_terms)
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m))
                for t, times in terms.items() if t in bag
            )
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, i + 1, key, -s) for i, (s, _, _, key) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, doc_id int")


@pytest.mark.parametrize("block", [lexical.BLOCK, 30])
def test_search_matches_brute_force(spark, docs_of, odd, block):
    """Ties, copies far beyond k, odd rows; one block of items and many."""
    rng = random.Random(4)
    vocabulary = [f"W{i}" for i in range(60)] + ["Été", "naïve", "日本"]
    rows = odd + [(1000 - i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40)))) for i in range(300)]
    rows += [(2000 + i, "w1 w2 W2, w3") for i in range(90)] + [(None, "w1 w2 w2 w3"), (None, "w4"), (2000, "w1 w2 w2 w3")]
    items = [(i, " ".join(rng.choices(vocabulary, k=8))) for i in range(15)]
    items += [(50, "w1 w2 w3"), (51, None), (52, "nowhere"), (None, "w4 w5"), (53, "w4"), (53, "w4"), (53, "w6 w6")]
    got = lexical.search(docs_of(rows).repartition(5), items_of(spark, items), block=block).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=str) == ranked(rows, items)


def test_search_small_steps(spark, docs_of, monkeypatch):
    """Many steps and batches a task keep the same best."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("abcdef", k=rng.randrange(1, 9)))) for i in range(200)]
    items = [(1, "a b"), (2, "c c d"), (3, "f")]
    monkeypatch.setattr(lexical, "CELLS", 7)
    got = lexical.search(docs_of(rows).coalesce(1), items_of(spark, items), k=5).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=str) == ranked(rows, items, 5)


def test_search_empty_tables(spark, docs_of):
    assert lexical.search(docs_of([]), items_of(spark, [(1, "a")])).count() == 0
    assert lexical.search(docs_of([(1, "a")]), items_of(spark, [])).count() == 0
    assert lexical.search(docs_of([(1, None)]), items_of(spark, [(1, "a")])).columns == ["item_id", "rank", "doc_id", "score"]


def test_sql_of_copies_and_search(spark, sf):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    for name in ("op11_content_sort", "op13_lexical_search"):
        result = con.sql(ORACLES[name])
        got = QUERIES[name](spark, sf)
        rows = sorted(map(tuple, got.select(*result.columns).collect()))
        assert rows == sorted(result.fetchall()) and len(rows) > 0
