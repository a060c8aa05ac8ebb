"""Token operators against the tokenizer libraries."""

import base64
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from kinora.llm import bytebpe, idstore, packing
from kinora.llm.queries import PATTERN, QUERIES, vocabulary
from kinora.llm.wordbpe import WordEncoder
from kinora.session import scratch_path

WORDS = vocabulary("word_bpe_49k.json")
RANKS = vocabulary("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_str(WORDS)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(t): int(r) for t, r in map(str.split, RANKS.splitlines())}
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_ids_of_odd_characters(whole):
    encoder = WordEncoder(WORDS)
    texts = [f"a{chr(c)} {chr(c)}1{chr(c)}'S b{chr(c)}\u0301 \u0301x" for c in [*range(0x600), 0x2003, 0x3000, 0x4E2D, 0xFEFF, 0x1F600]]
    for text, payload in zip(texts, encoder.payloads(texts)):
        assert list(np.frombuffer(payload, "<u4")) == whole(text)[:-1], text


def pieces_hold(rows, texts, whole, window=2048):
    wanted = {}
    for key, text in texts:
        wanted.setdefault(key, []).append(whole(text))
    by_sequence, covered = {}, {}
    for r in rows:
        ids = list(np.frombuffer(r["ids"], "<u4"))
        assert len(ids) == r["length"] > 0
        assert any(ids == w[r["start"] : r["start"] + r["length"]] for w in wanted[r["doc_id"]])
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        covered[r["doc_id"]] = covered.get(r["doc_id"], 0) + r["length"]
    assert covered == {k: sum(map(len, w)) for k, w in wanted.items()}
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
    return len(by_sequence)


def test_packing(docs_of, odd, whole):
    rows = packing.pack(docs_of(odd).repartition(3), WORDS, fan_in=2).collect()
    pieces_hold(rows, odd, whole)


def test_packing_small_windows(docs_of, whole):
    texts = [(i, "one two three " * (i % 7)) for i in range(60)]
    rows = packing.pack(docs_of(texts).repartition(5), WORDS, window=16, open_windows=2, least_cut=4, fan_in=2).collect()
    used = pieces_hold(rows, texts, whole, window=16)
    total = sum(len(whole(t)) for _, t in texts)
    assert used <= total / 16 * 1.35


def test_store_and_lookup(spark, docs_of, odd, whole):
    docs, path = docs_of(odd).repartition(3), scratch_path(spark, "store")
    parts = idstore.write(docs, path, WORDS, shards=5)
    got = sorted(idstore.contents(spark, path, docs, parts).collect(), key=lambda r: r["start"])
    at = 0
    for r, (key, text) in zip(got, sorted(odd, key=lambda x: (-1 if x[0] is None else x[0], x[1] or ""))):
        ids = whole(text)
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (key, at, len(ids))
        assert list(np.frombuffer(r["ids"], "<u4")) == ids
        at += len(ids)
    assert len(got) == len(odd)
    absent = spark.createDataFrame([(777, 0), (4, 2)], "key long, ordinal long")
    assert idstore.lookup(spark, path, absent, parts).count() == 0


def test_perfect_hash_is_a_bijection():
    rng = np.random.default_rng(1)
    with np.errstate(over="ignore"):
        for n in (1, 2, 3, 10, 1000, 20_000):
            keys = rng.integers(0, 2**63, n).astype(np.uint64)
            displacements, slots = idstore.build_mph(keys)
            assert sorted(slots) == list(range(n))
            assert (idstore.find(keys, displacements, n) == slots).all()


def test_byte_bpe(docs_of, odd, library):
    texts = [*odd, (10, "a  b \n c\n\n d 's I'm  "), (11, "  lead"), (12, "x\n"), (13, "tab\t end ")]
    encoded = bytebpe.encode(docs_of(texts).repartition(2), RANKS, PATTERN, block_chars=40, stable=False)
    got = {}
    for r in bytebpe.decode(encoded, RANKS).collect():
        got.setdefault(r["doc_id"], []).append((r["n_tokens"], np.frombuffer(r["ids"], "<u4").tolist(), bytes(r["decoded"])))
    for key, text in texts:
        ids = library(text or "")
        assert (len(ids), ids, (text or "").encode()) in got[key]
    assert sum(map(len, got.values())) == len(texts)


@pytest.mark.parametrize("empty", [[]])
def test_empty_tables(spark, docs_of, empty):
    docs = docs_of(empty)
    assert packing.pack(docs, WORDS).count() == 0
    path = scratch_path(spark, "store")
    assert idstore.contents(spark, path, docs, idstore.write(docs, path, WORDS)).count() == 0
    assert bytebpe.encode(docs, RANKS, PATTERN).count() == 0


def test_queries(spark, sf, whole, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    at = 0
    for r in QUERIES["op8_token_id_store"](spark, sf).orderBy("doc_id").collect():
        ids = whole(texts[r["doc_id"]])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)
    for r in QUERIES["op3_pack_sequences"](spark, sf).collect():
        ids = whole(texts[r["doc_id"]])
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == crc(ids[r["start"] : r["start"] + r["length"]])
    for r in QUERIES["op6_byte_bpe"](spark, sf).collect():
        ids = library(texts[r["doc_id"]])
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_block_splits_as_the_pattern_does():
    """Texts of odd white space and repeated pieces, through one block and through several."""
    import random

    import regex

    rng = random.Random(7)
    pool = ["a", "don't", "x1y22", " ", "  ", "\n", " \n", "\t", "é", "中文", "!!", "'s", " ", "B-c", "", "word", "word"]
    texts = ["".join(rng.choice(pool) + rng.choice(["", " "]) for _ in range(rng.randrange(12))) for _ in range(400)]
    pattern = regex.compile(PATTERN)
    for some in (texts, texts[:1], texts[5:9], ["x"], [""], ["", ""]):
        counts, at, words = bytebpe.split_block(pa.array(some), pattern)
        words, done = words.to_pylist(), 0
        for text, count in zip(some, counts):
            assert [words[p] for p in at[done : done + count]] == pattern.findall(text)
            done += count
        assert done == len(at) and len(words) == len(set(words)) == len(set(at.tolist()))


def test_merger_equals_the_library():
    merger = bytebpe.Merger(bytebpe.read_ranks(RANKS), PATTERN)
    words = [b"word", b" word", b" 12", b"a", b" ", b"\n", b"12", "é".encode(), b" x", b"A1", b"!?", b" " + b"z" * 50, b""]
    assert merger.ids(words) == {w: np.array(merger.merge.encode_ordinary(w.decode()), "<u4").tobytes() for w in words}
    assert merger.ids([]) == {}


def test_word_cache_of_any_size_gives_the_same_ids():
    import random

    rng = random.Random(8)
    texts = [" ".join(rng.choice(["the", "Word,", "it's"]) + str(rng.randrange(300)) * rng.randrange(2) for _ in range(50)) for _ in range(40)]
    small, large = WordEncoder(WORDS, 5), WordEncoder(WORDS)
    want = large.payloads(texts)
    for _ in range(2):
        assert [p for t in texts for p in small.payloads([t])] == want


def test_store_of_a_wide_vocabulary(spark, docs_of):
    """Above 65,536 tokens ids take four bytes; what is read back is what was written."""
    import json

    wide = json.loads(WORDS)
    vocabulary = wide["model"]["vocab"]
    merges, base = wide["model"]["merges"], max(vocabulary.values()) + 1 + len(wide["added_tokens"])
    assert base < 1 << 16
    vocabulary.update({f"unused{i}": base + i for i in range(70_000 - base)})
    tokens = [t for t, i in vocabulary.items() if 1000 <= i < 1200]
    for i, token in enumerate(tokens):  # some words' ids move above the two-byte range
        other = f"unused{70_000 - base - 1 - i}"
        vocabulary[token], vocabulary[other] = vocabulary[other], vocabulary[token]
    text = json.dumps(wide)
    whole = Tokenizer.from_str(text)
    texts = {i: " ".join(t.replace("</w>", "") for t in tokens[i::7] if t.replace("</w>", "").isalpha()) for i in range(7)}
    want = {i: [*whole.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    assert max(max(x) for x in want.values()) > 1 << 16 and merges
    docs, path = docs_of(list(texts.items())), scratch_path(spark, "wide-store")
    got = idstore.contents(spark, path, docs, idstore.write(docs, path, text)).collect()
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in got} == want


def test_a_second_tokenizer_is_not_served_by_the_first(spark, docs_of):
    """A reused worker that encoded with one tokenizer encodes with the next one given, in the store and in packing."""
    import json

    swapped = json.loads(WORDS)
    vocabulary = swapped["model"]["vocab"]
    a, b = "the</w>", "of</w>"
    vocabulary[a], vocabulary[b] = vocabulary[b], vocabulary[a]
    other = json.dumps(swapped)
    texts = {1: "the of the", 2: "of the of"}
    docs = docs_of(list(texts.items())).coalesce(1)
    for model in (WORDS, other):
        whole = Tokenizer.from_str(model)
        want = {i: [*whole.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
        path = scratch_path(spark, "second-store")
        got = idstore.contents(spark, path, docs, idstore.write(docs, path, model)).collect()
        assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in got} == want
        pieces = packing.pack(docs, model).collect()
        assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in pieces} == want


def test_word_cache_stays_small_on_many_distinct_words(whole):
    """Every Python worker keeps an encoder: its words stay bounded however many distinct words its texts hold."""
    encoder = WordEncoder(WORDS)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = []
    for call in range(12):
        words = ["".join(letters[(n // 26**k) % 26] for k in range(5)) for n in range(call * 15_000, (call + 1) * 15_000)]
        texts = [" ".join(words[at : at + 100]) for at in range(0, len(words), 100)]
        got = encoder.payloads(texts)
        assert len(encoder.words) + len(encoder.old) <= 150_000
    assert [np.frombuffer(g, "<u4").tolist() + [1] for g in got[:20]] == [whole(t) for t in texts[:20]]
