"""I-Match fingerprints over several randomised lexicons.

The lexicon is the terms whose document share lies in a band, i.e. whose inverse document frequency is neither so low
that every text has them nor so high that one edit changes them.  A fingerprint has one 16-bit digest per lexicon
subset: the whole lexicon first, then random subsets at falling rates, each digesting the distinct terms of the text
that it holds.  Broad subsets agree for copies only; narrow ones survive edits, so the share of equal digests measures
likeness.

The lexicon is sent to all tasks.  It has at most (mean distinct terms per document) / ``least_share`` terms, whatever
the number of documents: a term of the lexicon takes ``least_share`` of the documents, and they have no more to give.

Defined cases: a text with fewer than ``FEW`` terms of the lexicon is judged by all its terms, one without terms by itself;
an empty text (null: empty) has a fingerprint of zeros, and two of them have likeness 1; null keys count as the
smallest; equal keys are ordered by text hash; the only document of a table is its own next one.
"""

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import functions as F

from kinora.llm.common import LEAST_LONG, keyed_text, once_per_worker, partitions, range_buckets
from kinora.llm.idstore import mix
from kinora.llm.licenses import _FOLD

LEAST_SHARE, MOST_SHARE = 0.002, 0.2
#: Share of the lexicon in each subset.
RATES = [1.0] + [1 / 2] * 3 + [1 / 4] * 6 + [1 / 8] * 8 + [r for r in (1 / 16, 1 / 32, 1 / 64, 1 / 128, 1 / 256) for _ in range(12)]
FEW = 4
SEED = 42
WORD_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_CACHED_WORDS = 500_000
ROWS_AT_ONCE = 20_000


def lexicon(docs, text="text", least_share=LEAST_SHARE, most_share=MOST_SHARE):
    """Hashes of the terms whose share of all documents lies in the band (``term long, df long``)."""
    words = F.split(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), WORD_SEPARATORS)
    terms = docs.select(F.explode(F.array_distinct(words)).alias("word")).where("word != ''")
    counts = terms.groupBy(F.xxhash64("word").alias("term")).agg(F.count(F.lit(1)).alias("df"))
    total = docs.count()
    return counts.where(F.col("df").between(least_share * total, most_share * total))


class Fingerprinter:
    """Digests of texts under a lexicon (sorted unsigned term hashes)."""

    def __init__(self, terms):
        self.terms = set(terms.tolist())
        self.known = {}  # word -> its hash, or 0 outside the lexicon
        salts = np.arange(1, len(RATES) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.salts = mix(salts)
        self.below = np.array([min(2**64 - 1, int(r * 2**64)) for r in RATES], np.uint64)
        self.everything = np.array([r >= 1 for r in RATES])

    def digest(self, text):
        raw = text.encode("utf-8", "surrogatepass")
        words = set(raw.translate(_FOLD).split(b" "))
        words.discard(b"")
        if len(self.known) > MAX_CACHED_WORDS:
            self.known = {}
        known = self.known
        for word in [w for w in words if w not in known]:
            h = xxhash.xxh64_intdigest(word, SEED)
            known[word] = h if h in self.terms else 0
        hashes = [h for h in map(known.__getitem__, words) if h]
        if len(hashes) < FEW:
            hashes = [xxhash.xxh64_intdigest(w, SEED) for w in words] or ([xxhash.xxh64_intdigest(raw, SEED)] if raw else [])
        sums, some = np.zeros(len(RATES), np.uint64), np.zeros(len(RATES), bool)
        terms = np.sort(np.array(hashes, np.uint64))
        for at in range(0, len(terms), ROWS_AT_ONCE):
            part = mix(terms[at : at + ROWS_AT_ONCE, None] + self.salts)
            member = (part < self.below) | self.everything
            sums += np.where(member, mix(part), np.uint64(0)).sum(axis=0, dtype=np.uint64)
            some |= member.any(axis=0)
        return np.where(some, mix(sums) % np.uint64(65535) + np.uint64(1), np.uint64(0)).astype(">u2")


def likeness(a, b):
    """Share of equal digests among the subsets that hold terms of either text."""
    held = (a != 0) | (b != 0)
    return float((a == b)[held].mean()) if held.any() else 1.0


def _next_rows(rows, count):
    """Rows dealt into ordered buckets, each followed by the first row of the bucket below (the lowest: the highest).

    ``rows`` has key; the result has bucket and guest besides.
    """
    spark = rows.sparkSession
    placed = range_buckets(rows, "key", count)
    # One row per bucket reaches the driver.
    tops = sorted((r["bucket"], r["top"]) for r in placed.groupBy("bucket").agg(F.max("key").alias("top")).collect())
    above = [(top, tops[(i + 1) % len(tops)][0]) for i, (_, top) in enumerate(tops)]
    guests = F.broadcast(spark.createDataFrame(above, "key long, above int"))
    own = F.struct(F.col("bucket"), F.lit(False).alias("guest"))
    other = F.struct(F.col("above").alias("bucket"), F.lit(True).alias("guest"))
    places = F.when(F.col("above").isNull(), F.array(own)).otherwise(F.array(own, other))
    return placed.join(guests, "key", "left").select(
        F.inline(places).alias("at_bucket", "guest"), *rows.columns
    ).withColumnRenamed("at_bucket", "bucket")


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprints(docs, key="doc_id", text="text", least_share=LEAST_SHARE, most_share=MOST_SHARE):
    """Fingerprint of every text, of its edited text, and their likeness.

    The edited text has its last half replaced by as much of the start of the next document, in falling key order.
    """
    spark = docs.sparkSession
    rows = keyed_text(docs, key, text)
    # Bounded as the module says.
    terms = np.array([r["term"] for r in lexicon(rows, "text", least_share, most_share).select("term").toLocalIterator()], np.int64)
    words, version = spark.sparkContext.broadcast(np.sort(terms.view(np.uint64))), uuid.uuid4().hex
    rows = rows.withColumns({"key": F.coalesce("doc_id", F.lit(LEAST_LONG)), "tie": F.xxhash64("text")})
    packed = "bucket int, guest boolean, key long, tie long, doc_id long, packed binary"

    def shrink(arrow):
        """Texts as small as they get before they move."""
        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in arrow:
            texts = [compress(t.encode()) for t in batch.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(texts, pa.binary())], names=[*batch.schema.names[:5], "packed"])

    def judge(arrow):
        maker = once_per_worker("lexicon", lambda: Fingerprinter(words.value), version)
        expand = zstandard.ZstdDecompressor().decompress
        held = None  # (bucket, doc_id, text, digest): waits for the next row
        for batch in arrow:
            out = []
            for bucket, guest, doc_id, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if guest and held is None:
                    continue
                content = expand(raw).decode()
                with np.errstate(over="ignore"):
                    digest = maker.digest(content)
                    if held is not None:
                        out.append(_edited(maker, *held, content, digest))
                held = None if guest else (doc_id, content, digest)
            columns = list(zip(*out)) if out else [[] for _ in range(7)]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in RESULT.split(", ")])

    if rows.isEmpty():
        return spark.createDataFrame([], RESULT)
    return (
        _next_rows(rows, 4 * partitions(spark))
        .select("bucket", "guest", "key", "tie", "doc_id", "text")
        .mapInArrow(shrink, packed)
        .repartition(partitions(spark), "bucket")
        .sortWithinPartitions("bucket", "guest", F.desc("key"), "tie")
        .select("bucket", "guest", "doc_id", "packed")
        .mapInArrow(judge, RESULT)
    )


def _edited(maker, doc_id, text, digest, other, other_digest):
    half = len(text) // 2
    edited = text[: len(text) - half] + other[:half]
    own = maker.digest(edited)
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited.encode()).hexdigest(),
        digest.tobytes().hex(),
        own.tobytes().hex(),
        likeness(digest, own),
        likeness(digest, other_digest),
    )
