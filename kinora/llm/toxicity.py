"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Each text is the set of its hashed character n-grams.  From labelled texts come, per n-gram, the share of toxic and of
other texts that have it; the logarithm of their ratio scales the feature, and a logistic regression is fitted on the
scaled features.  Only n-grams that tell the classes apart get a weight; the model is a table of bounded size.

Training takes at most ``max_rows`` labelled rows, chosen by the hash of their id; scoring takes every row.

Defined cases: null and empty texts have no n-grams and score by the intercept; rows with a null label are not used;
a document labelled twice counts twice; without both classes among the labels every score is the toxic share (0 without
labels); an empty table gives no rows.
"""

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from kinora.llm.common import keyed_text, once_per_worker, stored
from kinora.llm.idstore import mix

SIZES = (3, 4, 5)
BUCKETS = 1 << 20
MAX_ROWS = 20_000
MAX_FEATURES = 1 << 14
LEAST_TEXTS = 4
SMOOTHING = 1.0
PENALTY = 0.002
ITERATIONS = 60


@dataclass
class Model:
    buckets: np.ndarray  # n-gram buckets with a weight
    weights: np.ndarray
    intercept: float


class Grams:
    """Distinct n-gram buckets of a text."""

    def __init__(self):
        self.last = np.zeros(BUCKETS, np.int32)

    def __call__(self, text):
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        hashes, h = [], codes
        for n in range(2, max(SIZES) + 1):
            if len(codes) < n:
                break
            h = h[:-1] * np.uint64(0x100000001B3) + codes[n - 1 :]
            if n in SIZES:
                hashes.append((mix(h + np.uint64(n)) >> np.uint64(44)).astype(np.int32))
        if not hashes:
            return np.zeros(0, np.int32)
        found = np.concatenate(hashes)
        order = np.arange(len(found), dtype=np.int32)
        self.last[found] = order  # of equal buckets, the last place wins
        return found[self.last[found] == order]


def _sample(labels, key, label, max_rows):
    """Ids and labels of the training rows: all, or those of the smallest id hashes."""
    rows = labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    return rows.where("doc_id is not null and label is not null").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)


def train(docs, labels, key="doc_id", text="text", label="toxic", max_rows=MAX_ROWS):
    """Fit on ``labels`` (key, label): the caller leaves out what must not be learnt from."""
    spark = docs.sparkSession
    chosen = stored(spark, _sample(labels, key, label, max_rows), "training-ids")
    # At most max_rows ids: the texts are picked without moving the others.
    texts = keyed_text(docs, key, text).join(F.broadcast(chosen), "doc_id").select("label", "text")

    def counted(arrow):
        grams = Grams()
        counts, rows = np.zeros((2, BUCKETS), np.int64), [0, 0]
        for batch in arrow:
            with np.errstate(over="ignore"):
                for y, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    counts[int(y > 0), grams(content)] += 1
                    rows[int(y > 0)] += 1
        some = np.flatnonzero(counts.sum(axis=0))
        columns = [np.append(some, -1), np.append(counts[0, some], rows[0]), np.append(counts[1, some], rows[1])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["bucket", "other", "toxic"])

    counts = stored(
        spark,
        texts.mapInArrow(counted, "bucket long, other long, toxic long")
        .groupBy("bucket")
        .agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")),
        "gram-counts",
    )
    totals = counts.where("bucket = -1").first()
    others, toxics = (totals["other"], totals["toxic"]) if totals else (0, 0)
    if not others or not toxics:
        share = toxics / max(1, others + toxics)
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log((share or 1e-9) / ((1 - share) or 1e-9))))
    p = (F.col("toxic") + SMOOTHING) / F.lit(toxics + 2 * SMOOTHING)
    q = (F.col("other") + SMOOTHING) / F.lit(others + 2 * SMOOTHING)
    telling = (
        counts.where(f"bucket >= 0 and other + toxic >= {LEAST_TEXTS}")
        .withColumn("ratio", F.log(p / q))
        .orderBy(F.desc((p - q) * F.col("ratio")), "bucket")
        .limit(MAX_FEATURES)
        .select("bucket", "ratio")
        .collect()  # at most MAX_FEATURES rows
    )
    if not telling:
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(toxics / others)))
    buckets, ratios = np.array([r["bucket"] for r in telling]), np.array([r["ratio"] for r in telling])
    kept = spark.sparkContext.broadcast(buckets)

    def listed(arrow):
        grams, wanted = Grams(), np.zeros(BUCKETS, bool)
        wanted[kept.value] = True
        for batch in arrow:
            with np.errstate(over="ignore"):
                found = [grams(content) for content in batch.column(1).to_pylist()]
            names = [[str(i) for i in f[wanted[f]].tolist()] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.float64()), pa.array(names, pa.list_(pa.string()))], names=["label", "grams"]
            )

    rows = texts.withColumn("label", F.when(F.col("label") > 0, 1).otherwise(0)).mapInArrow(listed, "label double, grams array<string>")
    rows = stored(spark, rows, "training-grams")
    vectors = CountVectorizerModel.from_vocabulary([str(b) for b in buckets], "grams", "present", minTF=0.0, binary=True)
    scale = ElementwiseProduct(scalingVec=Vectors.dense(ratios), inputCol="present", outputCol="features")
    regression = LogisticRegression(regParam=PENALTY, maxIter=ITERATIONS, standardization=False)
    fitted = regression.fit(scale.transform(vectors.transform(rows)).select("label", "features"))
    return Model(buckets, fitted.coefficients.toArray() * ratios, float(fitted.intercept))


def _scorer(held):
    def build():
        weights = np.zeros(BUCKETS)
        weights[held.value.buckets] = held.value.weights
        return Grams(), weights

    return build


def _scores(texts, grams, weights, intercept):
    with np.errstate(over="ignore"):
        sums = [intercept + weights[grams(text or "")].sum() for text in texts]
    return 1 / (1 + np.exp(-np.clip(np.array(sums, float), -50, 50)))


def score(docs, model, key="doc_id", text="text"):
    """doc_id and score (0 to 1) of every row."""
    held, version = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def scored(arrow):
        grams, weights = once_per_worker("toxicity", _scorer(held), version)
        for batch in arrow:
            scores = _scores(batch.column(1).to_pylist(), grams, weights, held.value.intercept)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    return keyed_text(docs, key, text).mapInArrow(scored, "doc_id long, score double")


def held_out(key="doc_id"):
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def filtered(docs, model, cutoff, text="text"):
    """``docs`` whose score is below ``cutoff``, with their own columns (whatever their names)."""
    held, version = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    at = docs.columns.index(text)

    def below(arrow):
        grams, weights = once_per_worker("toxicity", _scorer(held), version)
        for batch in arrow:
            keep = _scores(batch.column(at).to_pylist(), grams, weights, held.value.intercept) < cutoff
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(below, docs.schema)
