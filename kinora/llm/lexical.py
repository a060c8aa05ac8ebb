"""Ranked lexical search that scores equal documents once.

1. Documents are restricted to the vocabulary of the items: a document is its bag of (term, occurrences) and its length
   norm m.  Document frequencies, the number of documents and their terms come from the same pass, over all documents.
2. Documents of one bag and m are one class.  Classes are formed by hash and verified: grouped by hash, m and the bag itself.
   A text that makes up a third of all rows is one class after the tasks' own partial grouping.
3. Each class is scored once against all items: its entries meet the postings of their terms, summed in one array.  A task
   keeps the k best classes of each item, so k rows an item and task are shuffled, no (document, item) pairs.
4. Only the winning classes are expanded, by ascending key; the k first members are enough.

Items are taken in blocks of about ``BLOCK`` (item, term) rows, so what is sent to the tasks (postings, vocabulary, k class
names an item) has that size however many items there are; each block is a pass over the documents.

Scores are whole numbers: a term's weight is floor(1000 ln((2N+2) / (2 df+1))), its share of the score
weight * ((10^9 tf) div (1000 tf + 12 m)), m = 100-25 + ((25 n N) div L).

Defined cases: a null text has no terms, and documents without terms do not count in N; a null key is a document like any
other and comes last among equals; repeated rows are documents of their own; equal items (same id and text) count once, and
the terms of several texts under one id are added; a null item id is an item; empty tables give no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from kinora.llm.common import keyed_text, stored

TOP = 20
BLOCK = 1 << 18
#: Most (class, item) cells and most classes that a task scores at once.
CELLS = 1_000_000
CLASSES = 512

BAGS = "doc_id long, n_terms long, bag binary"
COUNTS = "term int, documents long"
SCORED = "item int, score long, class long, least long"

#: A-Z lower-cased, other ASCII but digits and letters to blanks; bytes of other characters stay.
_TERM_BYTES = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def terms(text):
    """The terms of a text as bytes, in order."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def item_terms(items, key="item_id", text="text"):
    """item_id, term, times: the terms of the items with their occurrences."""
    texts = keyed_text(items, key, text).distinct()

    def counted(arrow):
        for batch in arrow:
            rows = [(k, t) for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for t in terms(text)]
            keys, found = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.binary())], names=["item_id", "term"])

    rows = texts.mapInArrow(counted, "item_id long, term binary")
    return rows.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))


def _bags(docs, numbers):
    """doc_id, n_terms and the bag: ascending term numbers, then their occurrences, as 4-byte integers."""

    def run(arrow):
        number = numbers.value.get
        for batch in arrow:
            keys, counts, bags = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms(text.as_py())
                own = np.array([x for x in map(number, words) if x is not None], "<i4")
                keys.append(key)
                counts.append(len(words))
                bags.append(b"".join(x.astype("<i4").tobytes() for x in np.unique(own, return_counts=True)))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(bags, pa.binary())], names=["doc_id", "n_terms", "bag"])

    return docs.mapInArrow(run, BAGS)


def _unpacked(bag):
    return np.frombuffer(bag, "<i4").reshape(2, -1)


def _document_counts(bags, size):
    """term number, documents that hold it; ``size`` terms."""

    def run(arrow):
        held = np.zeros(size, np.int64)
        for batch in arrow:
            own = [_unpacked(b)[0] for b in batch.column(0).to_pylist()]
            if own:
                held += np.bincount(np.concatenate(own), minlength=size)
        found = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(held[found])], names=["term", "documents"])

    return bags.select("bag").mapInArrow(run, COUNTS).groupBy("term").agg(F.sum("documents").alias("documents"))


def _scored(classes, sent, items, k):
    """The k best classes of each item in a task: item number, score, class and its least key."""

    def run(arrow):
        weights, starts, posted, times = sent.value  # per term: weight and where its items start; items and occurrences
        kept = None
        for batch in arrow:
            rows = batch.to_pydict()
            step = max(1, min(CLASSES, CELLS // max(1, items)))
            for at in range(0, batch.num_rows, step):
                bags = [_unpacked(b) for b in rows["bag"][at : at + step]]
                own = np.repeat(np.arange(len(bags)), [b.shape[1] for b in bags])
                term, tf = np.concatenate(bags, axis=1).astype(np.int64)
                share = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * np.array(rows["m"][at : at + step])[own]))
                # Every entry meets the items of its term.
                meets = starts[term + 1] - starts[term]
                entry = np.repeat(np.arange(len(term)), meets)
                post = np.arange(len(entry)) - np.repeat(np.cumsum(meets) - meets, meets) + starts[term][entry]
                cell = own[entry] * items + posted[post]
                scores = np.bincount(cell, share[entry] * times[post], len(bags) * items)  # whole numbers below 2^53: exact
                least = np.array([_LAST if x is None else x for x in rows["least"][at : at + step]], np.int64)
                kept = _best(kept, scores.astype(np.int64).reshape(-1, items), least, np.array(rows["class"][at : at + step], np.int64), k)
        if kept is not None:
            item, score, least, name = kept
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(score), pa.array(name), pa.array(least)], names=["item", "score", "class", "least"])

    return classes.select("class", "m", "bag", "least").mapInArrow(run, SCORED)


#: Place of a missing key: after all others.
_LAST = 2**63 - 1


def _best(kept, scores, least, names, k):
    """The k best (item, score, least, class) of ``kept`` and of ``scores`` (classes x items) for each item."""
    floor = np.ones(scores.shape[1], np.int64)
    if len(scores) > k:  # the k-th highest score bounds what can enter; ties stay
        floor = np.maximum(floor, np.partition(scores, len(scores) - k, axis=0)[len(scores) - k])
    if kept is not None:
        full = np.bincount(kept[0], minlength=len(floor)) == k
        lowest = np.full(len(floor), _LAST)
        np.minimum.at(lowest, kept[0], kept[1])
        floor = np.maximum(floor, np.where(full, lowest, 1))
    row, item = np.nonzero(scores >= floor)
    fresh = (item, scores[row, item], least[row], names[row])
    item, score, least, names = fresh if kept is None else (np.concatenate(x) for x in zip(kept, fresh))
    order = np.lexsort((names, least, -score, item))
    item, score, least, names = (x[order] for x in (item, score, least, names))
    place = np.arange(len(item)) - np.searchsorted(item, item)
    return tuple(x[place < k] for x in (item, score, least, names))


def search(docs, items, key="doc_id", text="text", item_key="item_id", item_text="text", k=TOP, block=BLOCK):
    """item_id, rank, doc_id, score: the k documents of highest score above 0 for each item; equal scores by ascending doc_id."""
    spark = docs.sparkSession
    wanted = stored(spark, item_terms(items, item_key, item_text), "item-terms")
    blocks = wanted.count() // block + 1
    found = None
    for i in range(blocks):
        own = wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == i) if blocks > 1 else wanted
        part = _search_block(spark, keyed_text(docs, key, text), own.collect(), k)  # about ``block`` rows
        found = part if found is None or part is None else found.unionByName(part)
    return found


def _search_block(spark, docs, rows, k):
    ids = sorted({r["item_id"] for r in rows}, key=lambda x: (x is None, x))
    item_number = {x: i for i, x in enumerate(ids)}
    number = {t: i for i, t in enumerate(sorted({bytes(r["term"]) for r in rows}))}
    posts = sorted((number[bytes(r["term"])], item_number[r["item_id"]], r["times"]) for r in rows)
    term, posted, times = np.array(posts, np.int64).reshape(-1, 3).T
    starts = np.searchsorted(term, np.arange(len(number) + 1))
    bags = stored(spark, _bags(docs, spark.sparkContext.broadcast(number)), "bags")
    total, length = bags.where("n_terms > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    weight = F.floor(1000 * F.log((2 * F.lit(total) + 2) / (2 * F.col("documents") + 1)))
    weights = np.zeros(len(number), np.int64)
    for term, w in _document_counts(bags, len(number)).select("term", weight).collect():  # one row a term of the block
        weights[term] = w
    norm = F.expr(f"100 - 25 + ((25 * n_terms * {total}L) div {max(1, length)}L)")
    hits = bags.where(F.length("bag") > 0).select("doc_id", "bag", norm.alias("m"))
    hits = hits.withColumn("hash", F.xxhash64("m", "bag"))
    # Grouped by hash and by what was hashed: classes are equal in full.
    classes = hits.groupBy("hash", "m", "bag").agg(F.min("doc_id").alias("least"))
    classes = stored(spark, classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    best_first = [F.col("score").desc(), F.col("least").asc(), F.col("class").asc()]
    scored = _scored(classes, spark.sparkContext.broadcast((weights, starts, posted, times)), len(ids), k)
    ranked = scored.withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy(*best_first))).where(F.col("place") <= k)
    winners = stored(spark, ranked.select("item", "score", "class"), "winners", files=8)
    # At most k classes an item: such a list may be sent to every task, their bags are joined.
    named = classes.join(F.broadcast(winners.select("class").distinct()), "class", "left_semi").select("class", "hash", "m", "bag")
    named = stored(spark, named, "named", files=8)
    near = hits.join(F.broadcast(named.select("hash").distinct()), "hash", "left_semi")
    members = near.join(named, ["hash", "m", "bag"]).select("class", "doc_id")
    first = Window.partitionBy("class").orderBy(F.col("doc_id").asc_nulls_last())
    members = members.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k).select("class", "doc_id")
    names = spark.createDataFrame([(i, x) for x, i in item_number.items()], "item int, item_id long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    expanded = winners.join(members, "class").withColumn("rank", rank).where(F.col("rank") <= k)
    return expanded.join(names, "item").select("item_id", "rank", "doc_id", "score")
