"""Periodic runs of words by an online sparse diagonal DP.

A run is a stretch of consecutive words whose smallest period is q, of at least ``max(LEAST, REPEATS * q)`` words, that no
neighbouring word extends.  On the diagonal of lag q it is a streak of words equal to the word q places before.

The text is read word by word.  Each word looks up its earlier occurrence and lengthens the match on that occurrence's
lag; a diagonal that isn't lengthened ends, and if its match is long enough its run is emitted at once.  Two things
keep the active diagonals few without losing any run:

- A word counts together with the words before it, so that chance repeats open no diagonal.  Lags fall into classes, and in
  the class of lags ``low .. high`` (high at most 1.5 low) a word's context is ``3 low`` words, which every run of such a
  lag matches and which is at least ``2 high - 1``.
- For a context that long, the nearest earlier occurrence is enough: were it nearer than the smallest period q, the context
  would have both as periods, hence their greatest common divisor, and so would the run.  So a class has one active
  diagonal at a time, and a text of one word repeated costs as much as any other.

A text of n words takes O(n log n) steps and memory in proportion to its own length; texts don't meet, so nothing is
shuffled.

Defined cases: no words (null, empty, white space): no runs, an empty collapsed text; null and repeated keys stay rows of
their own; an empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kinora.llm.common import keyed_text

LEAST, REPEATS = 6, 4
#: Words of the shortest context: a run's match has at least as many words.
SHORTEST = LEAST - 1
#: Words looked through at a time for contexts that repeat.
WORDS_AT_ONCE = 2_000_000

FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def lag_classes(words):
    """(low, high, context) of each class of lags that a text of so many words can hold a run of."""
    low = 1
    while max(LEAST, REPEATS * low) <= words:
        high = (3 * low + 1) // 2
        yield low, high, max(SHORTEST, (REPEATS - 1) * low)
        low = high + 1


class Contexts:
    """Names of the contexts (words up to a place) of any length, equal exactly for equal contexts."""

    def __init__(self, codes):
        self.named = {1: np.unique(codes, return_inverse=True)[1]}

    def _doubled(self, length):
        """Names of the windows of ``length`` (a power of two) words, by their first word."""
        if length not in self.named:
            half = self._doubled(length // 2)
            rows = len(half) - length // 2
            pairs = half[:rows] * (int(half.max()) + 1) + half[length // 2 :]
            self.named[length] = np.unique(pairs, return_inverse=True)[1]
        return self.named[length]

    def windows(self, length):
        """Names of all windows of ``length`` words, by their first word."""
        power = 1 << (length.bit_length() - 1)
        part = self._doubled(power)
        if power == length:
            return part
        rows = len(self.named[1]) - length + 1
        return part[:rows] * (int(part.max()) + 1) + part[length - power : length - power + rows]


def earlier_occurrences(names):
    """For each place the nearest earlier place of the same name, -1 if there is none."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    earlier = np.full(len(names), -1, np.int64)
    earlier[order[1:][same]] = order[:-1][same]
    return earlier


class Diagonals:
    """The active diagonal of a lag class, fed word by word."""

    def __init__(self, context, emit):
        self.context, self.emit = context, emit
        self.lag, self.last, self.match = 0, -2, 0

    def meet(self, at, lag):
        """Word ``at`` matches on ``lag`` with its whole context."""
        if lag == self.lag and at == self.last + 1:
            self.match += 1
        else:
            self.end()
            self.lag, self.match = lag, self.context
        self.last = at

    def end(self):
        """The diagonal isn't lengthened: a long enough match is a run."""
        if self.lag and self.match + self.lag >= max(LEAST, REPEATS * self.lag):
            self.emit((self.last + 1 - self.match - self.lag, self.match + self.lag, self.lag))
        self.lag = 0


def runs(codes):
    """(start, length, period) of all runs of a text given as word codes, by start, then period."""
    found, contexts = [], Contexts(codes)
    for low, high, context in lag_classes(len(codes)):
        earlier = earlier_occurrences(contexts.windows(context))
        lags = np.arange(len(earlier)) - earlier
        repeated = np.flatnonzero(earlier >= 0)
        if not len(repeated):
            break  # longer contexts don't repeat either
        repeated = repeated[(lags[repeated] >= low) & (lags[repeated] <= high)]
        diagonals = Diagonals(context, found.append)
        for at, lag in zip((repeated + context - 1).tolist(), lags[repeated].tolist()):
            diagonals.meet(at, lag)
        diagonals.end()
    return sorted(found)


def _may_repeat(codes, bounds):
    """Texts (bounds: their first words, and the end) in which a shortest context repeats, by hashes: a few too many at most."""
    rows = len(codes) - SHORTEST + 1
    if rows < 2:
        return np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    with np.errstate(over="ignore"):
        names = text[:rows].astype(np.uint64)
        for i in range(SHORTEST):
            names = (names ^ codes[i : i + rows]) * np.uint64(0x9E3779B97F4A7C15)
            names ^= names >> np.uint64(29)
    own = np.flatnonzero(text[:rows] == text[SHORTEST - 1 :])
    names = names[own]
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    first, second = text[own[order[:-1][same]]], text[own[order[1:][same]]]
    return np.unique(second[first == second])


def dropped(found, words):
    """Flags of the words that a run contains after its first period."""
    flags = np.zeros(words, bool)
    for start, length, period in found:
        flags[start + period : start + length] = True
    return flags


class _Numbers(dict):
    """Word -> its number in order of appearance."""

    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def find(docs, key="doc_id", text="text", edit=None):
    """doc_id, n_words, runs (by start, then period) and the collapsed text: what no run repeats, joined by one space.

    Words are separated by ASCII white space.  ``edit``, if given, maps (key, words as bytes) to the words to search.
    """

    def searched(keys, texts):
        words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        if edit:
            words = [edit(k, w) for k, w in zip(keys, words)]
        counts = np.array([len(w) for w in words], np.int64)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        known = _Numbers().__getitem__
        codes = np.fromiter((known(x) for w in words for x in w), np.uint64, int(bounds[-1]))
        out = [[] for _ in words]
        for i in _may_repeat(codes, bounds).tolist():
            out[i] = runs(codes[bounds[i] : bounds[i + 1]])
            if out[i]:
                words[i] = [w for w, drop in zip(words[i], dropped(out[i], len(words[i])).tolist()) if not drop]
        rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in out]
        shown = [b" ".join(w).decode("utf-8", "surrogatepass") for w in words]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(counts), pa.array(rows, pa.list_(_RUN)), pa.array(shown, pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )

    def run(arrow):
        for batch in arrow:
            keys, texts, chars = [], [], 0
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(k)
                texts.append(t.as_py())
                chars += len(texts[-1])
                if chars >= 3 * WORDS_AT_ONCE:
                    yield searched(keys, texts)
                    keys, texts, chars = [], [], 0
            if keys:
                yield searched(keys, texts)

    return keyed_text(docs, key, text).mapInArrow(run, FOUND)


def strongest(runs="runs"):
    """Column: the run of greatest length / period, compared exactly; ties: smallest start, then period.  Null without runs."""

    def better(a, b):
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        later = (a["start"] > b["start"]) | ((a["start"] == b["start"]) & (a["period"] > b["period"]))
        return F.when((left < right) | ((left == right) & later), b).otherwise(a)

    first = F.get(F.col(runs), F.lit(0))
    return F.aggregate(F.col(runs), first, better)


def written(runs="runs"):
    """Column: every run as ``start,length,period`` and a line feed."""
    return F.array_join(F.transform(F.col(runs), lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
