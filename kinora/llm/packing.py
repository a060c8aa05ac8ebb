"""Bounded-space online packing of token ids into sequences.

Each partition keeps at most ``open_windows`` unfinished sequences.  A document's whole sequences are cut off first;
its rest goes into the open window that it fills best.  If none has room and all are open, the fullest is emitted:
topped up by cutting the piece when its gap is at least ``least_cut`` ids, padded otherwise.  What is still open at the
end of a partition is merged, ``fan_in`` partitions a task, until one task is left; it pours its open windows together.

Defined cases: a null or empty text is one end id; a null key stays null; repeated rows are packed as rows of their own
(their pieces have the same key); an empty table gives no rows.
"""

import bisect
import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from kinora.llm.common import keyed_text, once_per_worker, stored
from kinora.llm.wordbpe import WordEncoder, batches

WINDOW = 2048
OPEN_WINDOWS = 32
LEAST_CUT = 64
FAN_IN = 32
END_ID = 1

PIECE = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary, "
    "final boolean, source long"
)
_ARROW = pa.schema(
    [
        *((name, pa.int64()) for name in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")),
        ("ids", pa.binary()),
        ("final", pa.bool_()),
        ("source", pa.int64()),
    ]
)


class Packer:
    """Places pieces (doc_id, start, ids, doc_tokens); ``done`` collects (sequence, offset, piece) of emitted windows."""

    def __init__(self, window=WINDOW, open_windows=OPEN_WINDOWS, least_cut=LEAST_CUT):
        self.window, self.most, self.least_cut = window, open_windows, least_cut
        self.gaps = []  # (gap, sequence), sorted: best fit by bisection
        self.held = {}  # sequence -> its pieces
        self.next, self.done = 0, []

    def add(self, doc_id, start, ids, doc_tokens):
        """ids: 4 bytes each."""
        at, count = 0, len(ids) // 4
        while count - at >= self.window:
            self.done.append((self._new(), 0, (doc_id, start + at, ids[4 * at : 4 * (at + self.window)], doc_tokens)))
            at += self.window
        while at < count:
            best = bisect.bisect_left(self.gaps, (count - at, -1))
            if best < len(self.gaps):
                gap, sequence = self.gaps.pop(best)
                take = count - at
            elif len(self.held) < self.most:
                gap, sequence, take = self.window, self._new(), count - at
                self.held[sequence] = []
            else:
                gap, sequence = self.gaps.pop(0)
                take = gap if gap >= self.least_cut else 0
            if take:
                self.held[sequence].append((self.window - gap, (doc_id, start + at, ids[4 * at : 4 * (at + take)], doc_tokens)))
                at += take
            if gap == take or not take:
                self._emit(sequence)
            else:
                bisect.insort(self.gaps, (gap - take, sequence))

    def open_pieces(self):
        """(sequence, offset, piece) of the windows still open."""
        return [(s, offset, piece) for s, pieces in self.held.items() for offset, piece in pieces]

    def pour(self):
        """Fill the open windows' pieces, cut where needed, into as few sequences as they take."""
        sequence, offset = None, self.window
        for _, _, (doc_id, start, ids, doc_tokens) in self.open_pieces():
            at, count = 0, len(ids) // 4
            while at < count:
                if offset == self.window:
                    sequence, offset = self._new(), 0
                take = min(count - at, self.window - offset)
                self.done.append((sequence, offset, (doc_id, start + at, ids[4 * at : 4 * (at + take)], doc_tokens)))
                at, offset = at + take, offset + take
        self.held, self.gaps = {}, []

    def _new(self):
        self.next += 1
        return self.next - 1

    def _emit(self, sequence):
        self.done += [(sequence, offset, piece) for offset, piece in self.held.pop(sequence)]


def _rows(placed, final, base, source):
    columns = list(zip(*((d, start, len(ids) // 4, n, base + s, o, ids) for s, o, (d, start, ids, n) in placed)))
    columns += [[final] * len(placed), [source] * len(placed)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _packed(packer, pieces, base, source, last=False):
    """Arrow batches of what ``pieces`` (an iterator of lists) fill, then of what stays open."""
    for some in pieces:
        for piece in some:
            packer.add(*piece)
        if packer.done:
            yield _rows(packer.done, True, base, source)
            packer.done = []
    if last:
        packer.pour()
    if packer.done:
        yield _rows(packer.done, True, base, source)
    if rest := packer.open_pieces():
        yield _rows(rest, False, base, source)


def pack(docs, tokenizer_json, key="doc_id", text="text", window=WINDOW, open_windows=OPEN_WINDOWS, least_cut=LEAST_CUT, fan_in=FAN_IN):
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit).

    A document is its text's ids and ``END_ID``.  Sequence ids are unique, not gapless: merge round, task, counter.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(tokenizer_json)
    # A worker that encoded with another tokenizer before must not keep its encoder.
    version = hashlib.sha256(tokenizer_json.encode("utf-8")).hexdigest()

    def first(arrow):
        encoder = once_per_worker("word encoder", lambda: WordEncoder(model.value), version)
        task = TaskContext.get().partitionId()

        def pieces():
            for batch in arrow:
                keys = iter(batch.column(0).to_pylist())
                for texts in batches(batch.column(1)):
                    yield [
                        (next(keys), 0, ids, len(ids) // 4)
                        for ids in (p + END_ID.to_bytes(4, "little") for p in encoder.payloads(texts))
                    ]

        yield from _packed(Packer(window, open_windows, least_cut), pieces(), task << 32, task)

    placed = stored(spark, keyed_text(docs, key, text).mapInArrow(first, PIECE), "packed")
    parts, level = [placed.where("final")], 0
    rest = placed.where("not final")
    groups = (rest.agg(F.max("source")).first()[0] or 0) // fan_in + 1
    while True:
        level, last = level + 1, groups == 1

        def merge(arrow, level=level, last=last):
            def pieces(source):
                for batch in batches_of[source]:
                    rows = batch.to_pydict()
                    yield list(zip(rows["doc_id"], rows["start"], rows["ids"], rows["doc_tokens"]))

            # Rows arrive sorted by group; each group has a packer of its own.
            source, batches_of = None, {}
            for batch in arrow:
                for own in _runs(batch):
                    if own.column(0)[0].as_py() != source:
                        if source is not None:
                            yield from _packed(Packer(window, open_windows, least_cut), pieces(source), level << 56 | source << 32, source, last)
                        source = own.column(0)[0].as_py()
                        batches_of = {source: []}
                    batches_of[source].append(own)
            if source is not None:
                yield from _packed(Packer(window, open_windows, least_cut), pieces(source), level << 56 | source << 32, source, last)

        dealt = (
            rest.withColumn("group", F.floor(F.col("source") / fan_in))
            .repartition(groups, "group")
            .sortWithinPartitions("group", "sequence_id", "offset")
            .select("group", "doc_id", "start", "ids", "doc_tokens")
        )
        merged = stored(spark, dealt.mapInArrow(merge, PIECE), "merged")
        parts.append(merged.where("final"))
        if last:
            break
        rest, groups = merged.where("not final"), (groups - 1) // fan_in + 1
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.drop("final", "source")


def _runs(batch):
    """Slices of a batch that is sorted by its first column, one per value."""
    values, start = batch.column(0).to_pylist(), 0
    for i in range(1, len(values) + 1):
        if i == len(values) or values[i] != values[start]:
            yield batch.slice(start, i - start)
            start = i
