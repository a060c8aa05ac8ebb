"""Byte-level BPE by a global shuffle of distinct words.

Documents are taken in blocks of one scan task.  Within a block each pre-token is its position in the block's list of
distinct words; the lists, cut by word hash, are shuffled by word, so that every distinct word meets itself and is
encoded once; the ids go back to their block, where the documents are put together by position.  Only distinct words
and positions travel, never one row per pre-token.

Blocks are computed once for the words and once for the positions, which needs a source that reads back alike (a table
scan does).  Blocks are named by their content, so a source that doesn't is noticed and fails instead of mixing up
documents; pass ``stable=False`` for such inputs and the blocks are stored in between.

Defined cases: a null or empty text has no ids and decodes to no bytes; null and repeated keys stay rows of their own; an
empty table gives no rows.
"""

import base64
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import zstandard
from pyspark.sql import functions as F

from kinora.llm.common import keyed_text, partitions, stored
from kinora.llm.packing import _runs

#: Bytes of text of a block.
BLOCK_CHARS = 4_000_000
#: Pre-tokens of the documents that are put together at once.
DOCUMENT_IDS = 1_000_000
#: Words that one call of the merges gets.
CHUNK = 2_000
#: A space that a run of white space may take in (all white space, and a little more): such texts are matched as a whole.
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SPACE_RUN = rf" {_WHITE}|{_WHITE} \z"
#: Pieces that are one pre-token: Latin letters, and what follows a space at the end of a text.
LETTERS = r"^[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]*$"

POSITIONS = "block string, doc_ids array<long>, counts array<long>, at binary"
WORDS = "block string, bucket int, words binary, lengths binary, at binary"
CODED = "block string, at binary, lengths binary, ids binary"
ENCODED = "doc_id long, n_tokens long, ids binary"


def read_ranks(text):
    """Token bytes -> id from a rank file's lines."""
    return {base64.b64decode(token): int(rank) for token, rank in map(str.split, text.splitlines())}


def _expanded(starts, lengths, chosen):
    """Places of the entries of the ``chosen`` lists, one list after the other."""
    sizes = lengths[chosen]
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - starts[chosen], sizes)


def split_block(texts, pattern):
    """Pre-tokens of an Arrow array of texts: (their number per text, positions in the words, words by falling frequency).

    A space before a non-space always starts a pre-token, so texts are cut there, and each distinct piece of the block is
    matched once: pieces of letters are pre-tokens as they are, the others are matched in one go, where a match that starts
    with a space starts a piece.
    """
    runs = pc.match_substring_regex(texts, SPACE_RUN).to_numpy(zero_copy_only=False)
    cut = np.flatnonzero(~runs)
    split = pc.split_pattern(texts.take(pa.array(cut)), " ")
    bounds = split.offsets.to_numpy().astype(np.int64)
    values, rest = split.flatten(), np.ones(int(bounds[-1]), bool)
    rest[bounds[:-1]] = False
    encoded = values.filter(pa.array(rest)).dictionary_encode()
    chosen, pieces = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary
    # The beginning of a text has no space before it: it is matched by itself, as texts with runs of spaces are.
    heads = values.filter(pa.array(~rest)).to_pylist()
    other = [pattern.findall(text) for text in (*heads, *texts.take(pa.array(np.flatnonzero(runs))).to_pylist())]
    plain = pc.match_substring_regex(pieces, LETTERS).to_numpy(zero_copy_only=False)
    found = pattern.findall("".join([" " + piece for piece in pieces.filter(pa.array(~plain)).to_pylist()]))
    firsts = [i for i, match in enumerate(found) if match[0] == " "]
    # Tokens of all pieces, one list after the other: letters, matched pieces, beginnings and whole texts.
    letters = pc.binary_join_element_wise(pa.scalar(""), pieces.filter(pa.array(plain)), " ")
    tokens = pa.concat_arrays([letters, pa.array(found, pa.string()), pa.array([t for o in other for t in o], pa.string())]).dictionary_encode()
    lengths = np.concatenate([np.ones(len(letters), np.int64), np.diff([*firsts, len(found)]).astype(np.int64), np.array([len(o) for o in other], np.int64)])
    number = np.empty(len(pieces), np.int64)  # piece -> its list
    number[plain], number[~plain] = np.arange(len(letters)), np.arange(len(letters), len(pieces))
    lists = np.empty(len(values), np.int64)
    lists[rest], lists[~rest] = number[chosen], len(pieces) + np.arange(len(heads))
    # Back in the order of the texts.
    wholes = len(pieces) + len(heads) + np.arange(int(runs.sum()))
    sizes = np.ones(len(texts), np.int64)
    sizes[cut] = np.diff(bounds)
    starts = np.cumsum(sizes) - sizes
    ordered = np.empty(int(sizes.sum()), np.int64)
    ordered[np.repeat(starts[cut], sizes[cut]) + np.arange(len(lists)) - np.repeat(bounds[:-1], sizes[cut])] = lists
    ordered[starts[runs]] = wholes
    flat = tokens.indices.to_numpy().astype(np.int64)
    at = flat[_expanded(np.cumsum(lengths) - lengths, lengths, ordered)]
    ends = np.concatenate([[0], np.cumsum(lengths[ordered])])
    counts = ends[starts + sizes] - ends[starts]
    times = np.bincount(at, minlength=len(tokens.dictionary))
    order = np.argsort(-times, kind="stable")[: int((times > 0).sum())]
    place = np.zeros(len(times), "<u4")
    place[order] = np.arange(len(order), dtype="<u4")
    return counts, place[at], tokens.dictionary.take(pa.array(order))


def _blocks(arrow, pattern, block_chars):
    """(name, doc ids, pre-tokens per document, positions, words) of blocks of documents; the same for the same texts."""
    compiled = regex.compile(pattern)
    held, size = [], 0

    def close():
        keys = [k for part in held for k in part.column(0).to_pylist()]
        counts, at, words = split_block(pa.concat_arrays([part.column(1) for part in held]), compiled)
        words = words.cast(pa.binary()).to_pylist()
        name = hashlib.blake2b(repr((keys, counts.tolist())).encode(), digest_size=16)
        name.update(b"\0".join(words))
        return name.hexdigest(), keys, counts, at, words

    for batch in arrow:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = min(batch.num_rows, int(np.searchsorted(ends, done + block_chars - size)) + 1)
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1] - done)
            start = stop
            if size >= block_chars:
                yield close()
                held, size = [], 0
    if held:
        yield close()


class Merger:
    """Ids of distinct words."""

    def __init__(self, ranks, pattern):
        self.merge = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        (self.feed,) = self.merge.encode_ordinary("\n")

    def ids(self, words):
        """{word: ids as bytes}.  Words without white space but a leading blank are merged many at a time, line by line."""
        plain, out = [], {}
        for word in words:
            if word[1:].isalnum() and word[:1] in _PLAIN:
                plain.append(word)
            else:
                out[word] = np.array(self.merge.encode_ordinary(word.decode("utf-8", "surrogatepass")), "<u4").tobytes()
        for i in range(0, len(plain), CHUNK):
            some = plain[i : i + CHUNK]
            ids = np.array(self.merge.encode_ordinary("\n".join([w.decode() for w in some])), "<u4")
            ends = np.append(np.flatnonzero(ids == self.feed), len(ids))
            starts = np.append(0, ends[:-1] + 1)
            raw = ids.tobytes()
            out.update(zip(some, [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]))
        return out


#: First bytes of words that :class:`Merger` puts on lines: a blank or an ASCII letter.
_PLAIN = frozenset(bytes([b]) for b in b" abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def encode(docs, ranks_text, pattern, key="doc_id", text="text", block_chars=BLOCK_CHARS, stable=True):
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit) of each document.

    Each match of ``pattern`` is merged by itself; there are no special tokens.
    """
    return _coded(docs, ranks_text, pattern, key, text, block_chars, stable).mapInArrow(_reassembled, ENCODED)


def round_trip(docs, ranks_text, pattern, key="doc_id", text="text", block_chars=BLOCK_CHARS, stable=True):
    """:func:`encode` and :func:`decode` in one step: doc_id, n_tokens, ids, decoded and written."""
    joined = _joined(docs.sparkSession.sparkContext.broadcast(ranks_text), "ids", True)
    coded = _coded(docs, ranks_text, pattern, key, text, block_chars, stable)
    return coded.mapInArrow(lambda arrow: joined(_reassembled(arrow)), ENCODED + ", decoded binary, written string")


def _coded(docs, ranks_text, pattern, key, text, block_chars, stable):
    """Blocks of documents: their positions, and their words with ids."""
    spark = docs.sparkSession
    buckets = 2 * partitions(spark)
    rows = keyed_text(docs, key, text)
    if not stable:
        rows = stored(spark, rows, "texts")
    ranks = spark.sparkContext.broadcast(ranks_text)  # the vocabulary file: its size doesn't follow the data

    def positions(arrow):
        for name, keys, counts, at, _ in _blocks(arrow, pattern, block_chars):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name]),
                    pa.array([keys], pa.list_(pa.int64())),
                    pa.array([counts], pa.list_(pa.int64())),
                    pa.array([_packed(at)], pa.binary()),
                ],
                names=["block", "doc_ids", "counts", "at"],
            )

    def words(arrow):
        for name, _, _, _, listed in _blocks(arrow, pattern, block_chars):
            bucket = np.fromiter(map(zlib.crc32, listed), np.int64, len(listed)) % buckets
            order = np.argsort(bucket, kind="stable")
            stops = np.cumsum(np.bincount(bucket, minlength=buckets))
            for b, (start, stop) in enumerate(zip([0, *stops[:-1]], stops)):
                if start < stop:
                    own = order[start:stop]
                    part = [listed[i] for i in own]
                    packed = (zstandard.compress(b"".join(part)), _packed(map(len, part)), _packed(np.diff(own, prepend=0)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([b], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)],
                        names=["block", "bucket", "words", "lengths", "at"],
                    )

    def code(arrow):
        merger = Merger(read_ranks(ranks.value), pattern)
        bucket, known = None, {}
        for batch in arrow:
            for own in _runs(batch):
                if own.column(0)[0].as_py() != bucket:
                    bucket, known = own.column(0)[0].as_py(), {}
                for row in own.to_pylist():
                    stops = np.cumsum(_unpacked(row["lengths"])).tolist()
                    joined = zstandard.decompress(row["words"])
                    listed = [joined[a:b] for a, b in zip([0, *stops], stops)]
                    known.update(merger.ids([w for w in listed if w not in known]))
                    ids = [known[w] for w in listed]
                    packed = (row["at"], _packed(len(i) // 4 for i in ids), _packed(np.frombuffer(b"".join(ids), "<u4")))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["block"]]), *(pa.array([x], pa.binary()) for x in packed)],
                        names=["block", "at", "lengths", "ids"],
                    )

    coded = (
        rows.mapInArrow(words, WORDS)
        .repartition(partitions(spark), "bucket")
        .sortWithinPartitions("bucket")
        .select("bucket", "block", "words", "lengths", "at")
        .mapInArrow(code, CODED)
        .groupBy("block")
        .agg(F.collect_list(F.struct("at", "lengths", "ids")).alias("coded"))
    )
    return rows.mapInArrow(positions, POSITIONS).join(coded, "block", "left")


def _reassembled(arrow):
    """Documents of each block: the ids of its words, taken by position."""
    none = np.zeros(0, np.int64)
    for batch in arrow:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in ("doc_ids", "counts", "at", "coded")}
            parts = [(np.cumsum(_unpacked(p["at"])), _unpacked(p["lengths"]), _unpacked(p["ids"])) for p in row["coded"] or []]
            at = _unpacked(row["at"]).astype(np.int64)
            place, lengths, ids = (np.concatenate(x).astype(np.int64) for x in zip(*parts)) if parts else (none, none, none)
            if len(place) < (int(at.max()) + 1 if len(at) else 0):
                raise RuntimeError("the input read back differently; encode it with stable=False")
            starts, sizes = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
            starts[place], sizes[place] = np.cumsum(lengths) - lengths, lengths
            ids, keys, counts, done = ids.astype("<u4"), row["doc_ids"], row["counts"], 0
            while keys:  # about DOCUMENT_IDS ids of whole documents at a time
                some = max(1, int(np.searchsorted(np.cumsum(counts), DOCUMENT_IDS)))
                own = at[done : done + sum(counts[:some])]
                raw = ids[_expanded(starts, sizes, own)].tobytes()
                ends = np.cumsum(np.concatenate([[0], sizes[own]]))[np.cumsum([0, *counts[:some]])] * 4
                yield _documents(keys[:some], [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())])
                keys, counts, done = keys[some:], counts[some:], done + len(own)


def _packed(numbers):
    """Unsigned 32-bit numbers, each byte plane by itself, compressed."""
    planes = (numbers.astype("<u4") if isinstance(numbers, np.ndarray) else np.fromiter(numbers, "<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(packed):
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _documents(keys, ids):
    counts = [len(i) // 4 for i in ids]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"]
    )


def decode(df, ranks_text, ids="ids", written=False):
    """``df`` with ``decoded``: the bytes of its ids, joined from the token-byte table.

    The table has one row per token of the vocabulary whatever the data, so it is a map-side join by token id.  Null
    and empty lists decode to no bytes.  ``written`` adds the ids as decimal numbers joined by one space.
    """
    added = {"decoded": F.lit(b""), **({"written": F.lit("")} if written else {})}
    columns = [c for c in df.columns if c not in added]
    schema = df.select(*columns).withColumns(added).schema
    return df.select(*columns).mapInArrow(_joined(df.sparkSession.sparkContext.broadcast(ranks_text), ids, written), schema)


def _joined(ranks, ids, written):
    names = ["decoded", *(["written"] if written else [])]

    def run(arrow):
        table = {i: token for token, i in read_ranks(ranks.value).items()}
        shown = {i: str(i) for i in table}
        for batch in arrow:
            texts, numbers = [], []
            for i in range(batch.num_rows):
                own = np.frombuffer(batch.column(ids)[i].as_py() or b"", "<u4").tolist()
                texts.append(b"".join(map(table.__getitem__, own)))
                if written:
                    numbers.append(" ".join(map(shown.__getitem__, own)))
            more = [pa.array(texts, pa.binary()), *([pa.array(numbers, pa.string())] if written else [])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *names])

    return run
