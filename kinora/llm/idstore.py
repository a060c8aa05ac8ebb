"""Token ids in binary shards, reached by key through a minimal perfect hash.

A store is a folder:

- ``shard-NNNNNN.bin``: raw ids, little-endian unsigned integers of ``id_bytes`` bytes, documents in ascending key
  order; shards in ascending key order too.
- ``index-NNNNNN.mph``: one per hash part of the keys.  Header of four unsigned 64-bit integers (keys, buckets, id_bytes,
  part), then int32 displacements per bucket, then per slot: fingerprint (u32), shard (u32), offset in ids (u64), ids (u64).
- ``manifest``: Parquet (shard, base, ids, documents, id_bytes); ``base`` counts the ids of all shards before.

Key hash: XXH64 of the key, then of its ordinal among equal keys with the first hash as seed (Spark's ``xxhash64``,
seed 42).  The part is the hash modulo the number of parts; bucket and slot come from mixes of it; the fingerprint from
``xxhash64`` in reverse column order.  A lookup reads one displacement and one slot, and a slot whose fingerprint
differs means that the key is absent (false answers: 2^-32 of the absent keys).

Defined cases: a null text is empty; null keys come first and are stored under the key -2^63; equal keys are ordered by
text and told apart by their ordinal; an empty table gives a store without documents.
"""

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Window
from pyspark.sql import functions as F

from kinora.llm.common import LEAST_LONG, keyed_text, once_per_worker, partitions, range_buckets
from kinora.llm.packing import _runs
from kinora.llm.wordbpe import WordEncoder, batches

END_ID = 1
KEYS_PER_PART = 65_536
KEYS_PER_BUCKET = 2
TRIES = 256

ENTRY = "key long, ordinal long, shard int, offset long, n_tokens long"
_ENTRY = pa.schema([("key", pa.int64()), ("ordinal", pa.int64()), ("shard", pa.int32()), ("offset", pa.int64()), ("n_tokens", pa.int64())])
_FOUND = pa.schema([("key", pa.int64()), ("ordinal", pa.int64()), ("shard", pa.int32()), ("offset", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("ids", "<u8")])


def _open(path):
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Replacing:
    """Writes beside the target and moves over it at the end: a repeated task leaves one whole file."""

    def __init__(self, path):
        self.files, self.path = _open(path)
        self.beside = f"{self.path}.{uuid.uuid4().hex}.part"

    def __enter__(self):
        self.out = self.files.open_output_stream(self.beside)
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if kind is None:
            self.files.move(self.beside, self.path)
        else:
            self.files.delete_file(self.beside)


def mix(h):
    """64-bit finaliser on an array of unsigned integers."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _slots(hashes, displacement, count):
    return (mix(hashes + displacement * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(count)).astype(np.int64)


def build_mph(hashes):
    """Displacements and the slot of each hash (distinct unsigned 64-bit): a bijection onto 0..n-1.

    Buckets are placed largest first, each with the first displacement that finds free slots for all its keys; a
    bucket of one key takes a free slot directly, noted as a negative displacement.
    """
    count = len(hashes)
    buckets = max(1, -(-count // KEYS_PER_BUCKET))
    home = (mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    sizes = np.bincount(home, minlength=buckets)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    displacements, slots = np.zeros(buckets, np.int32), np.zeros(count, np.int64)
    free = np.ones(count, bool)
    by_size = np.argsort(-sizes, kind="stable")
    for bucket in by_size[: np.count_nonzero(sizes > 1)]:
        own = order[starts[bucket] : starts[bucket + 1]]
        first = 0
        while True:
            tries = np.arange(first, first + TRIES, dtype=np.uint64)
            at = _slots(hashes[own][:, None], tries[None, :], count)
            good = free[at].all(axis=0)
            ranked = np.sort(at, axis=0)
            good &= (ranked[1:] != ranked[:-1]).all(axis=0)
            if good.any():
                hit = int(np.argmax(good))
                displacements[bucket], slots[own] = first + hit, at[:, hit]
                free[at[:, hit]] = False
                break
            first += TRIES
    alone = by_size[np.count_nonzero(sizes > 1) : np.count_nonzero(sizes > 0)]
    left = np.flatnonzero(free)
    displacements[alone] = -left - 1
    slots[order[starts[alone]]] = left
    return displacements, slots


def find(hashes, displacements, count):
    """The slot of each hash (any slot for hashes that were not among the keys)."""
    home = (mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(len(displacements))).astype(np.int64)
    d = displacements[home].astype(np.int64)
    return np.where(d < 0, -d - 1, _slots(hashes, np.maximum(d, 0).astype(np.uint64), count))


def _hashed(keys, parts):
    """Key rows with hash, fingerprint and part."""
    hashed = F.xxhash64("key", "ordinal")
    return keys.withColumns(
        {
            "hash": hashed,
            "fingerprint": F.xxhash64("ordinal", "key").bitwiseAND(F.lit(0xFFFFFFFF)),
            "part": F.pmod(hashed, F.lit(parts)).cast("int"),
        }
    )


def write(docs, path, tokenizer_json, key="doc_id", text="text", shards=None):
    """Encode, append ``END_ID`` to each document, write the store; returns the number of index parts."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(tokenizer_json)
    # A worker that encoded with another tokenizer before must not keep its encoder.
    version = hashlib.sha256(tokenizer_json.encode("utf-8")).hexdigest()
    rows = keyed_text(docs, key, text).withColumn("key", F.coalesce("doc_id", F.lit(LEAST_LONG)))
    shards = shards or 4 * partitions(spark)
    dealt = (
        range_buckets(rows, "key", shards)
        .repartition(partitions(spark), "bucket")
        .sortWithinPartitions("bucket", "key", "text")
        .select("bucket", "key", "text")
    )
    place = path
    files, local = _open(place)
    files.create_dir(local, recursive=True)
    with np.errstate(over="ignore"):
        wide = "<u2" if _vocabulary(tokenizer_json) <= 1 << 16 else "<u4"

    def save(arrow):
        encoder = once_per_worker("word encoder", lambda: WordEncoder(model.value), version)
        end = END_ID.to_bytes(4, "little")
        shard, out, offset, last, ordinal = None, None, 0, None, 0
        try:
            for batch in arrow:
                for own in _runs(batch):
                    if own.column(0)[0].as_py() != shard:
                        if out:
                            out.__exit__(None)
                        shard, offset, last = own.column(0)[0].as_py(), 0, None
                        out = _Replacing(f"{place}/shard-{shard:06d}.bin")
                        out.__enter__()
                    keys, entries = iter(own.column(1).to_pylist()), []
                    for texts in batches(own.column(2)):
                        for ids in encoder.payloads(texts):
                            k, ids = next(keys), ids + end
                            ordinal = ordinal + 1 if k == last else 0
                            last, n = k, len(ids) // 4
                            out.out.write(np.frombuffer(ids, "<u4").astype(wide).tobytes())
                            entries.append((k, ordinal, shard, offset, n))
                            offset += n
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*entries), _ENTRY)], schema=_ENTRY)
            if out:
                out.__exit__(None)
        except BaseException as failed:
            if out:
                out.__exit__(type(failed))
            raise

    dealt.mapInArrow(save, ENTRY).write.parquet(f"{path}/entries")
    entries = spark.read.schema(ENTRY).parquet(f"{path}/entries")
    sums = entries.groupBy("shard").agg(F.sum("n_tokens").alias("ids"), F.count(F.lit(1)).alias("documents"))
    # One row per shard; the running total needs them in order.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    id_bytes = np.dtype(wide).itemsize
    based = sums.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    based.withColumn("id_bytes", F.lit(id_bytes)).write.parquet(f"{path}/manifest")
    parts = max(partitions(spark), -(-entries.count() // KEYS_PER_PART))

    def index(arrow):
        def flush(part, columns):
            with np.errstate(over="ignore"):
                hashes, fingerprint, shard, offset, ids = (np.concatenate(c) for c in zip(*columns))
                displacements, slots = build_mph(hashes.astype(np.int64).view(np.uint64))
            table = np.zeros(len(hashes), SLOT)
            for name, values in (("fingerprint", fingerprint), ("shard", shard), ("offset", offset), ("ids", ids)):
                table[name][slots] = values
            with _Replacing(f"{place}/index-{part:06d}.mph") as out:
                out.write(np.array([len(hashes), len(displacements), id_bytes, part], "<u8").tobytes())
                out.write(displacements.astype("<i4").tobytes())
                out.write(table.tobytes())
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(hashes)], pa.int64())], names=["part", "keys"])

        part, columns = None, []
        for batch in arrow:
            for own in _runs(batch):
                if own.column(0)[0].as_py() != part:
                    if columns:
                        yield flush(part, columns)
                    part, columns = own.column(0)[0].as_py(), []
                columns.append([own.column(i).to_numpy(zero_copy_only=False) for i in range(1, 6)])
        if columns:
            yield flush(part, columns)

    (
        _hashed(entries, parts)
        .repartition(partitions(spark), "part")
        .sortWithinPartitions("part")
        .select("part", "hash", "fingerprint", "shard", "offset", "n_tokens")
        .mapInArrow(index, "part int, keys long")
        .write.parquet(f"{path}/parts")
    )
    return parts


def _vocabulary(tokenizer_json):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(tokenizer_json).get_vocab_size()


def lookup(spark, path, keys, parts):
    """Where each key lies: ``keys`` (key, ordinal) with shard, offset and n_tokens; keys not found are left out."""

    def located(arrow):
        part, count, displacements, table = None, 0, None, None
        for batch in arrow:
            for own in _runs(batch):
                if own.column(0)[0].as_py() != part:
                    part = own.column(0)[0].as_py()
                    files, local = _open(f"{path}/index-{part:06d}.mph")
                    if files.get_file_info(local).type == fs.FileType.NotFound:
                        count = 0
                    else:
                        with files.open_input_stream(local) as source:
                            count, buckets, _, _ = (int(x) for x in np.frombuffer(source.read(32), "<u8"))
                            displacements = np.frombuffer(source.read(4 * buckets), "<i4")
                            table = np.frombuffer(source.read(SLOT.itemsize * count), SLOT)
                if not count:
                    continue
                with np.errstate(over="ignore"):
                    hashes = own.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                    slot = table[find(hashes, displacements, count)]
                hit = slot["fingerprint"] == own.column(2).to_numpy(zero_copy_only=False)
                columns = [own.column(i).to_numpy(zero_copy_only=False)[hit] for i in (3, 4)]
                columns += [slot[name][hit].astype(np.int64) for name in ("shard", "offset", "ids")]
                yield pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, _ENTRY)], schema=_ENTRY)

    return (
        _hashed(keys.select("key", "ordinal"), parts)
        .repartition(partitions(spark), "part")
        .sortWithinPartitions("part")
        .select("part", "hash", "fingerprint", "key", "ordinal")
        .mapInArrow(located, ENTRY)
    )


def fetch(spark, path, located):
    """Payloads of located keys, with ``ids`` as little-endian unsigned 32-bit integers; one pass over each shard."""
    about = spark.read.parquet(f"{path}/manifest").select("id_bytes").first()
    id_bytes = about["id_bytes"] if about else 0

    def read(arrow):
        shard, source = None, None
        for batch in arrow:
            for own in _runs(batch):
                if own.column(0)[0].as_py() != shard:
                    if source:
                        source.close()
                    shard = own.column(0)[0].as_py()
                    files, local = _open(f"{path}/shard-{shard:06d}.bin")
                    source = files.open_input_file(local)
                rows, ids = own.to_pydict(), []
                for offset, n in zip(rows["offset"], rows["n_tokens"]):
                    raw = source.read_at(n * id_bytes, offset * id_bytes)
                    ids.append(np.frombuffer(raw, f"<u{id_bytes}").astype("<u4").tobytes())
                columns = [own.column(name) for name in ("key", "ordinal", "shard", "offset", "n_tokens")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary())], schema=_FOUND)
        if source:
            source.close()

    return (
        located.repartition(partitions(spark), "shard")
        .sortWithinPartitions("shard", "offset")
        .select("shard", "key", "ordinal", "offset", "n_tokens")
        .mapInArrow(read, ENTRY + ", ids binary")
    )


def contents(spark, path, docs, parts, key="doc_id"):
    """The stored document of every row of ``docs``, by keyed access: doc_id, ordinal, start, n_tokens, ids."""
    keys = (
        docs.groupBy(F.coalesce(F.col(key).cast("long"), F.lit(LEAST_LONG)).alias("key"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("ordinal"))
    )
    found = fetch(spark, path, lookup(spark, path, keys, parts))
    base = spark.read.parquet(f"{path}/manifest").select("shard", "base")
    return found.join(base, "shard").select(
        F.when(F.col("key") != LEAST_LONG, F.col("key")).alias("doc_id"),
        "ordinal",
        (F.col("base") + F.col("offset")).alias("start"),
        "n_tokens",
        "ids",
    )
