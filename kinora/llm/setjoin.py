"""Jaccard join of word n-gram sets: light sets by subsets, heavy sets by inverted lists; exact.

1. A document is its set of distinct shingles.  Equal sets are one node, so copies cost nothing below.
2. Light nodes (few shingles) list all subsets as large as an overlap that a link needs; sharing one is a link.  All
   partners in a list link to its smallest node or to none, so a list gives a star.
3. Heavy nodes are found by inverted lists.  A list on a single shingle is as long as the shingle is frequent, so the lists are
   kept on blocks: a size class cuts the universe of shingles into more blocks than two linked sets can differ in, hence
   they agree in a whole block.  Light nodes near the boundary enter the lists too.
4. Within a list, parity bitmaps bound the difference of two sets from below; only pairs that may link remain, and only as
   many as connect what they may connect (at most one per node).  These are compared by their texts.
5. Components of the links found; then the pairs that still may link two components are compared, all of them.

The boundary between light and heavy is where the rows of both ways, weighted by what they cost, are fewest.

No pair is lost: a pair in no list differs in every block, a pair dropped in a list differs too much by its bitmaps, and
what is not compared lies within one component.  Lists longer than ``CHUNK`` are cut into cells of two chunks.

Defined cases: no words (null, empty text): an empty set, linked with nothing; fewer words than a shingle: the whole sequence
is the one shingle; a null key has no component; a key on several texts has the smallest component of any row of its own
text; an empty table gives no rows.
"""

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import functions as F

from kinora.llm.common import Recent, keyed_text, once_per_worker, partitions, stored
from kinora.llm.components import components
from kinora.llm.idstore import mix
from kinora.llm.packing import _runs

WORDS, SHARE = 5, (80, 100)
CHUNK = 8192
RUN_AT_ONCE = 65_536
MOST_LIGHT, MOST_SUBSETS = 24, 500
#: What a row of an inverted list costs against a subset row: its list is compared, its pairs are verified.
LIST_COST = 4
CLASS_GROWTH = 1.5
BITS_APART = 4
FILTER_BITS = 1 << 24
MAX_CACHED_WORDS = 200_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class Sets:
    """Shingle sets of texts as sorted distinct 64-bit hashes."""

    def __init__(self, words):
        self.size, self.known = words, Recent(xxhash.xxh64_intdigest, MAX_CACHED_WORDS)

    def __call__(self, text):
        words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
        if not words:
            return np.zeros(0, np.uint64)
        self.known.trim()
        codes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(codes))
        hashes = np.full(len(codes) - size + 1, size, np.uint64)
        for i in range(size):
            hashes = mix(hashes * np.uint64(0x100000001B3) + codes[i : len(codes) - size + 1 + i])
        return np.unique(hashes)


def digest(hashes):
    """64-bit name of a set: equal for equal sets."""
    return int((mix(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(hashes))).astype(np.int64))


class Scheme:
    """Size classes, blocks and subsets for linking at ``num / den``."""

    def __init__(self, share):
        self.num, self.den = share

    def size_class(self, n):
        i = max(0, math.ceil(math.log(n, CLASS_GROWTH)) - 1)
        while self.top(i) < n:
            i += 1
        return i

    def top(self, i):
        return math.ceil(CLASS_GROWTH ** (i + 1))

    def apart(self, total):
        """Most elements in which two linked sets of that total size differ."""
        return total * (self.den - self.num) // (self.den + self.num)

    def classes(self, n):
        """The set's own class and those of larger partners."""
        return range(self.size_class(n), self.size_class(max(n, n * self.den // self.num)) + 1)

    def blocks(self, i):
        """Number of blocks of a class, and how many of them a set may leave out of its lists.

        Two linked sets differ in all but more than that many blocks at most.
        """
        least = self.apart(2 * self.top(i)) + 1
        spare = least // 6 + 2
        return least + spare, spare

    def bits(self, i):
        """Bits of a class's bitmap: a few per element in which linked sets may differ, so unrelated sets stand out."""
        return 1 << max(6, (BITS_APART * (self.apart(2 * self.top(i)) + 1) - 1).bit_length())

    def list_keys(self, hashes):
        """Signed 64-bit keys of the inverted lists that a heavy set (or one near the boundary) is in."""
        keys = []
        for i in self.classes(len(hashes)):
            count, spare = self.blocks(i)
            block = (mix(hashes ^ np.uint64(i + 1)) % np.uint64(count)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            starts = np.flatnonzero(np.diff(block[order], prepend=-1))
            content = np.zeros(count, np.uint64)
            content[block[order][starts]] = np.add.reduceat(mix(hashes[order]), starts)
            names = mix(content ^ mix(np.arange(count, dtype=np.uint64) + np.uint64(i << 32)))
            # The blocks with the fewest shingles say least and make the longest lists: a set leaves out those below a size, as
            # long as they are no more than ``spare``.  Two linked sets agree in more blocks than that, so one of these is as
            # large as the sizes of both and stands in the lists of both.
            sizes = np.bincount(block, minlength=count)
            keys.append(names[sizes >= np.partition(sizes, spare)[spare]])
        return np.concatenate(keys).astype(np.int64)

    def bitmap(self, hashes):
        """Parity of the hashes per bit; a shorter bitmap is the exclusive or of its halves."""
        bits = self.bits(self.classes(len(hashes))[-1])
        odd = np.bincount((mix(hashes) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
        return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()

    def subsets(self, hashes):
        """(size, signed key) of every subset as large as an overlap that some link needs."""
        parts, n = mix(hashes), len(hashes)
        total = parts.sum(dtype=np.uint64)
        out = []
        for c in range(-(-self.num * n // self.den), n + 1):
            for left in itertools.combinations(range(n), n - c):
                out.append((c, int(mix(total - parts[list(left)].sum(dtype=np.uint64) + np.uint64(c)).astype(np.int64))))
        return out

    def most_light(self):
        """Largest set whose subsets are worth listing at all."""
        return max(n for n in range(1, MOST_LIGHT + 1) if self.cost(n, True) <= MOST_SUBSETS)

    def cost(self, n, light):
        if light:
            return sum(math.comb(n, k) for k in range(n - -(-self.num * n // self.den) + 1))
        return LIST_COST * sum(self.blocks(i)[0] for i in self.classes(n))


def choose_boundary(sizes, scheme):
    """Largest light size, given {size: sets} of the sizes up to ``most_light``."""
    return min(
        range(scheme.most_light() + 1),
        key=lambda x: (sum(count * scheme.cost(n, n <= x) for n, count in sizes.items()), x),
    )


def _columns(batch, kinds, rows):
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds.values())], names=list(kinds))


def _mapped(spark, df, fn, schema):
    """``mapInArrow`` with wrap-around arithmetic allowed."""

    def run(arrow):
        with np.errstate(over="ignore"):
            yield from fn(arrow)

    return df.mapInArrow(run, schema)


def _keyed(rows, words, scheme, most_light):
    """One row per document: doc_id, n_shingles, node, and what the node's lists, subsets and bitmap are.

    String columns of ``rows`` after key and text are passed on.
    """
    more = rows.columns[2:]
    subset = pa.list_(pa.struct([("size", pa.int32()), ("key", pa.int64())]))
    kinds = {"doc_id": pa.int64(), "n_shingles": pa.int64(), "node": pa.int64(), "lists": pa.list_(pa.int64()), "subsets": subset, "bitmap": pa.binary()}

    def run(arrow):
        sets = once_per_worker(f"sets {words}", lambda: Sets(words))
        for batch in arrow:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = sets(text)
                if not len(h):
                    out.append((doc_id, 0, None, None, None, None))
                    continue
                subsets = [{"size": c, "key": k} for c, k in scheme.subsets(h)] if len(h) <= most_light else None
                out.append((doc_id, len(h), digest(h), scheme.list_keys(h), subsets, scheme.bitmap(h)))
            found = _columns(batch, kinds, zip(*out) if out else [[] for _ in kinds])
            yield pa.RecordBatch.from_arrays([*found.columns, *batch.columns[2:]], names=[*kinds, *more])

    schema = "doc_id long, n_shingles long, node long, lists array<long>, subsets array<struct<size:int,key:long>>, bitmap binary"
    schema += "".join(f", {name} string" for name in more)
    return _mapped(rows.sparkSession, rows, run, schema)


def _listed(keys):
    """Lists of two nodes as pairs (a, b), longer ones as rows (list, a); ``keys`` is sorted by key and node.

    A list is named by its members, so that lists of equal members become one.
    """
    kinds = {"list": pa.int64(), "a": pa.int64(), "b": pa.int64()}

    def runs(key, node):
        starts = np.flatnonzero(np.diff(key, prepend=key[0] - 1 if len(key) else 0))
        lengths = np.diff(starts, append=len(key))
        two = starts[lengths == 2]
        pairs = np.unique(np.stack([node[two], node[two + 1]], axis=1), axis=0) if len(two) else np.zeros((0, 2), np.int64)
        long = lengths > 2
        names = np.add.reduceat(mix(node.view(np.uint64)), starts)[long].astype(np.int64) if long.any() else np.zeros(0, np.int64)
        member = np.repeat(long, lengths)
        lists = np.repeat(names, lengths[long])
        yield _columns(None, kinds, [[None] * len(pairs), pairs[:, 0], pairs[:, 1]])
        yield _columns(None, kinds, [lists, node[member], [None] * len(lists)])

    def run(arrow):
        key, node, huge = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in arrow:
            key = np.concatenate([key, batch.column(0).to_numpy(zero_copy_only=False)])
            node = np.concatenate([node, batch.column(1).to_numpy(zero_copy_only=False)])
            if huge is not None:  # the rest of a list that was too long to hold
                more = np.searchsorted(key != huge, True) if (key != huge).any() else len(key)
                yield _columns(None, kinds, [np.full(more, huge), node[:more], [None] * more])
                key, node, huge = key[more:], node[more:], huge if more == len(key) else None
            last = np.searchsorted(key, key[-1]) if len(key) else 0
            if last:
                yield from runs(key[:last], node[:last])
                key, node = key[last:], node[last:]
            if len(key) > RUN_AT_ONCE:
                huge = key[0]
                yield _columns(None, kinds, [np.full(len(key), huge), node, [None] * len(key)])
                key, node = key[:0], node[:0]
        if len(key):
            yield from runs(key, node)

    return _mapped(keys.sparkSession, keys, run, "list long, a long, b long")


def _candidates(rows, scheme, every):
    """Pairs that may link, from rows (list, cell, node, n, comp, bitmap) sorted by list and cell.

    As many as connect what they may connect; with ``every``, all between different components.
    """
    kinds = {"a": pa.int64(), "b": pa.int64()}

    def fold(raw, size):
        bits = np.frombuffer(raw, np.uint8)
        while len(bits) > size:
            bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
        return bits

    def pairs(node, n, comp, bitmaps):
        size = min(map(len, bitmaps))
        order = np.argsort(n, kind="stable")
        node, n, label = node[order], n[order], np.unique(comp, return_inverse=True)[1][order]
        bits = np.stack([fold(bitmaps[i], size) for i in order]).view(np.uint64)
        out = []
        for i in range(1, len(node)):
            low = np.searchsorted(n[:i] * scheme.den, n[i] * scheme.num)  # smaller ones cannot reach the share
            differ = np.bitwise_count(bits[low:i] ^ bits[i]).sum(axis=1, dtype=np.int64)
            may = (differ <= (n[low:i] + n[i]) * (scheme.den - scheme.num) // (scheme.den + scheme.num)) & (label[low:i] != label[i])
            found = np.flatnonzero(may)
            if not len(found):
                continue
            if not every:
                found = found[np.argsort(differ[found], kind="stable")]
                other, first = np.unique(label[low + found], return_index=True)
                found = found[first]
                label[np.isin(label, other)] = label[i]
            out += [(int(node[low + j]), int(node[i])) for j in found]
        return out

    def run(arrow):
        held, name = [], None
        for batch in arrow:
            for own in _runs(batch):
                if own.column(0)[0].as_py() != name and held:
                    yield close(held)
                    held = []
                name = own.column(0)[0].as_py()
                held.append(own)
        if held:
            yield close(held)

    def close(held):
        part = {k: np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in ("node", "n", "comp")}
        bitmaps = [x for b in held for x in b.column("bitmap").to_pylist()]
        out = pairs(part["node"], part["n"], part["comp"], bitmaps)
        return _columns(None, kinds, zip(*out) if out else [[], []])

    return _mapped(rows.sparkSession, rows, run, "a long, b long")


def _cells(spark, lists, nodes, comps):
    """Members of the lists with what their comparison needs, cut into cells where a list is long."""
    sizes = stored(spark, lists.groupBy("list").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > CHUNK), "long-lists")
    chunks = F.coalesce(F.ceil(F.col("members") / CHUNK), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.least(F.col("own"), other) * F.col("chunks") + F.greatest(F.col("own"), other),
    )
    if comps is not None:
        # Lists within one component have nothing left to join: their bitmaps stay where they are.
        placed = lists.join(comps, "node", "left").select("list", F.coalesce("root", "node").alias("comp"))
        apart = placed.groupBy("list").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
        lists = lists.join(stored(spark, apart.select("list"), "open-lists"), "list", "left_semi")
    members = lists.join(sizes, "list", "left").withColumn("chunks", chunks).withColumn("own", own)
    members = members.withColumn("cell", F.explode(cells)).select("list", "cell", "node")
    about = nodes.select("node", "n", "bitmap")
    if comps is not None:
        about = about.join(comps.withColumnRenamed("root", "comp"), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    else:
        about = about.withColumn("comp", F.col("node"))
    return (
        members.join(about, "node")
        .withColumn("place", F.xxhash64("list", "cell"))
        .repartition(partitions(spark), "place")
        .sortWithinPartitions("place")
        .select("place", "node", "n", "comp", "bitmap")
    )


def _verified(spark, pairs, nodes, rows, words, scheme):
    """``pairs`` (a, b) that link, by the sets of their texts."""
    ids = nodes.select(F.col("node"), "doc_id")
    pairs = stored(
        spark,
        pairs.join(ids.toDF("a", "a_id"), "a").join(ids.toDF("b", "b_id"), "b"),
        "pairs",
    )
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    wanted = pairs.select(F.explode(F.array("a_id", "b_id")).alias("doc_id"))
    # A filter of fixed size: it spares moving most of the other texts and decides nothing.
    words_of = wanted.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {FILTER_BITS}) % 64 as int))")).alias("bits"))
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for at, bits in words_of.collect():
        table[at] = bits
    sent = spark.sparkContext.broadcast(table.tobytes())

    def shrink(arrow):
        bits = np.frombuffer(sent.value, np.uint64)
        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in arrow:
            b = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            hit = np.flatnonzero((bits[b >> 6] >> (b & 63).astype(np.uint64)) & np.uint64(1))
            part = batch.take(pa.array(hit))
            texts = [compress(t.encode()) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.binary())], names=["doc_id", "packed"])

    packed = _mapped(spark, rows.where("doc_id is not null").select("doc_id", "text", bit.alias("bit")), shrink, "doc_id long, packed binary")
    texts = packed.groupBy("doc_id", F.xxhash64("packed").alias("copy")).agg(F.first("packed").alias("packed")).drop("copy")
    both = pairs.join(texts.toDF("a_id", "a_text"), "a_id").join(texts.toDF("b_id", "b_text"), "b_id")

    def compare(arrow):
        sets = once_per_worker(f"sets {words}", lambda: Sets(words))
        expand = zstandard.ZstdDecompressor().decompress
        last = (None, None)
        for batch in arrow:
            out = []
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if last[0] != x:
                    last = (x, sets(expand(x).decode()))
                one, two = last[1], sets(expand(y).decode())
                if digest(one) != a or digest(two) != b:
                    continue  # another text under the same key
                common = len(np.intersect1d(one, two, assume_unique=True))
                if scheme.den * common >= scheme.num * (len(one) + len(two) - common):
                    out.append((a, b))
            yield _columns(batch, {"a": pa.int64(), "b": pa.int64()}, zip(*out) if out else [[], []])

    return _mapped(spark, both.select("a", "b", "a_text", "b_text"), compare, "a long, b long").distinct()


def groups(docs, key="doc_id", text="text", words=WORDS, share=SHARE):
    """One row per document: doc_id, n_shingles and component_id, the smallest key reachable by links.

    Two documents link when their sets of ``words``-word shingles have a Jaccard similarity of at least ``share``.
    """
    return _grouped(keyed_text(docs, key, text), words, share)


def _grouped(rows, words, share):
    """:func:`groups` of rows of key and text; their further string columns stay."""
    spark = rows.sparkSession
    num, den = share
    scheme = Scheme(share)
    light_at_most = scheme.most_light()
    members = stored(spark, _keyed(rows, words, scheme, light_at_most), "sets")
    small = members.where(F.col("n_shingles").between(1, light_at_most)).groupBy("n_shingles").agg(F.count_distinct("node").alias("sets"))
    boundary = choose_boundary({r["n_shingles"]: r["sets"] for r in small.collect()}, scheme)
    nodes = stored(
        spark,
        members.where("doc_id is not null and node is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), *(F.first(c).alias(c) for c in ("lists", "subsets", "bitmap"))),
        "nodes",
    )
    # Heavy sets, and light ones that a heavy set may link to.
    listed = nodes.where(F.greatest(F.col("n"), F.floor(F.col("n") * den / num)) > boundary)
    lists = stored(
        spark,
        _listed(
            listed.select(F.explode("lists").alias("key"), "node")
            .repartition(partitions(spark), "key")
            .sortWithinPartitions("key", "node")
        ),
        "lists",
    )
    long = stored(spark, lists.where("list is not null").select("list", F.col("a").alias("node")).distinct(), "long")
    # Light: a star around the smallest set of each subset; larger sums than the subset can join do not link.
    subset = nodes.where(F.col("n") <= boundary).select("node", "n", F.inline("subsets")).withColumnRenamed("size", "c")
    heads = subset.groupBy("c", "key").agg(F.min(F.struct("n", "node")).alias("head"), F.count(F.lit(1)).alias("sets"))
    heads = stored(spark, heads.where("sets > 1").select("c", "key", F.col("head.n").alias("m"), F.col("head.node").alias("a")), "heads")
    light = subset.join(heads, ["c", "key"]).where((F.col("a") != F.col("node")) & (F.col("c") * (num + den) >= num * (F.col("m") + F.col("n"))))
    first = (
        lists.where("list is null").select("a", "b")
        .unionByName(_candidates(_cells(spark, long, nodes, None), scheme, every=False))
        .unionByName(light.select("a", F.col("node").alias("b")))
    )
    tried = stored(spark, first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "tried")
    links = stored(spark, _verified(spark, tried, nodes, rows, words, scheme), "links")
    roots = stored(spark, components(links), "roots")
    rest = _candidates(_cells(spark, long, nodes, roots), scheme, every=True)
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    rest = stored(spark, rest, "rest")
    if not rest.isEmpty():
        more = stored(spark, _verified(spark, rest, nodes, rows, words, scheme), "links")
        if not more.isEmpty():
            roots = stored(spark, components(links.unionByName(more)), "roots")
    least = roots.join(nodes.select("node", "doc_id"), "node").groupBy("root").agg(F.min("doc_id").alias("least"))
    grouped = stored(
        spark,
        nodes.select("node", "doc_id")
        .join(roots, "node", "left")
        .join(least, "root", "left")
        .select("node", F.coalesce("least", "doc_id").alias("component")),
        "groups",
    )
    return members.join(grouped, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        *rows.columns[2:],
    )


def first_of_group(docs, key="doc_id", text="text", words=WORDS, share=SHARE):
    """``docs`` without the documents that are linked to one of a smaller key.

    A document is its key and its text: of two texts under one key, the one that is linked to a smaller key goes alone.
    Keys decide which document stays, so rows without a key, and rows of one key that repeat or resemble each other, are
    not weighed against each other: they stay or go alike.  Only keys and text digests move: the few documents that go are left out by an anti join.
    """
    digest_of = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    copies = keyed_text(docs, key, text).withColumn("copy", F.sha2("text", 256))
    gone = _grouped(copies, words, share).where("component_id != doc_id").select("doc_id", "copy").distinct()
    gone = stored(docs.sparkSession, gone, "gone")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(row, F.col(key).cast("long").alias("id"), digest_of.alias("own"))
    return rows.join(gone, (F.col("id") == F.col("doc_id")) & (F.col("own") == F.col("copy")), "left_anti").select("row.*")
