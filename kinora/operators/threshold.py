"""Pairs above a cosine threshold that meet only where their sum can reach it; exact.

**Sparse vectors** (``sparse_threshold``).  Features are taken in one order, rarest first.  A vector's prefix is as many of its
leading features as it takes for the rest to be shorter than the threshold (unit vectors).  Two vectors without a common prefix
feature have all common features in the rest of the one whose prefix ends first, so their product stays below the threshold.
A vector therefore visits the cells of its prefix features only, not those of all its features or blocks.  A frequent
feature's cell is cut into blocks.  Within a cell all its vectors are multiplied at once; a pair is reported by the cell of its
first common prefix feature.

**Dense vectors** (``dense_threshold``).  Vectors belong to the nearest of some pivots, and a pivot's ball has the largest
angle of its members as radius.  By the triangle inequality for angles a vector can reach the threshold with a member of
another ball only if its angle to that pivot is at most the threshold's angle plus the radius; it visits only such balls.  Big
balls are cut into blocks.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kinora.functions.vectors import l2_norm, scale
from kinora.operators.blocks import PAIR_SCHEMA, dense_block_size, dense_cells
from kinora.session import stored

BLOCK_SIZE = 2048
#: Most numbers of a dense matrix that a cell holds at once.
CELLS = 8_000_000
#: Sums are rounded by less than this; bounds give way by it.
SLACK = 1e-9
MOST_PIVOTS = 256

_KEY = 1 << 20


def _parallelism(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _cell_key(place, left, right):
    """One sortable number of (place, lower block, higher block)."""
    return F.xxhash64(F.col(place), F.least(left, right), F.greatest(left, right))


# -- sparse ------------------------------------------------------------------------------------------


def prefixes(rows, min_score):
    """(g, e, w) rows -> (e, gs, ws, n_prefix): unit vectors by rising feature frequency, and the length of their prefix.

    Zero and incomplete vectors have no direction and are left out.
    """
    frequency = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    entry = F.struct("n", "g", "w")
    vectors = rows.where("w != 0").join(frequency, "g").groupBy("e").agg(F.array_sort(F.collect_list(entry)).alias("x"))
    norm = l2_norm(F.transform("x", lambda x: x["w"]))
    vectors = vectors.withColumn("norm", norm).where((F.col("norm") > 0) & ~F.isnan("norm"))
    vectors = vectors.select("e", F.transform("x", lambda x: x["g"]).alias("gs"), F.transform("x", lambda x: x["w"] / F.col("norm")).alias("ws"))
    # Squares of what is left after each feature; the prefix ends where that is below the threshold's square.
    least = min_score * min_score * (1 - SLACK)
    step = F.aggregate(
        F.reverse("ws"),
        F.struct(F.lit(0.0).alias("rest"), F.lit(0).alias("outside")),
        lambda a, w: F.struct(
            (a["rest"] + w * w).alias("rest"), (a["outside"] + F.when(a["rest"] + w * w < least, 1).otherwise(0)).alias("outside")
        ),
    )
    return vectors.select("e", "gs", "ws", (F.size("ws") - step["outside"]).alias("n_prefix"))


def visits(vectors, block_size=BLOCK_SIZE):
    """The rows that enter the pair step: vectors in the cells of their prefix features."""
    spark = vectors.sparkSession
    placed = vectors.select("e", "gs", "ws", "n_prefix", F.explode(F.slice("gs", 1, F.greatest("n_prefix", F.lit(1)))).alias("at")).where("n_prefix > 0")
    sizes = placed.groupBy("at").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_size)).cast("int").alias("blocks")).where("blocks > 1")
    # Features with more vectors than a block: at most (prefix rows / block size) of them.
    sizes = stored(spark, sizes, "wide-features")
    placed = placed.join(sizes, "at", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("e"), F.col("blocks")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return placed.withColumn("own", own).select("at", "own", others, "e", "gs", "ws", "n_prefix")


def sparse_threshold(rows, min_score, block_size=BLOCK_SIZE):
    """Pairs (e, f, score), both directions, e != f, whose cosine is above ``min_score`` (> 0).

    ``rows``: (g, e, w), one row per (g, e), ids as longs; read twice, so pass a stored table.
    """
    if min_score <= 0:
        raise ValueError("vectors without a common feature have a cosine of 0")
    spark = rows.sparkSession
    rows = rows.select(F.col("g").cast("long").alias("g"), F.col("e").cast("long").alias("e"), F.col("w").cast("double").alias("w"))
    entering = visits(stored(spark, prefixes(rows, min_score), "prefixes"), block_size)
    dealt = (
        entering.select(
            _cell_key("at", F.col("own"), F.col("other")).alias("cell"), "at",
            F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"),
            (F.col("own") == F.col("other")).alias("alone"), "e", "gs", "ws", "n_prefix",
        )
        .repartition(4 * _parallelism(spark), "cell")
        .sortWithinPartitions("cell", "at")
    )
    found = dealt.mapInArrow(_cells_of(min_score), "e long, f long, score double")
    return found.unionByName(found.select(F.col("f").alias("e"), F.col("e").alias("f"), "score"))


def _cells_of(min_score):
    def close(held):
        columns = {n: pa.concat_arrays([b.column(n) for b in held]) for n in ("side", "e", "gs", "ws", "n_prefix")}
        at, alone = held[0].column("at")[0].as_py(), held[0].column("alone")[0].as_py()
        side, e = columns["side"].to_numpy(), columns["e"].to_numpy()
        sizes = np.diff(columns["gs"].offsets.to_numpy())
        gs, ws = columns["gs"].flatten().to_numpy(), columns["ws"].flatten().to_numpy()
        owner = np.repeat(np.arange(len(e)), sizes)
        names, column = np.unique(gs, return_inverse=True)
        left, right = (np.arange(len(e)),) * 2 if alone else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        # What a vector's prefix holds before this cell's feature: a pair with some of it in common is reported there.
        place = np.flatnonzero(gs == at)
        before = (np.arange(len(gs)) < place[owner]).astype(float)
        product, earlier = np.zeros((2, len(left), len(right)))
        width = max(1, CELLS // max(1, len(e)))
        for first in range(0, len(names), width):  # features a stripe at a time
            inside = (column >= first) & (column < first + width)
            for total, value in ((product, ws), (earlier, before)):
                matrix = np.zeros((len(e), min(width, len(names) - first)))
                matrix[owner[inside], column[inside] - first] = value[inside]
                total += matrix[left] @ matrix[right].T
        a, b = np.nonzero((product > min_score) & (earlier == 0))
        score, a, b = product[a, b], left[a], right[b]
        if alone:
            a, b, score = (x[a < b] for x in (a, b, score))
        return pa.RecordBatch.from_arrays([pa.array(e[a]), pa.array(e[b]), pa.array(score)], names=["e", "f", "score"])

    def run(arrow):
        held, name = [], None
        for batch in arrow:
            keys = list(zip(batch.column("cell").to_pylist(), batch.column("at").to_pylist()))
            start = 0
            for i in range(1, len(keys) + 1):
                if i == len(keys) or keys[i] != keys[start]:
                    if keys[start] != name and held:
                        yield close(held)
                        held = []
                    name = keys[start]
                    held.append(batch.slice(start, i - start))
                    start = i
        if held:
            yield close(held)

    return run


# -- dense -------------------------------------------------------------------------------------------


def _unit(vectors):
    vectors = vectors.select(F.col("e").cast("long").alias("e"), F.col("vec").cast("array<double>").alias("vec"))
    return (
        vectors.withColumn("norm", l2_norm(F.col("vec")))
        .where((F.col("norm") > 0) & ~F.isnan("norm"))
        .select("e", scale(F.col("vec"), 1 / F.col("norm")).alias("vec"))
    )


def _angles(batch, pivots):
    vec = batch.column("vec").flatten().to_numpy().reshape(batch.num_rows, -1)
    return np.arccos(np.clip(vec @ pivots.T, -1.0, 1.0))


def balls(unit, n_pivots):
    """Unit vectors with their ball and the angles to it: (e, vec, ball, angle), stored, and the pivots (matrix).

    Pivots are spread out: each is the vector of the sample that is farthest from the ones before.
    """
    spark = unit.sparkSession
    # A sample of fixed size, chosen by hash: it decides what is skipped, not what is found.
    sample = [r["vec"] for r in unit.orderBy(F.xxhash64("e"), "e").limit(8 * n_pivots).collect()]
    points = np.array(sample, float).reshape(len(sample), -1) if sample else np.zeros((0, 1))
    chosen = [0] if len(points) else []
    nearest = points @ points[0] if len(points) else None
    while chosen and len(chosen) < min(n_pivots, len(points)):
        far = int(np.argmin(nearest))
        if nearest[far] > 1 - 1e-9:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, points @ points[far])
    sent = spark.sparkContext.broadcast(points[chosen])

    def assigned(arrow):
        for batch in arrow:
            angle = _angles(batch, sent.value) if batch.num_rows else np.zeros((0, 1))
            ball = angle.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("e"), batch.column("vec"), pa.array(ball, pa.int32()), pa.array(angle[np.arange(len(ball)), ball])],
                names=["e", "vec", "ball", "angle"],
            )

    return stored(spark, unit.mapInArrow(assigned, "e long, vec array<double>, ball int, angle double"), "balls"), points[chosen]


def dense_visits(members, pivots, min_score, block_size=BLOCK_SIZE):
    """The rows that enter the pair step: (e, vec, own, other) with numbered blocks of balls."""
    spark = members.sparkSession
    # One row per pivot.
    about = {r["ball"]: r for r in members.groupBy("ball").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("n")).collect()}
    radius, firsts, blocks, total = np.full(len(pivots), -np.inf), [], [], 0
    for i in range(len(pivots)):
        n = about[i]["n"] if i in about else 0
        radius[i] = about[i]["radius"] if n else -np.inf
        firsts.append(total)
        blocks.append(-(-n // block_size))
        total += blocks[-1]
    reach = math.acos(max(-1.0, min(1.0, min_score))) + 1e-7  # more than angles are rounded
    sent = spark.sparkContext.broadcast((pivots, radius, firsts, blocks))
    own = F.pmod(F.xxhash64("e"), F.lit(_KEY)).cast("int")

    def dealt(arrow):
        pivots, radius, firsts, blocks = sent.value
        sub = [np.arange(f, f + b) for f, b in zip(firsts, blocks)]
        first, count = np.array(firsts), np.maximum(1, np.array(blocks))
        step = max(1, CELLS // (max(1, sum(blocks)) * max(1, pivots.shape[-1])))
        for batch in (b.slice(at, step) for b in arrow for at in range(0, b.num_rows, step)):
            near = _angles(batch, pivots) <= reach + radius
            ball = batch.column("ball").to_numpy()
            near[np.arange(len(ball)), ball] = True
            places = [np.concatenate([sub[j] for j in np.flatnonzero(row)]) for row in near]
            mine = first[ball] + batch.column("part").to_numpy() % count[ball]
            row = pa.array(np.repeat(np.arange(len(places)), [len(p) for p in places]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("e").take(row), batch.column("vec").take(row), pa.array(mine, pa.int32()).take(row), pa.array(np.concatenate(places), pa.int32())],
                names=["e", "vec", "own", "other"],
            )

    return members.withColumn("part", own).mapInArrow(dealt, "e long, vec array<double>, own int, other int"), max(1, total)


def dense_threshold(vectors, min_score, n_pivots=None, block_size=None):
    """Pairs (e, f, score), both directions, e != f, of dense vectors (e, vec) whose cosine is above ``min_score``."""
    spark = vectors.sparkSession
    unit = stored(spark, _unit(vectors), "unit-vectors")
    if block_size is None:
        size = unit.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("width")).first()
        block_size = dense_block_size(size["n"], size["width"] or 1, BLOCK_SIZE)
    if n_pivots is None:
        # Balls of about half a block: should none be out of reach, vectors travel little more than without them.
        n_pivots = max(1, min(MOST_PIVOTS, 2 * unit.count() // block_size))
    members, pivots = balls(unit, n_pivots)
    entering, blocks = dense_visits(members, pivots, min_score, block_size)
    own, other = F.col("own"), F.col("other")
    cells = entering.select(
        (F.least(own, other).cast("long") * blocks + F.greatest(own, other)).alias("cell"),
        F.when(own > other, 1).otherwise(0).cast("int").alias("side"), "e", "vec",
    )
    cells = cells.repartition(4 * _parallelism(spark), "cell").sortWithinPartitions("cell")
    digits = 9

    def fold(batches):
        return dense_cells(batches, blocks, None, min_score, digits)

    found = cells.mapInArrow(fold, PAIR_SCHEMA)
    return found.select("e", "f", (F.col("dot") / F.sqrt(F.col("e_scale") * F.col("f_scale"))).alias("score")).where((F.col("score") > min_score) & ~F.isnan("score"))
