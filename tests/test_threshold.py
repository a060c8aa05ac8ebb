"""Threshold joins against all pairs, and how little of them meets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinora.operators import threshold
from kinora.operators.pairs import dense_pairs


def sparse(rng, n, features):
    """Vectors with a few frequent and many rare features."""
    rows = {}
    for e in range(n):
        for g in rng.choice(features, rng.integers(1, 7), p=_popular(features)):
            rows[int(g), e] = float(rng.choice([0.2, 0.5, 1.0, 3.0]))
    rows.update({(g, n): rows.get((g, 0)) for g in range(features) if (g, 0) in rows})  # a copy of the first
    rows[5, n + 1] = 0.0  # no direction
    return rows


def _popular(features):
    weights = 1 / np.arange(1, features + 1)
    return weights / weights.sum()


def cosines(rows):
    names = sorted({e for _, e in rows})
    matrix = np.zeros((len(names), 1 + max(g for g, _ in rows)))
    for (g, e), w in rows.items():
        matrix[names.index(e), g] = w
    norm = np.linalg.norm(matrix, axis=1)
    return names, (matrix @ matrix.T) / np.where(np.outer(norm, norm) == 0, np.inf, np.outer(norm, norm))


@pytest.mark.parametrize("least,block", [(0.6, 2048), (0.6, 7), (0.3, 16), (0.95, 5)])
def test_sparse_threshold_equals_all_pairs(spark, least, block):
    rows = sparse(np.random.default_rng(3), 150, 30)
    table = spark.createDataFrame([(g, e, w) for (g, e), w in rows.items()], "g long, e long, w double")
    got = {(r["e"], r["f"]): r["score"] for r in threshold.sparse_threshold(table, least, block_size=block).collect()}
    names, sims = cosines(rows)
    near = {(a, b): sims[i, j] for i, a in enumerate(names) for j, b in enumerate(names) if a != b and abs(sims[i, j] - least) > 1e-9 and sims[i, j] > least}
    assert {p for p in got if abs(got[p] - least) > 1e-9} == set(near)
    assert all(got[p] == pytest.approx(s) for p, s in near.items())


def test_prefixes_spare_most_meetings(spark):
    rows = sparse(np.random.default_rng(4), 2000, 200)
    table = spark.createDataFrame([(g, e, w) for (g, e), w in rows.items()], "g long, e long, w double").cache()

    def meetings(places):
        return places.groupBy("at").count().selectExpr("sum(count * count)").first()[0]

    vectors = threshold.prefixes(table, 0.6)
    entering = meetings(threshold.visits(vectors))
    everything = meetings(table.where("w != 0").select(F.col("g").alias("at")))
    assert 0 < entering < 0.35 * everything
    assert vectors.where("n_prefix > size(gs) or n_prefix < 1").count() == 0


def test_sparse_threshold_edges(spark):
    empty = spark.createDataFrame([], "g long, e long, w double")
    assert threshold.sparse_threshold(empty, 0.5).count() == 0
    with pytest.raises(ValueError):
        threshold.sparse_threshold(empty, 0.0)
    same = spark.createDataFrame([(1, e, 2.0) for e in range(40)], "g long, e long, w double")
    assert threshold.sparse_threshold(same, 0.99, block_size=6).count() == 40 * 39


def clustered(rng, n, centres, width, noise):
    middle = rng.normal(0, 1, (centres, width))
    return middle[rng.integers(0, centres, n)] + noise * rng.normal(0, 1, (n, width))


@pytest.mark.parametrize("least,pivots,block,noise", [(0.6, 12, 2048, 0.3), (0.3, 5, 20, 2.0), (0.9, 30, 9, 0.1), (-0.2, 4, 50, 1.0)])
def test_dense_threshold_equals_all_pairs(spark, least, pivots, block, noise):
    points = clustered(np.random.default_rng(5), 200, 12, 8, noise)
    points[3] = 0.0
    points[4] = points[5]
    table = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "e long, vec array<double>")
    got = threshold.dense_threshold(table, least, n_pivots=pivots, block_size=block).collect()
    want = dense_pairs(table, min_score=least).collect()
    assert {(r["e"], r["f"]): round(r["score"], 9) for r in got} == {(r["e"], r["f"]): round(r["score"], 9) for r in want}
    assert len(got) == len({(r["e"], r["f"]) for r in got}) > 0


def test_balls_out_of_reach_are_not_visited(spark):
    points = clustered(np.random.default_rng(6), 600, 20, 16, 0.15)
    table = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "e long, vec array<double>")
    members, pivots = threshold.balls(threshold._unit(table), 20)
    visits, blocks = threshold.dense_visits(members, pivots, 0.9)
    assert blocks >= 15 and visits.count() < 0.3 * 600 * blocks
    assert threshold.dense_threshold(table.limit(0), 0.5).count() == 0
