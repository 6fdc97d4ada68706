"""op13: the index against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from railtempo.llm import vector_search as vs

SCHEMA = "vec_id long, embedding array<float>, label int, row string, key int, score int"


def brute(rows, k=20):
    held = []
    for at, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            held.append((at, i, [int(x) for x in np.clip(np.floor(64 * np.array(v, np.float32).astype(float)), -(2**27), 2**27)]))
    dim = max((len(v) for *_, v in held), default=0)
    held = [(at, i, np.array(v + [0] * (dim - len(v)), object)) for at, i, v in held]
    out = []
    for at, i, q in held:
        if i is not None and i % 20 == 0:
            scored = [(-(q @ v if dim else 0), j is None, j or 0, j) for other, j, v in held if other != at]
            out += [(i, n + 1, s[3], -int(s[0])) for n, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(out, key=str)


def found(spark, rows, parts=3):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "r", 2, 3) for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in vs.top_k(df.repartition(parts), F.col("vec_id") % 20 == 0).collect()), key=str)


def some(n, dim, seed, groups=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    made = centres[rng.integers(groups, size=n)] + 0.3 * rng.normal(size=(n, dim))
    return (made / np.linalg.norm(made, axis=1)[:, None]).astype(np.float32)


@pytest.fixture
def small_pieces(monkeypatch):
    for name, value in {"PER_PIVOT": 60, "PIECE": 16, "TOGETHER": 7, "FIRST_ROUND": 2}.items():
        monkeypatch.setattr(vs, name, value)


def test_many_annuli(spark, small_pieces):
    rows = list(enumerate(some(900, 12, 1).tolist()))
    assert found(spark, rows) == brute(rows)


def test_different_lengths_of_vectors(spark, small_pieces):
    """Norms that differ much: the highest scores are far from the nearest vectors."""
    rng = np.random.default_rng(2)
    rows = [(i, (v * s).tolist()) for i, (v, s) in enumerate(zip(some(600, 8, 3), 10 ** rng.uniform(-2, 2, 600)))]
    assert found(spark, rows) == brute(rows)


def test_equal_vectors_and_ids(spark, small_pieces):
    same = some(1, 6, 4)[0].tolist()
    rows = [(i, same) for i in range(0, 400)] + [(i + 400, v) for i, v in enumerate(some(300, 6, 5).tolist())]
    rows += [(None, same), (None, same), (20, same), (20, [-x for x in same]), (40, same)]
    assert found(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (20, None), (40, [None, 1.0]), (60, [float("nan"), 0.0]), (80, [float("inf"), 0.0]), (100, [])]
    rows += [(120, [3e38, -3e38]), (1, [1.0]), (2, [1.0, 2.0, 3.0]), (3, [-0.001, 0.001]), (None, [0.5]), (-20, [0.25, 0.0])]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(20, None)], [(20, [])], [(20, [1.0])], [(1, [1.0]), (2, [2.0])]])
def test_few_vectors(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_bounds_hold(spark):
    """No vector of an annulus scores above its bound, and the bounds rule some annuli out."""
    vectors = np.floor(64 * some(2000, 4, 7)).astype(np.int16)
    shape = vs.Shape(2000, 4, 64, float((vectors.astype(float) ** 2).sum(1).max()))
    lifted = shape.lifted(vectors)
    pivots = lifted[:5]
    pivot, distance = vs._nearest(lifted, pivots)
    ring = pivot * 10 + (distance // 8).astype(int)
    rings = np.unique(ring)
    least, greatest = (np.array([f(distance[ring == r]) for r in rings]) for f in (min, max))
    directory = vs.Directory(pivots, rings // 10, least, greatest, np.ones(rings.size, int))
    queries = vectors[::20]
    bounds = directory.bounds(queries, shape)
    scores = queries.astype(int) @ vectors.T.astype(int)
    best = np.stack([scores[:, ring == r].max(1) for r in rings], 1)
    assert (best <= bounds).all()
    assert (bounds < np.sort(scores, 1)[:, -20][:, None]).mean() > 0.3


def test_vectors_that_recur_are_not_broadcast(spark, small_pieces, monkeypatch):
    """Their staged pieces are small files, as they are compressed, whatever the driver would have to hold."""
    rows, plans, staged = list(enumerate(some(300, 8, 8).tolist())), [], vs.staged

    def planned(df, name):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, name)

    monkeypatch.setattr(vs, "staged", planned)
    assert found(spark, rows) == brute(rows)
    joins = [p for p in plans if "SortMergeJoin" in p]
    assert joins and not any("Broadcast" in p for p in plans)
