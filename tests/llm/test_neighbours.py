"""Neighbour search over pivots and shards against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from grabqc.llm import ann


def clusters(n, around=12, width=16, seed=3):
    """Rows in tight clusters, every third row in the first."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(around, width))
    return [(i, (centres[0 if i % 3 == 0 else rng.integers(around)] + 0.02 * rng.normal(size=width)).tolist()) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)


def brute(rows, every, k=5):
    """query id, then (rank, id, score) of the nearest other rows, for every row that asks."""
    ids, out = np.array([i for i, _ in rows]), []
    vectors = np.array([v for _, v in rows])
    for at in np.nonzero(ids % every == 0)[0]:
        score = ann.measure(np.repeat(vectors[at:at + 1], len(rows), 0), vectors)
        score[at] = -np.inf
        first = [j for j in np.lexsort((ids, -score))[:k] if j != at]
        out += [(int(ids[at]), r + 1, int(ids[j]), round(float(score[j]), 9)) for r, j in enumerate(first)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("shard_rows, query_rows, pivots", [(40, 16, 256), (40, 4096, 3), (4096, 4096, 256), (100, 8, 1)])
def test_clustered_and_scattered_vectors(spark, shard_rows, query_rows, pivots):
    rng = np.random.default_rng(4)
    for rows in (clusters(900), [(i, rng.normal(size=6).tolist()) for i in range(500)]):
        got = ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, shard_rows=shard_rows, query_rows=query_rows, pivots=pivots)
        assert found(got) == brute(rows, 20)


def test_copies_in_many_shards_go_by_id(spark):
    """More equal rows than a shard holds: the smallest ids are found, whatever shard they lie in."""
    rng = np.random.default_rng(5)
    one = rng.normal(size=8).tolist()
    rows = [(i, one if i % 2 else rng.normal(size=8).tolist()) for i in range(600)] + [(1000 + i, one) for i in range(20)]
    got = ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, shard_rows=50)
    ids = {}
    for q, rank, i, _ in found(got):
        ids.setdefault(q, []).append(i)
    want = {}
    for q, rank, i, _ in brute(rows, 20):
        want.setdefault(q, []).append(i)
    assert ids == want and ids[1000] == [1, 3, 5, 7, 9]


def test_rows_that_share_an_id_are_rows_each(spark):
    rows = [(7, [1.0, 0.0]), (7, [1.0, 0.0]), (20, [0.9, 0.1]), (20, [0.0, 1.0])]
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 3)) for r in ann.nearest(frame(spark, rows), F.col("vec_id") == 20).collect())
    assert got == [(20, 1, 7, 0.994), (20, 1, 20, 0.11), (20, 2, 7, 0.0), (20, 2, 7, 0.994), (20, 3, 7, 0.0), (20, 3, 20, 0.11)]


def test_shards_out_of_reach_are_skipped(spark):
    """On clustered vectors most pivots' rows never meet a query; on scattered ones all do, and nothing is lost either way."""
    def met(rows):
        parts = ann.index(frame(spark, rows), shard_rows=40, pivots=64)
        _, again = ann._found(*parts, F.col("vec_id") % 20 == 0, 5, 1.0, 4096)
        meetings = sum(len(r.rows) // 8 for r in again.collect())
        return meetings / (sum(i % 20 == 0 for i, _ in rows) * parts[2].count())

    rng = np.random.default_rng(6)
    assert met(clusters(1500)) < 0.35
    assert met([(i, rng.normal(size=32).tolist()) for i in range(800)]) > 0.9
