"""Ball k-means against Lloyd's algorithm in whole numbers, and against its SQL."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from lexipress.llm import ball_kmeans


def lloyd(rows, clusters, rounds):
    """vec_id, cluster, distance, sums and digest by comparing everything with everything."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows]
    first = sorted(kept, key=lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest())[:clusters]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for k in range(len(centroids)):
            members = [v for (_, v), o in zip(kept, own, strict=True) if o == k]
            if members:
                centroids[k] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [(i, *reversed(nearest(v))) for i, v in kept]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((i, c, d, sum(e for _, o, e in found if o == c), sum(e for _, _, e in found), names[c]) for i, c, d in found)


def vectors(n, seed, kinds=6, spread=0.05):
    r = random.Random(seed)
    middles = [[r.uniform(-1, 1) for _ in range(64)] for _ in range(kinds)]
    return [(i, [m + r.gauss(0, spread) for m in middles[i % kinds]]) for i in range(n)]


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    return sorted(tuple(r) for r in ball_kmeans.cluster(df, **more).collect())


@pytest.mark.parametrize("n, kinds, spread", [(120, 6, 0.05), (90, 2, 0.4), (60, 1, 0.001)])
def test_equals_lloyd(spark, monkeypatch, n, kinds, spread):
    monkeypatch.setattr(ball_kmeans, "BLOCK", 16)
    rows = vectors(n, n, kinds, spread)
    assert run(spark, rows, rounds=4) == lloyd(rows, 8, 4)


def test_copies_ties_and_empty_clusters(spark):
    """Few points, many copies: centroids coincide, distances tie, clusters stay empty."""
    rows = [(i, [float(i % 3 == k % 3) for k in range(64)]) for i in range(40)]
    assert run(spark, rows, rounds=3) == lloyd(rows, 8, 3)


def test_fewer_vectors_than_clusters(spark):
    rows = vectors(3, 1)
    assert run(spark, rows, rounds=2) == lloyd(rows, 8, 2)


def test_rows_that_are_left_out_and_shared_ids(spark):
    good = vectors(12, 2)
    odd = [(100, None), (101, [1.0] * 63), (102, [1.0] * 65), (103, [None] + [1.0] * 63), (104, [float("nan")] * 64), (105, [float("inf")] + [0.0] * 63), (106, [2.0**17] + [0.0] * 63), (107, [])]
    assert run(spark, good + odd, rounds=2) == lloyd(good, 8, 2)
    shared = ball_kmeans.cluster(spark.createDataFrame(good + [(0, good[5][1]), (None, good[6][1])], "vec_id long, embedding array<double>"), rounds=2).collect()
    assert len(shared) == 14 and sum(r["vec_id"] == 0 for r in shared) == 2 and sum(r["vec_id"] is None for r in shared) == 1
    assert ball_kmeans.cluster(spark.createDataFrame(odd, "vec_id long, embedding array<double>")).count() == 0


def test_balls_decide_like_all_comparisons():
    """Cores, annuli and neighbours against every centroid, from any earlier assignment."""
    r = np.random.default_rng(4)
    for scale in (3, 40, 4000):
        centroids, points = r.integers(-scale, scale, (12, 64)), r.integers(-scale, scale, (500, 64))
        centroids[5] = centroids[2]
        every = ((points[:, None] - centroids[None]) ** 2).sum(axis=2)
        was = r.integers(0, 12, 500)
        radii = np.array([max([0, *every[was == c, c]]) for c in range(12)])
        for balls in (ball_kmeans.Balls(centroids, radii), ball_kmeans.Balls(centroids, None)):
            cluster, near = balls.assign(points, was)
            assert (cluster == every.argmin(axis=1)).all() and (near == every.min(axis=1)).all()


def test_neighbours_are_few_between_tight_balls():
    centroids = np.arange(20)[:, None] * 1000 * np.ones((1, 64), dtype=np.int64)
    balls = ball_kmeans.Balls(centroids.astype(np.int64), np.full(20, 64 * 600**2))
    assert max(map(len, balls.neighbours)) == 2


def test_vectors_are_not_shuffled_in_a_round(spark, sf_dir):
    df = ball_kmeans.op12_ball_kmeans(spark, sf_dir)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    assert sorted(map(tuple, ball_kmeans.op12_ball_kmeans(spark, sf_dir).collect())) == sorted(con.execute(ball_kmeans.OP12_SQL).fetchall())
