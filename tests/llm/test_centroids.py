"""Dimension-sharded Lloyd rounds against plain loops."""

import hashlib
import random

import numpy as np
import pytest

from wayfare.llm import centroids

VECS = "vec_id long, embedding array<float>, label int, v string, chunk long, cluster int"
NAMES = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def plain(rows, width, clusters=40, rounds=5):
    whole = [(hashlib.sha256(f"2:{i}".encode()).hexdigest(), np.floor(256 * np.array(x, np.float32).astype(float)).astype(int).tolist(), i)
             for i, x in rows if i is not None and x and len(x) == width and all(c is not None and np.isfinite(c) for c in x)]
    whole.sort()
    middles = [v for _, v, _ in whole[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(middles))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v, _ in whole]
        for n in set(own):
            mine = [v for (_, v, _), o in zip(whole, own, strict=True) if o == n]
            middles[n] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    last = [nearest(v) for _, v, _ in whole]
    by = {}
    for d, n in last:
        by[n] = by.get(n, 0) + d
    digest = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in middles]
    return sorted((i, n, d, by[n], sum(by.values()), digest[n]) for (_, _, i), (d, n) in zip(whole, last, strict=True))


def frame_of(spark, rows):
    return spark.createDataFrame([(i, x, 0, "v", 3, 1) for i, x in rows], VECS)


@pytest.mark.parametrize(("seed", "width", "columns", "spread", "size"), [
    (1, 6, 4, 1.0, 1.0), (2, 5, 1, 0.003, 1.0), (3, 8, 8, 0.3, 1e6), (4, 9, 100, 0.1, 1.0)])
def test_by_brute_force(spark, monkeypatch, seed, width, columns, spread, size):
    monkeypatch.setattr(centroids, "CHUNK", 64)
    draw = random.Random(seed)
    middles = [[draw.uniform(-size, size) for _ in range(width)] for _ in range(12)]
    rows = [(i * 3 % 1009, [c + draw.gauss(0, spread) for c in draw.choice(middles)]) for i in range(300)]
    rows += [(2000 + i, rows[0][1]) for i in range(150)]  # a third are one vector
    rows += [(5, rows[9][1]), (5, rows[8][1]), (None, rows[0][1]), (3000, None), (3001, []), (3002, [1.0] * (width + 1)),
             (3004, [float("nan")] * width), (3005, [None] * width), (-7, [float("-inf")] * width)]
    got = centroids.cluster(frame_of(spark, rows), width=width, columns=columns)
    assert got.columns == NAMES
    assert sorted(tuple(r) for r in got.collect()) == plain(rows, width)


def test_fewer_vectors_than_clusters(spark):
    rows = [(i, [float(i), 0.5, -i / 3]) for i in range(7)]
    assert sorted(tuple(r) for r in centroids.cluster(frame_of(spark, rows), width=3, columns=2).collect()) == plain(rows, 3)


def test_nothing(spark):
    for rows in ([], [(1, None), (2, [1.0, 2.0])]):
        got = centroids.cluster(frame_of(spark, rows))
        assert got.columns == NAMES and got.collect() == []


def test_wide_numbers_keep_64_bits(spark):
    rows = [(i, [1e5 * i, -1e5 * i, 3.0]) for i in range(60)]
    assert sorted(tuple(r) for r in centroids.cluster(frame_of(spark, rows), width=3, columns=2, clusters=4).collect()) == plain(rows, 3, 4)


def test_shards_stay_in_place(spark):
    """Labels join the shards without another shuffle of the shards."""
    kept = spark.range(500).selectExpr("id AS vec_id", "array(id % 7, id % 11, id, -id) AS v")
    shards = centroids.Shards(kept, 2, 3)
    to_shards = shards.labels(np.zeros((3, 4), np.int64)).flatMap(
        lambda r: [((b, r[0]), r[1][0]) for b in range(2)]).partitionBy(shards.partitions, shards.place)
    assert to_shards.union(shards.blocks).getNumPartitions() == shards.partitions
    pure = shards.blocks.mapPartitions(lambda rows: [len({block for (block, _), _ in rows})]).collect()
    assert max(pure) == 1
