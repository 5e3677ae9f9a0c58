"""Centroid clustering against a plain version, on awkward vectors."""

import hashlib
import math
import random

import numpy as np
import pytest

from dealsieve.llm import curve_clusters as K

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_clusters(rows, clusters=K.CLUSTERS, rounds=K.ROUNDS):
    """(id, cluster, distance, cluster inertia, inertia, centroid hash) with Python integers, all pairs compared."""
    kept = []
    for i, v, *_ in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [max(min(math.floor(256 * float(np.float32(x))), 1 << 27), -(1 << 27)) for x in v]))
    key = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [x for _, x in sorted(kept, key=key)[:clusters]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centroids))
    for _ in range(rounds):
        own = {}
        for _, x in kept:
            own.setdefault(nearest(x)[1], []).append(x)
        centroids = [[sum(col) // len(own[k]) for col in zip(*own[k])] if k in own else c for k, c in enumerate(centroids)]
    out = [(i, *reversed(nearest(x))) for i, x in kept]
    total = {}
    for _, k, d in out:
        total[k] = total.get(k, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, k, d, total[k], sum(total.values()), digest[k]) for i, k, d in out], key=str)


def vectors(n, seed=0):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 0.3) for _ in range(64)] for _ in range(8)]
    return [(i, [m + rng.gauss(0, 0.05) for m in rng.choice(middles)], i % 3) for i in range(n)]


def awkward(n=150):
    rows = vectors(n)
    hot = rows[0][1]
    rows += [(500 + i, hot, 0) for i in range(90)]                         # one vector held by many rows
    rows += [(7, rows[7][1], 1), (None, rows[8][1], 1), (None, rows[9][1], None)]
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 63, 1), (903, [0.0] * 65, 1), (904, [None] + [0.0] * 63, 1),
             (905, [math.nan] + [0.0] * 63, 1), (906, [math.inf] + [0.0] * 63, 1), (907, [0.0] * 64, 1), (908, [-0.0] * 64, 1)]
    return rows


def result(df, **options):
    return sorted([(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                   for r in K.cluster_vectors(df, **options).collect()], key=str)


def test_equals_plain_version(spark):
    rows = awkward()
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(3)) == plain_clusters(rows)


def test_few_vectors_and_wide_components(spark):
    rows = [(i, [float(x)] + [0.5] * 63, 0) for i, x in enumerate([1, 2, 3e30, -3e30, 70000, 70001, 5e5])]
    assert result(spark.createDataFrame(rows, SCHEMA), rounds=2) == plain_clusters(rows, rounds=2)


def test_empty_table_and_clashing_names(spark):
    rows = vectors(60, 3)
    wide = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA + ", key int, x string, cluster int, ids int")
    assert result(wide) == plain_clusters(rows)
    assert result(wide.limit(0)) == []


def test_a_hot_vector_is_dealt_over_tasks(spark):
    rows = [(i, [0.25] * 64, 0) for i in range(4000)] + vectors(400, 5)
    kept = K.kept_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = K.curve_blocks(kept).rdd.glom().map(lambda p: sum(len(r.ids) for r in p)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4400 and max(sizes) < 2 * 4400 / len(sizes)


def test_hilbert_neighbours_differ_in_one_cell():
    cells = np.array([[a, b, c] for a in range(8) for b in range(8) for c in range(8)])
    key = K.hilbert_keys(cells, 3)
    assert sorted(key.tolist()) == list(range(512))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("seed", range(3))
def test_dropped_centroids_are_never_nearest(seed):
    rng = np.random.default_rng(seed)
    centroids = rng.integers(-60, 60, (40, 64))
    x = centroids[rng.integers(0, 3, 500)] + rng.integers(-9, 9, (500, 64))
    for i in range(0, 500, 50):
        block = x[i:i + 50]
        near = K.candidates(block.min(0), block.max(0), centroids)
        assert set(((block[:, None] - centroids) ** 2).sum(2).argmin(1)) <= set(near)


def test_curve_blocks_prune_centroids(spark):
    rows = vectors(4000, 9)
    out = K.cluster_vectors(spark.createDataFrame(rows, SCHEMA)).agg({"n_candidates": "avg"}).first()[0]
    assert out < 30
