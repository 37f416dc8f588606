"""Centroid clustering in whole numbers, against a plain version."""

import math

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import subvector_clusters
from feedloom.llm.subvector_clusters import Shard


def plain(rows, k=16, rounds=3, dimensions=64):
    """Rows (key, vector) into (key, cluster, distance), centroids, inertia by cluster."""
    kept = [
        (key, [math.floor(64 * float(x)) for x in v]) for key, v in rows
        if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)
    ]
    name = lambda key: brute.sha(f"1:{'' if key is None else key}")
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def near(v):
        far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[near(v)[0]].append(v)
        centroids = [
            [sum(x) // len(own) for x in zip(*own)] if own else old
            for own, old in zip(members, centroids)
        ]
    told = [(key, *near(v)) for key, v in kept]
    inertia = [sum(d for _, c, d in told if c == i) for i in range(len(centroids))]
    return told, centroids, inertia


def _vectors():
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(6, 64))
    rows = [(i, (centers[i % 6] + rng.normal(scale=0.2, size=64)).tolist()) for i in range(150)]
    same = rng.normal(size=64).tolist()
    rows += [(200, same)] * 40 + [(None, same), (None, centers[0].tolist())]
    rows += [(7, centers[1].tolist()), (7, centers[2].tolist()), (201, [0.0] * 64), (202, [-1e5] * 64)]
    rows += [(203, None), (204, []), (205, [1.0] * 63), (206, [1.0] * 65), (207, [None] + [1.0] * 63)]
    return [*rows, (208, [float("nan")] + [1.0] * 63), (209, [-math.inf] + [1.0] * 63)]


SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string, words string"


def _table(spark, rows):
    return spark.createDataFrame([(*r, "?", "?", "?") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize(
    "options", [{}, {"width": 1}, {"width": 3, "shard_rows": 7}, {"width": 64}, {"k": 3, "rounds": 0}]
)
def test_clusters(spark, options):
    rows = _vectors()
    found = subvector_clusters.cluster(_table(spark, rows), **options)
    told, centroids, inertia = plain(rows, options.get("k", 16), options.get("rounds", 3))
    assert found.centroids == centroids and found.inertia == inertia
    assert sorted(map(tuple, found.rows.collect()), key=repr) == sorted(told, key=repr)


def test_described(spark):
    rows = _vectors()
    told, centroids, inertia = plain(rows)
    found = subvector_clusters.described(subvector_clusters.cluster(_table(spark, rows)))
    assert found.count() == len(told)
    for r in found.collect():
        name = brute.sha(",".join(map(str, centroids[r.cluster])))
        assert (r.cluster_inertia, r.inertia) == (inertia[r.cluster], sum(inertia))
        assert r.centroid_sha256 == name


def test_ties_and_empty_centroids(spark):
    """Six equal vectors are six equal centroids: all rows go to the first, the others stay."""
    rows = [(i, [1.5] * 64) for i in range(6)]
    found = subvector_clusters.cluster(_table(spark, rows))
    assert found.centroids == [[96] * 64] * 6
    assert {(r.cluster, r.distance) for r in found.rows.collect()} == {(0, 0)}


def test_large_components(spark):
    """Up to 2^27 distances are exact; beyond, a vector takes no part."""
    large = subvector_clusters.LARGEST / 64
    rows = [(1, [large] * 64), (2, [-large] * 64), (3, [large * 2] * 64), (4, [3e38] * 64)]
    found = subvector_clusters.cluster(_table(spark, rows), k=1, rounds=0)
    assert sorted(r.distance for r in found.rows.collect()) == [0, 2**62]
    assert found.inertia == [2**62]


def test_no_vectors(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        table = spark.createDataFrame([(*r, "", "", "") for r in rows], SCHEMA)
        found = subvector_clusters.cluster(table)
        assert found.centroids == [] and found.rows.collect() == []
        assert subvector_clusters.described(found).collect() == []


@pytest.mark.parametrize("width", [1, 2, 5, 64])
def test_codes_lose_nothing(width):
    rng = np.random.default_rng(width)
    vectors = rng.integers(-9, 9, (300, 64)).astype(np.int32)
    shard = Shard.unpacked(*Shard.encoded(vectors, width).packed(), 64, width)
    assert (shard.decoded() == vectors).all()
    if width == 1:
        assert all(len(w) == 18 for w in shard.words)


def test_no_row_is_shuffled(spark):
    found = subvector_clusters.cluster(_table(spark, _vectors()))
    plan = found.rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert found.rows.where(F.col("distance") < 0).count() == 0
