import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from switchflow.llm import centroids, queries


def brute(rows, k=40, rounds=5):
    """Integer k-means by the contract over (id, vector) rows."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in kept]
    text = lambda i: "" if i is None else str(i)
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{text(r[0])}".encode()).hexdigest(), r[1]))
    mid = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(mid))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for c, vs in groups.items():
            mid[c] = [sum(col) // len(vs) for col in zip(*vs)]
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = {}
    for _, d, c in last:
        inertia[c] = inertia.get(c, 0) + d
    sha = lambda c: hashlib.sha256(",".join(map(str, mid[c])).encode()).hexdigest()
    return sorted((-1 if i is None else i, c, d, inertia[c], sum(inertia.values()), sha(c)) for i, d, c in last)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("clash")).withColumn("h", F.lit(0))


def run(spark, monkeypatch, rows):
    monkeypatch.setattr(queries, "table", lambda *_: vectors(spark, rows))
    return sorted(tuple(r) for r in queries.op12(spark, "").fillna(-1, ["vec_id"]).collect())


def test_clusters_against_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    mids = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(12)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(mids)]) for i in range(150)]
    # Copies under one id and several, ties, no id, odd lengths, nulls, not finite, large.
    rows += [rows[3], rows[3], (500, rows[4][1]), (None, rows[5][1]), (None, rows[6][1]), (501, [0.0] * 64), (502, [-0.0] * 64), (503, [-1e-9] * 64)]
    rows += [(504, [1.0] * 63), (505, [1.0] * 65), (506, [None] + [1.0] * 63), (507, [float("nan")] * 64), (508, [float("inf")] * 64), (509, None), (510, [])]
    rows += [(511, [1e4] * 64), (512, [-1e4] * 64)]
    want = brute(rows)
    assert run(spark, monkeypatch, rows) == want and len(want) == 160


def test_few_and_no_vectors(spark, monkeypatch):
    few = [(i, [float(i)] * 64) for i in range(3)]
    assert run(spark, monkeypatch, few) == brute(few)
    same = [(7, [0.5] * 64)] * 60
    assert run(spark, monkeypatch, same) == brute(same)
    assert run(spark, monkeypatch, [(1, None)]) == []


def test_huge_components_do_not_crash(spark, monkeypatch):
    got = run(spark, monkeypatch, [(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.0] * 64)])
    assert [r[2] for r in got] == [0, 0, 0]


def test_the_bound_saves_distances():
    rng = np.random.default_rng(1)
    mids = rng.integers(-5000, 5000, (40, 64))
    v = np.repeat(mids, 50, axis=0) + rng.integers(-300, 300, (2000, 64))
    pivots = centroids.spread(v[::7], 16)
    table = np.sqrt(np.stack([((v - p) ** 2).sum(axis=1) for p in pivots], axis=1).astype(float))
    best, distance, needed = centroids.nearest(v, table, mids, pivots)
    every = ((v[:, None, :] - mids[None]) ** 2).sum(axis=2)
    assert (distance == every.min(axis=1)).all() and (best == every.argmin(axis=1)).all()
    assert needed < 0.2 * every.size
