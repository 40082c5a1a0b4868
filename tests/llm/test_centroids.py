"""Centroid clustering against plain whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from tidemark.llm import centroids as C

SCHEMA = "vec_id bigint, embedding array<float>, v string, cluster int"


def plain(rows, k, rounds, size, seed=2):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == size and all(x is not None and math.isfinite(x) and abs(x) <= C.LARGEST / C.SCALE for x in e):
            kept.append((i, [math.floor(256 * float(np.float32(x))) for x in e]))
    draw = sorted((i is None, "" if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept)
    cents = [v for _, _, v in draw[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for n in range(len(cents)):
            held = [v for (_, v), c in zip(kept, own) if c == n]
            if held:
                cents[n] = [sum(x) // len(held) for x in zip(*held)]
    found = [(i, *near(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    by = {n: sum(d for _, d, c in found if c == n) for _, _, n in found}
    name = lambda n: hashlib.sha256(",".join(map(str, cents[n])).encode()).hexdigest()
    return sorted(((i, c, d, by[c], total, name(c)) for i, d, c in found), key=str)


def some(seed, size, n=200):
    draw = random.Random(seed)
    middle = [[draw.uniform(-1, 1) for _ in range(size)] for _ in range(6)]
    rows = [(i, [x + draw.gauss(0, 0.1) for x in draw.choice(middle)]) for i in range(n)]
    rows += [(n, None), (n + 1, [0.0] * (size - 1)), (n + 2, [math.nan] + [0.0] * (size - 1)), (n + 3, [math.inf] * size)]
    rows += [(n + 4, [None] + [0.0] * (size - 1)), (n + 5, []), (None, [0.5] * size), (3, rows[3][1]), (3, rows[4][1]), (n + 6, [1e30] * size)]
    return rows + [(n + 10 + i, [0.25] * size) for i in range(80)]


@pytest.mark.parametrize("size, k", [(64, 40), (4, 7), (1, 3)])
def test_equals_plain(spark, size, k):
    rows = some(size, size)
    df = spark.createDataFrame([(i, e, "clash", 1) for i, e in rows], SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in C.cluster(df, k=k, rounds=5, size=size).collect()), key=str)
    assert got == plain(rows, k, 5, size)


def test_few_and_no_vectors(spark):
    assert C.cluster(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, [1.0] * 64), (2, [1.0] * 64), (3, [-1.0] * 64)]
    df = spark.createDataFrame([(i, e, "", 0) for i, e in rows], SCHEMA)
    assert sorted(tuple(r) for r in C.cluster(df).collect()) == plain(rows, 40, 5, 64)


def test_search_is_exact_at_ties_and_large_values():
    draw = np.random.default_rng(1)
    for spread in (2, 300, C.LARGEST):
        cents = draw.integers(-spread, spread, (40, 64), endpoint=True)
        cents[7] = cents[3]
        x = np.concatenate([draw.integers(-spread, spread, (500, 64), endpoint=True), cents, (cents[:20] + cents[20:]) // 2])
        found, distance, tried = C.Search(cents).nearest(x)
        every = ((x[:, None, :] - cents[None]) ** 2).sum(2)
        assert (found == every.argmin(1)).all() and (distance == every.min(1)).all()
        assert tried < len(x) * len(cents)


def test_bounds_spare_most_distances():
    draw = np.random.default_rng(2)
    middle = draw.normal(0, 100, (40, 64)) + draw.normal(0, 100, (40, 1))
    x = np.floor(middle[draw.integers(0, 40, 4000)] + draw.normal(0, 10, (4000, 64))).astype(np.int64)
    assert C.Search(np.floor(middle).astype(np.int64)).nearest(x)[2] < 0.2 * x.shape[0] * 40
