"""Lattice hashing against all pairs."""

import itertools

import numpy as np
import pytest

from tessera.llm.op3_lattice import NEIGHBOURS, near_duplicates, nearest_e8

SCHEMA = "vec_id long, embedding array<float>, label int, cell long, rep long"


def vectors(seed=3, dim=64):
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=dim) for _ in range(150)]
    for noise, size in ((0.25, 40), (0.3, 25), (0.05, 12)):
        center = rng.normal(size=dim)
        rows += [center + noise * rng.normal(size=dim) for _ in range(size)]
    rows += [rows[0].copy(), rows[0].copy(), 3 * rows[1]]
    return [r.astype(np.float32) for r in rows]


def brute(rows, bound=0.95):
    ids = [i for i, v in rows]
    ok = [v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v) for _, v in rows]
    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if o else None for (_, v), o in zip(rows, ok)]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= bound:
            links[i] += 1
            links[j] += 1
            a, b = sorted((find(i), find(j)), key=lambda k: ids[k])
            parent[b] = a
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return sorted((ids[i], links[i], least[find(i)], ids[i] == least[find(i)]) for i in range(len(rows)))


@pytest.mark.parametrize("block", [2048, 7])
def test_against_all_pairs(spark, block):
    rows = [(900 - 3 * k, [float(x) for x in v]) for k, v in enumerate(vectors())]
    rows += [(1, None), (2, [0.0] * 64), (4, [float("nan")] * 64), (5, [None] * 64), (7, [float("inf")] + [1.0] * 63), (8, [1.0, 2.0]), (10, [2.0, 4.0]), (11, [])]
    df = spark.createDataFrame([(i, v, 0, 1, 1) for i, v in rows], SCHEMA)
    got = sorted(tuple(r) for r in near_duplicates(df, block=block).collect())
    assert got == brute([(i, None if v is None else v) for i, v in rows])


def test_null_ids_and_no_rows(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 0, 1, 1), (3, [1.0, 0.0], 0, 1, 1), (3, [1.0, 0.0], 0, 1, 1)], SCHEMA)
    assert sorted(map(tuple, near_duplicates(df).collect()), key=str) == [(3, 1, 3, True), (3, 1, 3, True), (None, 0, None, True)]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_nearest_lattice_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 8)) * 3
    p = nearest_e8(x)
    doubled = np.rint(2 * p)
    assert np.allclose(2 * p, doubled) and ((doubled % 2 == doubled[:, :1] % 2).all()) and (p.sum(1) % 2 == 0).all()
    own = ((x - p) ** 2).sum(1)
    assert len(NEIGHBOURS) == 240 and all((own <= ((x - p - v) ** 2).sum(1) + 1e-9).all() for v in NEIGHBOURS) and own.max() <= 1 + 1e-9


def test_ids_that_come_with_several_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.99, 0.05]), (3, [0.05, 0.99]), (4, [-1.0, 0.0]), (4, [-1.0, 0.0])]
    got = sorted(tuple(r)[:3] for r in near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 4), (4, 1, 4)]
