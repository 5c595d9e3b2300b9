"""Inclusions and minimal keys against all pairs and all sets."""

import datetime as dt
import itertools
import random
from decimal import Decimal

import pytest

from tessera.operators import dependencies as D


def test_inclusions_are_those_of_all_pairs(spark):
    rng = random.Random(1)
    data = {
        "a": {"id": list(range(40)), "x.y": [rng.randrange(20) for _ in range(40)], "s": [rng.choice("pqr") for _ in range(40)], "none": [None] * 40},
        "b": {"a": [rng.choice([None, *range(10)]) for _ in range(70)], "s": [rng.choice(["p", "q", None]) for _ in range(70)],
              "d": [rng.choice([0.0, -0.0, 1.5]) for _ in range(70)]},
        "c": {"d": [0.0, 1.5, 2.5], "s": ["p", "p", "1.5"]},
    }
    types = {"id": "int", "x.y": "long", "s": "string", "none": "int", "a": "smallint", "d": "double"}
    tables = {
        t: spark.createDataFrame(list(zip(*own.values())), ", ".join(f"`{c}` {types[c]}" for c in own)) for t, own in data.items()
    }
    got = {tuple(r) for r in D.inclusions(tables).collect()}
    kind = {"int": "i", "long": "i", "smallint": "i", "string": "s", "double": "f"}
    want = set()
    cells = [(t, c, kind[types[c]], [v for v in own if v is not None]) for t, cs in data.items() for c, own in cs.items()]
    for (t, c, k, v), (u, d, m, w) in itertools.permutations(cells, 2):
        both = set(v) & set(w)
        if k == m and both:
            want.add((t, c, u, d, len(set(v)), len(both), set(v) <= set(w), len(w) == len(set(w))))
    assert got == want
    keys = {tuple(r)[:4] for r in D.foreign_keys(spark.createDataFrame(list(got), D.inclusions(tables).schema)).collect()}
    assert keys == {("b", "a", "a", "id"), ("b", "d", "c", "d")}


def test_more_columns_than_a_mask_holds(spark):
    wide = spark.createDataFrame([tuple(range(70)), tuple(range(1, 71))], ", ".join(f"c{i} int" for i in range(70)))
    got = {(r["dependent_column"], r["referenced_column"]): r["matched"] for r in D.inclusions({"w": wide}).collect()}
    assert got == {(f"c{i}", f"c{j}"): 1 for i in range(70) for j in (i - 1, i + 1) if 0 <= j < 70}


def test_kinds_are_apart_and_nested_columns_left_out(spark):
    rows = [(1, 1.0, "1", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), True, Decimal("1"), [1])]
    df = spark.createDataFrame(rows, "i int, f float, s string, d date, t timestamp_ntz, b boolean, m decimal(5,2), a array<int>")
    assert D.inclusions({"x": df}).count() == 0
    wider = df.selectExpr("CAST(i AS bigint) AS i2", "CAST(f AS double) AS f2", "CAST(m AS decimal(20,4)) AS m2")
    assert {(r[1], r[3]) for r in D.inclusions({"x": df, "y": wider}).collect() if r[0] == "x"} == {("i", "i2"), ("f", "f2"), ("m", "m2")}
    with pytest.raises(ValueError):
        D.inclusions({"x": df.select("a")})


def brute(rows, names, most):
    keys = []
    for k in range(1, most + 1):
        for s in itertools.combinations(range(len(names)), k):
            if not any(set(t) < set(s) for t in keys) and len({tuple(r[i] for i in s) for r in rows}) == len(rows):
                keys.append(s)
    return {tuple(names[i] for i in s) for s in keys}


@pytest.mark.parametrize("seed", range(4))
def test_minimal_keys_are_those_of_all_sets(spark, seed):
    rng = random.Random(seed)
    sizes = [2, 3, 9, 30, 30, 200]
    rows = list({tuple(None if rng.random() < 0.05 else rng.randrange(n) for n in sizes) for _ in range(60 + 40 * seed)})
    names = ["a", "b b", "c", "d.d", "e", "f"]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` int" for n in names))
    got = [(tuple(r["key_columns"]), r["size"]) for r in D.minimal_keys(df, part=4).collect()]
    assert {k for k, _ in got} == brute(rows, names, 3) and len(got) == len({k for k, _ in got}) and all(len(k) == n for k, n in got)
    assert {tuple(r["key_columns"]) for r in D.minimal_keys(df, ["f", "a", "c"], most=2).collect()} == brute([(r[5], r[0], r[2]) for r in rows], ["f", "a", "c"], 2)


def test_keys_of_empty_and_repeated_rows(spark):
    none = spark.createDataFrame([], "a int, b string")
    assert sorted(tuple(r["key_columns"]) for r in D.minimal_keys(none).collect()) == [("a",), ("b",)]
    same = spark.createDataFrame([(1, None), (1, None)], "a int, b string")
    assert D.minimal_keys(same).count() == 0
    odd = spark.createDataFrame([(0.0, 1), (-0.0, 2), (float("nan"), 3)], "a double, b int")
    assert [tuple(r["key_columns"]) for r in D.minimal_keys(odd).collect()] == [("b",)]


def test_all_rows_are_shuffled_per_shared_subset(spark, monkeypatch):
    """Candidates that hardly repeat are judged on the rows of a few subsets, not each on all rows."""
    rng = random.Random(5)
    n = 6000
    rows = [(i % 1500, rng.randrange(2000), rng.randrange(100), rng.randrange(400), rng.choice([0.5, -0.0, 0.0, None, float("nan")]), rng.choice("pqr"))
            for i in range(n)]
    rows.append((*rows[0][:2], 100, 400, 7.5, "s"))
    names = ["a", "b", "c", "d", "e", "f"]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, e double, f string")
    passes = []
    whole = D._rows_repeating
    monkeypatch.setattr(D, "_rows_repeating", lambda rows, cells, sets: passes.extend(sets) or whole(rows, cells, sets))
    got = {tuple(r["key_columns"]) for r in D.minimal_keys(df, part=64).collect()}
    same = [tuple(v if v == v else "NaN" for v in r) for r in rows]
    assert got == brute(same, names, 3)
    triples = len(list(itertools.combinations(names, 3)))
    assert 0 < len(passes) < triples, passes
    passes.clear()
    assert {tuple(r["key_columns"]) for r in D.minimal_keys(df).collect()} == got and not passes  # a small table is its own part
