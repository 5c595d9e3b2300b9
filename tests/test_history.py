"""Validity intervals against a replay of the snapshots."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import history as H

KEY, SCHEMA = ["k.1", "k2"], "`k.1` string, k2 int, a string, `b c` double"
TIMES = list(range(10, 90, 10))


def snapshots(seed):
    """{time: {key: row}}; rows change, go, come back; one snapshot is empty."""
    rng = random.Random(seed)
    keys = [(rng.choice(["x", "y", None]), k) for k in range(12)] + [("x", None)]
    state, out = {}, {}
    for t in TIMES:
        for k in keys:
            if rng.random() < 0.4:
                state[k] = (rng.choice(["p", "q", None]), rng.choice([1.0, None]))
            elif rng.random() < 0.2:
                state.pop(k, None)
        out[t] = {} if t == 50 and seed else dict(state)
    return out


def plain(snaps):
    out, open_ = [], {}
    for t in sorted(snaps):
        for k in list(open_):
            if snaps[t].get(k) != open_[k][0]:
                row, since = open_.pop(k)
                out.append((*k, *row, since, t))
        for k, row in snaps[t].items():
            open_.setdefault(k, (row, t))
    return sorted(out + [(*k, *row, since, None) for k, (row, since) in open_.items()], key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, snaps):
    rows = [(t, *k, *row) for t, own in snaps.items() for k, row in own.items()]
    return spark.createDataFrame(rows, f"at int, {SCHEMA}")


def times(spark):
    return spark.createDataFrame([(t,) for t in TIMES], "t int")


@pytest.mark.parametrize("seed", range(3))
def test_intervals_states_and_differences(spark, seed):
    snaps = snapshots(seed)
    history = H.from_snapshots(frame(spark, snaps), KEY, "at", times(spark)).select("`k.1`", "k2", "a", "`b c`", H.FROM, H.TO).cache()
    assert rows_of(history) == plain(snaps)
    for t, at in ((10, 10), (45, 40), (50, 50), (1000, 80), (5, None)):
        assert rows_of(H.as_of(history, F.lit(t))) == sorted([(*k, *row) for k, row in snaps.get(at, {}).items()], key=str)
    for t, u in ((10, 80), (40, 60), (60, 40), (5, 30), (30, 30)):
        a, b = snaps.get(t, {}), snaps.get(u, {})
        want = {k: (a.get(k), b.get(k)) for k in {*a, *b} if a.get(k) != b.get(k)}
        got = {(r["k.1"], r["k2"]): (r["before"] and tuple(r["before"]), r["after"] and tuple(r["after"]), r["change"]) for r in H.diff(history, KEY, F.lit(t), F.lit(u)).collect()}
        assert {k: v[:2] for k, v in got.items()} == want
        assert all(v[2] == (H.INSERT if v[0] is None else H.DELETE if v[1] is None else H.UPDATE) for v in got.values())
    want = []
    for t, u in zip([None, *TIMES], TIMES):
        a, b = snaps.get(t, {}), snaps[u]
        for k in {*a, *b}:
            if a.get(k) != b.get(k):
                want.append((*k, u, H.INSERT if k not in a else H.DELETE if k not in b else H.UPDATE, *(b.get(k) or a[k])))
    assert rows_of(H.changes(history, KEY)) == sorted(want, key=str)


def test_one_snapshot_at_a_time(spark):
    snaps = snapshots(1)
    first = frame(spark, {t: own for t, own in snaps.items() if t == 10})
    history = H.from_snapshots(first, KEY, "at").select("`k.1`", "k2", "a", "`b c`", H.FROM, H.TO)
    done = {10: snaps[10]}
    for t in TIMES[1:]:
        done[t] = snaps[t]
        own = [(*k, *row) for k, row in snaps[t].items()]
        history = H.extend(history, spark.createDataFrame(own, SCHEMA), KEY, F.lit(t))
        history = spark.createDataFrame(history.collect(), history.schema)  # as if stored
        assert rows_of(history) == plain(done)


def test_a_key_twice_in_a_snapshot_raises(spark):
    twice = spark.createDataFrame([(1, "a", 1, "x", 1.0), (1, "a", 1, "y", 1.0)], f"at int, {SCHEMA}")
    with pytest.raises(Exception, match="more than once"):
        H.from_snapshots(twice, KEY, "at").collect()
    history = H.from_snapshots(twice.limit(1), KEY, "at")
    with pytest.raises(Exception, match="more than once"):
        H.extend(history, twice.drop("at"), KEY, F.lit(2)).collect()


def test_empty_and_key_only_tables(spark):
    none = spark.createDataFrame([], f"at int, {SCHEMA}")
    assert H.from_snapshots(none, KEY, "at").count() == 0 == H.changes(H.from_snapshots(none, KEY, "at"), KEY).count()
    keys = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "b")], "at int, k string")
    history = H.from_snapshots(keys, ["k"], "at")
    assert rows_of(history) == [("a", 1, 3), ("b", 2, None)]
    assert rows_of(H.extend(history, keys.limit(0).drop("at"), ["k"], F.lit(9))) == [("a", 1, 3), ("b", 2, 9)]
    assert [(r["k"], r["change"]) for r in H.diff(history, ["k"], F.lit(1), F.lit(3)).orderBy("k").collect()] == [("a", "delete"), ("b", "insert")]
