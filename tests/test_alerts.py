"""Alert rules against a plain evaluation at every grid point."""

import datetime as dt
import math
import random

import pytest

from tessera.operators import alerts as A

T0 = dt.datetime(2024, 3, 1, 10, 0)
SCHEMA = "series string, ts timestamp_ntz, value double"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def frame(spark, rows):
    return spark.createDataFrame([(s, at(t), v) for s, t, v in rows], SCHEMA)


def plain_increase(rows, t, width):
    """Growth over (t - width, t] of one series' (time, value)."""
    own, total, seen = sorted(rows), 0.0, False
    for k, (when, v) in enumerate(own):
        if t - width < when <= t:
            seen = True
            if k:
                total += v - own[k - 1][1] if v >= own[k - 1][1] else v
    return total if seen else None


def plain_alerts(points, hold, now, step=60):
    """Alerts from {grid second: value} at which a condition holds."""
    out, run = [], []
    for t in [*sorted(p for p in points if p <= now), math.inf]:
        if run and t != run[-1] + step:
            start, end = run[0], run[-1]
            wait = math.ceil(hold / step) * step
            fired = start + wait if end - start >= wait else None
            resolved = end + step if end < now else None
            state = ("firing" if fired is not None else "pending") if resolved is None else ("resolved" if fired is not None else "cancelled")
            out.append((start, fired, resolved, state, len(run), max(points[p] for p in run)))
            run = []
        run.append(t)
    return out


def seconds(t):
    return None if t is None else int((t - T0).total_seconds())


def got(df):
    return sorted(
        (r["series"], seconds(r["started_at"]), seconds(r["fired_at"]), seconds(r["resolved_at"]), r["state"], r["evaluations"], r["peak"])
        for r in df.collect()
    )


@pytest.mark.parametrize("seed", range(3))
def test_increase_alerts(spark, seed):
    rng = random.Random(seed)
    rows = []
    for s, gap in (("hot", 40), ("calm", 500), ("once", 10**6)):
        t, v = rng.randrange(3600), 0.0
        while t < 6 * 3600:
            rows.append((s, t, v))
            t += rng.randrange(1, 2 * gap)
            v = 0.0 if rng.random() < 0.05 else v + rng.choice([0, 0, 1, 2])
    now = 5 * 3600 + 30
    for threshold, width, hold in ((0, 300, 60), (3, 300, 150), (1, 60, 0)):
        want = []
        for s in ("hot", "calm", "once"):
            own = [(t, v) for x, t, v in rows if x == s]
            grid = {t: plain_increase(own, t, width) for t in range(0, 7 * 3600, 60)}
            holds = {t: i for t, i in grid.items() if i is not None and i > threshold}
            want += [(s, *a) for a in plain_alerts(holds, hold, now // 60 * 60)]
        mine = A.increase_alerts(frame(spark, rows), ["series"], at(now), threshold, width, hold)
        assert got(mine) == sorted(want) and want


def test_resets_nulls_and_samples_of_one_time(spark):
    rows = [("a", 0, 5.0), ("a", 10, 7.0), ("a", 20, 1.0), ("a", 30, None), ("a", 40, float("nan")), ("a", 7200, 4.0), ("a", 7200, 3.0),
            (None, 5, 1.0), (None, 9000, 1.5)]
    deltas = {(r["series"], seconds(r["ts"]), r["delta"]) for r in A.counter_deltas(frame(spark, rows), ["series"]).collect()}
    assert deltas == {("a", 0, 0.0), ("a", 10, 2.0), ("a", 20, 1.0), ("a", 7200, 2.0), ("a", 7200, 1.0), (None, 5, 0.0), (None, 9000, 0.5)}


def test_time_buckets_change_nothing(spark):
    rng = random.Random(7)
    rows = [(rng.choice("ab"), rng.randrange(50_000), float(rng.randrange(50))) for _ in range(300)]
    results = [sorted(map(tuple, A.counter_deltas(frame(spark, rows), ["series"], bucket_seconds=b).collect())) for b in (7, 900, 10**6)]
    assert results[0] == results[1] == results[2] and len(results[0]) == 300


@pytest.mark.parametrize("seed", range(2))
def test_threshold_alerts(spark, seed):
    rng = random.Random(seed)
    rows = [(s, t, float(rng.randrange(10))) for s in "ab" for t in sorted(rng.sample(range(20_000), 90))]
    now, look = 19_000, 300
    want = []
    for s in "ab":
        own = sorted((t, v) for x, t, v in rows if x == s)
        holds = {}
        for g in range(0, 21_000, 60):
            seen = [v for t, v in own if g - look <= t <= g]
            if seen and seen[-1] > 3:
                holds[g] = seen[-1]
        want += [(s, *a) for a in plain_alerts(holds, 300, now // 60 * 60)]
    mine = A.threshold_alerts(frame(spark, rows), ["series"], at(now), threshold=3, hold_seconds=300, lookback_seconds=look)
    assert got(mine) == sorted(want) and {w[4] for w in want} >= {"resolved", "cancelled"}


def test_edges(spark):
    none = frame(spark, [])
    assert got(A.increase_alerts(none, ["series"], T0)) == [] == got(A.threshold_alerts(none, ["series"], T0))
    with pytest.raises(ValueError):
        A.counter_increase(none, ["series"], 90, 60)
    clashing = frame(spark, [("x", 0, 0.0), ("x", 61, 9.0)]).withColumnsRenamed({"series": "at", "value": "increase"})
    out = A.increase_alerts(clashing.withColumnRenamed("at", "s.name"), ["s.name"], at(100), value="increase").collect()
    assert [(r["s.name"], r["state"]) for r in out] == []  # the first evaluation that sees it is at 120
    out = A.increase_alerts(clashing.withColumnRenamed("at", "s.name"), ["s.name"], at(120), value="increase").collect()
    assert [(r["s.name"], r["state"], r["peak"]) for r in out] == [("x", "pending", 9.0)]
