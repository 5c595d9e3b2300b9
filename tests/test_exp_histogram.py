"""Exponential histograms against exact counting of values between bounds."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tessera.operators import exp_histogram as X


def bucket_of(v, scale):
    """The bucket by exact arithmetic: 2^i < v^(2^scale) <= 2^(i + 1)."""
    exact = Fraction(v) ** (2**scale)
    i = exact.numerator.bit_length() - exact.denominator.bit_length() - 1
    while exact > Fraction(2) ** (i + 1):
        i += 1
    while exact <= Fraction(2) ** i:
        i -= 1
    return i


def plain(values, size, scale=X.SCALE):
    sides = {s: sorted(bucket_of(abs(v), scale) for v in values if v and (v > 0) == (s > 0)) for s in (1, -1)}
    d = 0
    while any(own and (own[-1] >> d) - (own[0] >> d) >= size for own in sides.values()):
        d += 1
    out = {(scale - d, 0, 0): values.count(0.0)} if 0.0 in values else {}
    for s, own in sides.items():
        for i in own:
            key = (scale - d, s, i >> d)
            out[key] = out.get(key, 0) + 1
    return out


def counted(df, groups=()):
    return {(r["scale"], r["sign"], r["idx"]): r["n"] for r in X.buckets(df, groups).collect()}


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "v double")


def test_buckets_of_values_on_and_beside_bounds(spark):
    values = [2.0**k for k in range(-30, 31)] + [3.0, 1e-300, 1e300, 5e-324, 0.1, 0.3, 1 / 3]
    values += [math.nextafter(2.0**k, d) for k in (-3, 0, 1, 29) for d in (0, math.inf)]
    for scale in (0, 3):
        got = {r["v"]: r["b"] for r in frame(spark, values).select("v", X.bucket(F.col("v"), scale).alias("b")).collect()}
        assert got == {v: bucket_of(v, scale) for v in values}
    edges = [b * 2.0**k for b in X.bounds(5) for k in (-7, 0, 12)]
    got = {r["v"]: r["b"] for r in frame(spark, edges).select("v", X.bucket(F.col("v"), 5).alias("b")).collect()}
    for v, b in got.items():  # doubles nearest to the bounds belong to the bucket below, as the bounds are compared as doubles
        assert b == round(math.log2(v) * 32) - 1


@pytest.mark.parametrize("seed", range(3))
def test_counts_and_merges_in_any_order(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([rng.lognormvariate(0, 2 + seed), -rng.expovariate(1), 0.0, float(rng.randrange(1, 9))]) for _ in range(400)]
    size = (6, 20, 160)[seed]
    want = plain(values, size)
    assert counted(X.build(frame(spark, values), "v", size=size)) == want
    cuts = sorted(rng.sample(range(400), 3))
    parts = [X.build(frame(spark, values[a:b]), "v", size=size) for a, b in zip([0, *cuts], [*cuts, 400])]
    left = parts[0]
    for p in parts[1:]:
        left = X.merge(left.unionByName(p), size=size)
    right = X.merge(parts[0].unionByName(X.merge(X.merge(parts[3].unionByName(parts[2]), size=size).unionByName(parts[1]), size=size)), size=size)
    assert counted(left) == counted(right) == want
    a, b = left.first(), right.first()
    assert (a["count"], a["zero_count"], a["min"], a["max"]) == (b["count"], b["zero_count"], b["min"], b["max"]) == (400, values.count(0.0), min(values), max(values))
    assert a["sum"] == pytest.approx(math.fsum(values)) and len(a["counts"]) <= size and len(a["negative_counts"]) <= size


def test_groups_nulls_and_odd_values(spark):
    rows = [("a", 1.0), ("a", None), (None, 0.0), (None, float("nan")), ("b", float("inf")), ("c d", -2.0), ("c d", -0.0)]
    df = spark.createDataFrame(rows, "`g.x` string, count double")
    out = {r["g.x"]: r for r in X.merge(X.build(df, "count", ["g.x"]), ["g.x"]).collect()}
    assert set(out) == {"a", None, "c d"}  # a group without finite values has no histogram
    assert (out["a"]["offset"], out["a"]["counts"], out["a"]["negative_counts"], out["a"]["zero_count"]) == (-1, [1], [], 0)
    assert (out["c d"]["negative_counts"], out["c d"]["zero_count"], out["c d"]["offset"]) == ([1], 1, None)
    assert X.build(df.limit(0), "count", ["g.x"]).count() == 0 == X.quantiles(X.build(df.limit(0), "count")).count()
    with pytest.raises(ValueError):
        X.build(df, "count", scale=11)


@pytest.mark.parametrize("seed", range(2))
def test_quantiles_are_within_a_bucket(spark, seed):
    rng = random.Random(seed)
    values = sorted(rng.choice([rng.lognormvariate(0, 1), -rng.lognormvariate(1, 1), 0.0]) for _ in range(1000))
    got = {r["quantile"]: r["value"] for r in X.quantiles(X.build(frame(spark, values), "v"), wanted=(0.0, 0.01, 0.3, 0.5, 0.9, 0.99, 1.0)).collect()}
    assert got[0.0] == values[0] and got[1.0] == values[-1]
    for q, v in got.items():
        exact = values[max(0, math.ceil(q * 1000) - 1)]
        assert v == 0 if exact == 0 else 1 / 1.0443 <= v / exact <= 1.0443  # the width of a bucket at scale 4
