"""The clustered layout: same rows, codes as defined, few files for a box."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import layout as L
from tessera.session import scratch_path


def test_codes_interleave_bits(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(64), rng.randrange(64), rng.randrange(64)) for _ in range(50)]
    df = spark.createDataFrame(rows, "a long, b long, c long").select("*", L.morton([F.col(c) for c in "abc"]).alias("m"))
    for a, b, c, m in df.collect():
        want = "".join(x + y + z for x, y, z in zip(f"{a:06b}", f"{b:06b}", f"{c:06b}"))
        assert m == int(want, 2)


def test_same_rows_in_bounded_files_that_a_box_touches_few_of(spark):
    rng = random.Random(2)
    start = dt.date(2024, 1, 1)
    rows = [(rng.choice([None, "hot", "hot", f"é{rng.randrange(999)}"]), int(rng.paretovariate(0.3)) % 10**9, start + dt.timedelta(days=rng.randrange(400)), k) for k in range(6000)]
    df = spark.createDataFrame(rows, "s string, `v x` long, d date, k int")
    path = scratch_path(spark, "near")
    L.rewrite(df, path, ["d", "v x"], file_rows=150)
    near = spark.read.parquet(path)
    assert sorted(map(str, near.collect())) == sorted(map(str, df.collect()))
    bounds = L.file_bounds(near, ["d", "v x"]).collect()
    assert max(r["n"] for r in bounds) <= 150 and 40 <= len(bounds) <= 120
    values = sorted(r[1] for r in rows)
    box = {"d": (start, start + dt.timedelta(days=40)), "v x": (values[0], values[600])}
    touched = L.files_touched(near, box).first()
    inside = df.where(F.col("d").between(*box["d"]) & F.col("`v x`").between(*box["v x"])).count()
    assert touched["touched"] * 4 <= touched["files"] and touched["rows"] >= inside > 0
    plain = scratch_path(spark, "plain")
    df.repartition(40).write.parquet(plain)
    assert L.files_touched(spark.read.parquet(plain), box).first()["touched"] == 40


def test_other_types_nulls_and_errors(spark):
    rows = [(True, "b", None, 1.5), (None, None, dt.datetime(2024, 1, 1), float("nan")), (False, "a", dt.datetime(1969, 1, 1), -1.0)] * 20
    df = spark.createDataFrame(rows, "b boolean, s string, t timestamp_ntz, f float")
    near = L.clustered(df, ["b", "s", "t", "f"], file_rows=7, bits=3)
    assert sorted(map(str, near.collect())) == sorted(map(str, df.collect()))
    strings = spark.createDataFrame([(c * 3,) for c in "zéaAm日"], "s string")
    got = [r["s"] for r in strings.select("s", L._number(strings, "s").alias("n")).orderBy("n").collect()]
    assert got == sorted((c * 3 for c in "zéaAm日"), key=str.encode)
    assert L.clustered(df.limit(0), ["f"]).count() == 0
    for columns, bits in (([], 4), (["f"], 63)):
        with pytest.raises(ValueError):
            L.clustered(df, columns, bits=bits)
    with pytest.raises(TypeError):
        L.clustered(df.select(F.array("f").alias("a")), ["a"])
