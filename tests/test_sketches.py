"""Stored sketches: accuracy, merging, and that only new days are read."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.operators import sketches as S
from tessera.session import scratch_path

D = [dt.date(2024, 5, k) for k in range(1, 8)]
KLL = "g string, n long, sketch binary, day date"
DISTINCT = "column_name string, n long, nulls long, sketch binary, day date"


def scanned(df):
    """The partition filters of a plan's file scans."""
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    return [(rng.choice(["hot", "hot", "b", None]), rng.choice([rng.gauss(0, 1), 1.0, None, float("nan")]), rng.choice(D)) for _ in range(8000)]


def by_day(spark, rows, schema="g string, v double, day date"):
    path = scratch_path(spark, "days")
    spark.createDataFrame(rows, schema).write.partitionBy("day").parquet(path)
    return spark.read.parquet(path)


def test_merged_quantiles_are_within_the_bound(spark, rows):
    df, path = by_day(spark, rows), scratch_path(spark, "kll")
    assert S.refresh(df, path, KLL, lambda x: S.quantile_sketches(x, "v", ["g"], k=200)) == D
    stored = spark.read.parquet(path)
    values = defaultdict(list)
    for g, v, d in rows:
        if v is not None and v == v and d <= D[3]:
            values[g].append(v)
    out = S.merged_quantiles(S.between(stored, D[0], D[3]), ["g"], (0.0, 0.25, 0.5, 0.95, 1.0)).collect()
    assert len(out) == 15
    for r in out:
        own = values[r["g"]]
        below, upto = sum(x < r["value"] for x in own) / len(own), sum(x <= r["value"] for x in own) / len(own)
        assert r["n"] == len(own) and below - 0.05 <= r["quantile"] <= upto + 0.05  # four times what k = 200 promises
    errors = S.rank_error(S.between(df, D[0], D[3]), spark.createDataFrame(out), "v", ["g"]).collect()
    assert len(errors) == 15 and all(0 <= r["error"] <= 0.05 for r in errors)


def test_rank_error_is_exact(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 2, 2, 5]] + [("a", None)], "g string, v double")
    asked = spark.createDataFrame([("a", 0.5, 2.0, 5), ("a", 0.9, 2.0, 5), ("a", 0.1, 5.0, 5)], "g string, quantile double, value double, n long")
    got = {(r["quantile"], r["value"]): round(r["error"], 9) for r in S.rank_error(df, asked, "v", ["g"]).collect()}
    assert got == {(0.5, 2.0): 0.0, (0.9, 2.0): 0.1, (0.1, 5.0): 0.7}


def test_only_new_days_are_read(spark, rows):
    df, path = by_day(spark, rows), scratch_path(spark, "distinct")
    seen = []

    def build(source):
        seen.append(source)
        return S.distinct_sketches(source, ["g", "v"])

    assert S.refresh(df.where(F.col("day") < F.lit(D[5])), path, DISTINCT, build) == D[:5]
    assert S.refresh(df.where(F.col("day") < F.lit(D[6])), path, DISTINCT, build) == D[5:6]
    files = {f for f in seen[1].select("_metadata.file_path").distinct().toPandas()["file_path"]}
    assert files and all("day=2024-05-06" in f for f in files)
    assert any("2024-05-06" in x for x in scanned(seen[1])) and not any("2024-05-05" in x for x in scanned(seen[1]))
    assert S.refresh(df.where(F.col("day") < F.lit(D[6])), path, DISTINCT, build) == [] and len(seen) == 2
    # a day that got more rows is replaced, not added to
    more = df.unionByName(spark.createDataFrame([("new", 7.5, D[0])], df.schema))
    before = S.merged_distinct(spark.read.parquet(path)).collect()
    assert S.refresh(more.where(F.col("day") < F.lit(D[6])), path, DISTINCT, build, again=[D[0]]) == [D[0]]
    after = {r["column_name"]: r for r in S.merged_distinct(spark.read.parquet(path)).collect()}
    for r in before:
        assert after[r["column_name"]]["n"] == r["n"] + 1 and after[r["column_name"]]["distinct"] == r["distinct"] + 1


@pytest.mark.parametrize("kind", ["theta", "hll"])
def test_distinct_counts_of_all_types(spark, kind):
    rng = random.Random(3)
    schema = "i int, l long, t tinyint, s string, d double, dt date, ts timestamp_ntz, b boolean, dec decimal(10,2), a array<int>, day date"
    rows = []
    for _ in range(500):
        k = rng.randrange(100)
        full = [k, k * 10**12, k, f"é{k}", k / 7, D[k % 7], dt.datetime(2024, 1, 1, k % 24), k % 2 == 0, None, [k, None]]
        rows.append((*[None if rng.random() < 0.1 else x for x in full], rng.choice(D)))
    df = spark.createDataFrame(rows, schema)
    names = df.columns[:-1]
    got = {r["column_name"]: r for r in S.merged_distinct(S.distinct_sketches(df, names, kind=kind), kind).collect()}
    for i, c in enumerate(names):
        exact = len({str(r[i]) for r in rows if r[i] is not None})
        assert abs(got[c]["distinct"] - exact) <= (0 if kind == "theta" else 0.05 * exact)
        assert (got[c]["n"], got[c]["nulls"]) == (500, sum(r[i] is None for r in rows))


def test_overlap_of_periods(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(300) + 200 * (d > D[3]), d) for d in D for _ in range(200)] + [(None, D[0])]
    sketches = S.distinct_sketches(spark.createDataFrame(rows, "v long, day date"), ["v"])
    r = S.distinct_overlap(S.between(sketches, D[0], D[3]), S.between(sketches, D[4], D[6])).first()
    a, b = {v for v, d in rows if d <= D[3] and v is not None}, {v for v, d in rows if d > D[3]}
    assert tuple(r)[1:] == (len(a), len(b), len(a & b), len(a - b), len(b - a), len(a | b))


def test_empty(spark):
    df, path = spark.createDataFrame([], "g string, v double, day date"), scratch_path(spark, "none")
    assert S.refresh(df, path, KLL, lambda x: S.quantile_sketches(x, "v", ["g"])) == []
    assert S.merged_quantiles(S.sketch_table(spark, path, KLL), ["g"]).count() == 0
    only_null = spark.createDataFrame([("a", None, D[0])], "g string, v double, day date")
    assert S.quantile_sketches(only_null, "v", ["g"]).count() == 0
    assert S.merged_distinct(S.distinct_sketches(only_null, ["v"])).first()["distinct"] == 0
