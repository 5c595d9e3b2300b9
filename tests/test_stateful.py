"""Streams with state against batch computations over all rows so far."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.session import scratch_path
from tessera.streaming import ingest as S
from tessera.streaming import stateful as W

SCHEMA = "id int, g string, v double, ts timestamp"
T0 = dt.datetime(2024, 6, 1)


def add(spark, path, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    df.coalesce(1).write.mode("append").parquet(path)
    return df.schema


def wait(*queries):
    for q in queries:
        q.awaitTermination()


def rules():
    return [Q.unique("id"), Q.in_range("v", min_val=0), Q.no_duplicates(["g", "id"]), Q.not_null("v", threshold=0.1), Q.in_range("v"),
            Q.column_exists(["id"]), Q.custom("some", F.max("v") > 5, "no large value"), Q.row_count(max_count=50)]


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_rules_over_a_stream_and_its_restart(spark):
    rng = random.Random(1)
    path, state_path = scratch_path(spark, "in"), scratch_path(spark, "state")
    rows, schema = [], None
    for part in range(3):
        new = [(rng.choice([None, rng.randrange(40)]), rng.choice(["a", "a", None]), rng.choice([None, float("nan"), rng.uniform(-1, 9)]), T0) for _ in range(30)]
        rows += new
        schema = add(spark, path, new)
        stream = S.read_files(spark, path, schema, format="parquet")
        state = W.RuleState(stream, rules(), state_path)  # a new process each time
        wait(*state.start(stream))
        same(state.report(), Q.report_frame(spark.createDataFrame(rows, SCHEMA), rules()))
    wait(*state.start(stream))  # nothing new
    same(state.report(), Q.report_frame(spark.createDataFrame(rows, SCHEMA), rules()))
    kept = spark.read.parquet(f"{state_path}/keys")
    assert kept.where("n < 2").count() == 0 < kept.count()  # keys seen once stay in the state store


def test_report_before_the_first_row_and_refused_rules(spark):
    empty = spark.createDataFrame([], SCHEMA)
    report = {r["rule"]: (r["status"], r["failed_count"], r["total_count"]) for r in W.RuleState(empty, rules(), scratch_path(spark, "none")).report().collect()}
    assert report == {r["rule"]: (r["status"], r["failed_count"], r["total_count"]) for r in Q.report_frame(empty, rules()).collect()}
    for rule in (Q.referential("id", empty, "id"), Q.custom("job", lambda df: True, "x")):
        with pytest.raises(ValueError):
            W.RuleState(empty, [rule], scratch_path(spark, "none"))


def test_late_rows_are_kept_apart(spark):
    path, out = scratch_path(spark, "late_in"), scratch_path(spark, "late_out")
    parts = [[0, 100, 1000], [990, 2000, 399, 400, None], [1400, 1399, 50]]
    want = {0: [], 1: [399, None], 2: [1399, 50]}
    for k, part in enumerate(parts):
        schema = add(spark, path, [(t, "x", 0.0, None if t is None else T0 + dt.timedelta(seconds=t)) for t in part])
        stream = S.read_files(spark, path, schema, format="parquet", max_files_per_trigger=1)
        wait(W.split_late(stream, "ts", 600, out))  # started anew for each file
        late = W.stored(spark, f"{out}/late", SCHEMA + ", batch_id bigint")
        got = {b: sorted((r["id"] for r in late.where(F.col("batch_id") == b).collect()), key=str) for b in range(k + 1)}
        assert got == {b: sorted(w, key=str) for b, w in want.items() if b <= k}
    on_time = spark.read.parquet(f"{out}/on_time")
    assert on_time.count() + late.count() == sum(map(len, parts))


@pytest.mark.parametrize("how", ["left_outer", "inner"])
def test_interval_join_of_two_streams(spark, how):
    rng = random.Random(4)
    paths, sides, kept = [scratch_path(spark, "a"), scratch_path(spark, "b")], [], []
    for path in paths:
        own = [(k, rng.choice(["u", "u", "v", None]), 0.0, T0 + dt.timedelta(seconds=60 * t + rng.random())) for k, t in enumerate(sorted(rng.sample(range(2000), 60)))]
        for at in range(0, 60, 20):
            schema = add(spark, path, own[at : at + 20])
        sides.append(S.read_files(spark, path, schema, format="parquet", max_files_per_trigger=1))
        kept.append(own)
    out = scratch_path(spark, "joined")
    joined = W.interval_join(*sides, "g", "ts", "ts", "2 hours", "1 minute", how).select("id", "r_id")
    q = joined.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "ck"))
    wait(q.trigger(availableNow=True).start())
    left, right = kept
    shut = min(left[-1][3], right[-1][3]) - dt.timedelta(minutes=1)
    want, width = [], dt.timedelta(hours=2)
    for k, g, _, t in left:
        near = [r[0] for r in right if g is not None and r[1] == g and t <= r[3] <= t + width]
        want += [(k, r) for r in near]
        if not near and how == "left_outer" and t + width < shut:
            want.append((k, None))
    assert sorted(map(tuple, W.stored(spark, out, "id int, r_id int").collect()), key=str) == sorted(want, key=str) and len(want) > 20
    with pytest.raises(ValueError):
        W.interval_join(*sides, "g", "ts", "ts", how="full_outer")
