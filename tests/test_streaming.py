import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path
from tessera.streaming import ingest as S

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType()),
                       T.StructField("k", T.StringType())])


def _write_batches(spark, path):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(minutes=7 * i), f"k{i % 5}") for i in range(60)]
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").json(path)
    return rows


def test_windowed_counts_match_batch_for_closed_windows(spark):
    src = scratch_path(spark, "s_in")
    _write_batches(spark, src)
    stream = S.read_files(spark, src, SCHEMA, format="json")
    out = scratch_path(spark, "s_out")
    q = (S.hourly_counts(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "s_ck")).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r["hour"]: r["event_count"] for r in spark.read.parquet(out).collect()}
    batch = spark.read.schema(SCHEMA).json(src).groupBy(F.window("ts", "1 hour").start.alias("hour")).count()
    want = {r["hour"]: r["count"] for r in batch.collect()}
    # the watermark (one hour behind the latest event) closes all but the last two windows
    closed = sorted(want)[:-2]
    assert closed and set(closed) <= set(got) and all(want[h] == c for h, c in got.items())


def test_stream_dedup(spark):
    src = scratch_path(spark, "d_in")
    rows = [(1, dt.datetime(2024, 1, 1, 0, 0), "a"), (1, dt.datetime(2024, 1, 1, 0, 1), "a"),
            (2, dt.datetime(2024, 1, 1, 0, 2), "b")]
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").json(src)
    out = scratch_path(spark, "d_out")
    q = (S.dedup_on_key(S.read_files(spark, src, SCHEMA, format="json"), ["id"]).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", scratch_path(spark, "d_ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_foreach_batch_rules_and_upsert(spark):
    from tessera.operators import quality as Q
    from tessera.operators.versioned import VersionedTable

    src = scratch_path(spark, "v_in")
    rows = [(1, dt.datetime(2024, 1, 1), "a"), (2, dt.datetime(2024, 1, 1), None), (3, dt.datetime(2024, 1, 1), "c")]
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").json(src)
    good, bad, rep = scratch_path(spark, "good"), scratch_path(spark, "bad"), scratch_path(spark, "rep")
    q = S.validated_sink(S.read_files(spark, src, SCHEMA, format="json"), lambda b: [Q.not_null("k")],
                         good, bad, rep, scratch_path(spark, "v_ck"), bad_row=F.col("k").isNull())
    q.awaitTermination()
    assert spark.read.parquet(good).count() == 2 and spark.read.parquet(bad).count() == 1
    assert spark.read.parquet(rep).first()["failed_count"] == 1

    for _ in range(2):  # a batch that is run again replaces itself
        S.validated_batch(spark.createDataFrame(rows, SCHEMA), 0, lambda b: [Q.not_null("k")], good, bad, rep, F.col("k").isNull())
    assert spark.read.parquet(good).count() == 2 and spark.read.parquet(bad).count() == 1 and spark.read.parquet(rep).count() == 1

    t = VersionedTable(spark, scratch_path(spark, "up")).create(SCHEMA)
    ck = scratch_path(spark, "u_ck")
    for _ in range(2):  # a restart finds nothing new
        S.upsert_into(S.read_files(spark, src, SCHEMA, format="json"), t, ["id"], ck).awaitTermination()
    assert t.read().count() == 3 and t.current_version == 1


def test_two_streams_into_one_table(spark):
    from tessera.operators.versioned import VersionedTable

    t = VersionedTable(spark, scratch_path(spark, "two")).create(SCHEMA)
    for low in (1, 3):  # both number their batches from 0
        src = scratch_path(spark, f"two_in{low}")
        spark.createDataFrame([(i, dt.datetime(2024, 1, 1), "a") for i in (low, low + 1)], SCHEMA).write.json(src)
        S.upsert_into(S.read_files(spark, src, SCHEMA, format="json"), t, ["id"], scratch_path(spark, f"two_ck{low}")).awaitTermination()
    assert sorted(r["id"] for r in t.read().collect()) == [1, 2, 3, 4]
    # a new checkpoint reads the second source again as a new query: merged, not skipped
    S.upsert_into(S.read_files(spark, src, SCHEMA, format="json"), t, ["id"], scratch_path(spark, "two_ck_new")).awaitTermination()
    assert t.read().count() == 4 and t.current_version == 3
    # a crash between commit and checkpoint: the batch runs again, NULL keys and all
    last = t.commits()[-1]
    tag = (last["stream_query"], last["stream_batch"])
    t.merge(spark.createDataFrame([(None, dt.datetime(2024, 1, 1), "n")], SCHEMA), ["id"], stream=tag)
    assert t.read().count() == 4 and t.current_version == 3
