"""Whole jobs: batch ingest, stream ingest, table maintenance, the end-to-end
ETL run, and their registered queries."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import metrics as M
from tessera.operators import quality as Q
from tessera.operators import transforms as X
from tessera.operators.versioned import VersionedTable
from tessera.plans.registry import register, table
from tessera.session import scratch_path
from tessera.sources import io
from tessera.streaming import ingest as S

FIXED_NOW = "2024-01-31 00:00:00"


def batch_ingest(spark: SparkSession, input_path: str, output_path: str, run_date=None, schema=None,
                 date_col: str = "date", now=None) -> dict:
    """CSV (Hive layout by ``date_col``) -> processing time -> Parquet.

    With ``run_date`` only that day's input folder is read and only that
    day's output partition is replaced (dynamic overwrite); the row count is
    observed during the write, so the input is read once."""
    df = io.read_by_date(spark, input_path, run_date, date_col, format="csv", schema=schema, header="true",
                         **({} if schema is not None else {"inferSchema": "true"}))
    df = X.add_processing_time(df, now=now)
    return io.write_parquet(df, output_path, partition_by=[date_col], observe=True)


def maintain(spark: SparkSession, table_path: str, operation: str, days: int = 7):
    """Table upkeep: ``expire`` (oldest readable version), ``unreferenced``
    (number of files no readable version needs) or ``compact`` (new version)."""
    import datetime as dt

    t = VersionedTable(spark, table_path)
    if operation == "expire":
        return t.expire(older_than=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(days=days))
    if operation == "unreferenced":
        return t.unreferenced().count()
    if operation == "compact":
        return t.compact()
    raise ValueError(f"unknown maintenance operation {operation!r}")


def main(argv=None) -> int:
    """Command-line entry for the jobs (``spark-submit -m tessera.plans.jobs``)."""
    p = argparse.ArgumentParser(description="tessera jobs")
    sub = p.add_subparsers(dest="job", required=True)
    b = sub.add_parser("batch")
    b.add_argument("--input", required=True)
    b.add_argument("--output", required=True)
    b.add_argument("--date")
    m = sub.add_parser("maintain")
    m.add_argument("--table", required=True)
    m.add_argument("--operation", required=True, choices=["expire", "unreferenced", "compact"])
    m.add_argument("--days", type=int, default=7)
    args = p.parse_args(argv)
    from tessera.session import build_session

    spark = build_session("tessera-" + args.job)
    try:
        if args.job == "batch":
            print(batch_ingest(spark, args.input, args.output, args.date))
        else:
            print(maintain(spark, args.table, args.operation, args.days))
        return 0
    finally:
        spark.stop()


# ---- registered job queries -------------------------------------------------

EVENT_COLS = "event_id, ts, user_id, event_type, value, props"
EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
        T.StructField("date", T.DateType()),
    ]
)


def _events_csv_by_day(spark, sf):
    path = scratch_path(spark, "raw_events")
    ev = table(spark, sf, "events").withColumn("date", F.to_date("ts"))
    io.write_files(ev, path, format="csv", partition_by=["date"], header="true",
                   timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return path


@register(
    "job_batch",
    f"""SELECT {EVENT_COLS}, TIMESTAMP '{FIXED_NOW}' AS processed_at, CAST(ts AS DATE) AS date FROM events
        WHERE CAST(ts AS DATE) IN (DATE '2024-01-05', DATE '2024-01-06')""",
)
def job_batch(spark, sf):
    raw = _events_csv_by_day(spark, sf)
    out = scratch_path(spark, "processed_events")
    now = F.lit(FIXED_NOW).cast("timestamp_ntz")
    for day in ("2024-01-05", "2024-01-06", "2024-01-05"):  # a rerun of a day replaces only that day
        batch_ingest(spark, raw, out, day, schema=EVENTS_SCHEMA, now=now)
    return io.read_parquet(spark, out)


@register(
    "stream_ingest",
    f"SELECT {EVENT_COLS}, TIMESTAMP '{FIXED_NOW}' AS processed_at FROM events",
)
def stream_ingest(spark, sf):
    src = scratch_path(spark, "stream_in")
    io.write_files(table(spark, sf, "events"), src, format="csv", header="true",
                   timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    sink, ckpt = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ckpt")
    schema = T.StructType(EVENTS_SCHEMA.fields[:-1])
    q = S.file_ingest(spark, src, sink, ckpt, schema, now=F.lit(FIXED_NOW).cast("timestamp_ntz"))
    q.awaitTermination()
    # a restart from the same checkpoint finds no new files: nothing is added
    S.file_ingest(spark, src, sink, ckpt, schema, now=F.lit(FIXED_NOW).cast("timestamp_ntz")).awaitTermination()
    return io.read_parquet(spark, sink)


def _stream_of(spark, df, name):
    """A stream of parquet files that hold ``df``."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return S.read_files(spark, path, df.schema, format="parquet")


@register(
    "stream_upsert",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
       FROM orders""",
)
def stream_upsert(spark, sf):
    """Two streams (even and odd keys), each numbering its batches from 0, into
    one table that holds some of the orders already; the first runs again."""
    o = table(spark, sf, "orders")
    t = VersionedTable(spark, scratch_path(spark, "upserts")).create(o.schema)
    t.append(o.where("o_orderstatus <> 'O'"))
    raised = o.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for odd in (0, 1):
        stream, checkpoint = _stream_of(spark, raised.where(F.col("o_orderkey") % 2 == odd), "upsert_in"), scratch_path(spark, "upsert_ck")
        for _ in range(2 - odd):
            S.upsert_into(stream, t, ["o_orderkey"], checkpoint).awaitTermination()
    return t.read()


@register(
    "stream_hourly",
    """SELECT date_trunc('hour', ts) AS hour, COUNT(*) AS event_count FROM events
       GROUP BY 1 HAVING date_trunc('hour', ts) + INTERVAL 2 HOUR <= (SELECT MAX(ts) FROM events)""",
)
def stream_hourly(spark, sf):
    """Hourly counts of the windows that the watermark (one hour) has closed."""
    ev = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = scratch_path(spark, "hourly_out")
    counts = S.hourly_counts(_stream_of(spark, ev, "hourly_in"))
    counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "hourly_ck")).trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.parquet(out).select(F.col("hour").cast("timestamp_ntz").alias("hour"), "event_count")


@register("stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark, sf):
    """Every event arrives twice; one of each key passes."""
    ev = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = scratch_path(spark, "dedup_out")
    kept = S.dedup_on_key(_stream_of(spark, ev.unionByName(ev), "dedup_in"), ["event_id"])
    kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "dedup_ck")).trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


@register(
    "stream_validated",
    """SELECT event_id, value <= 50 AS good, (SELECT COUNT(*) FILTER (WHERE value > 50) FROM events) AS reported FROM events""",
)
def stream_validated(spark, sf):
    """Good and bad rows of a validated sink, with the failures its report counts."""
    good, bad, report = (scratch_path(spark, f"validated_{k}") for k in ("good", "bad", "report"))
    S.validated_sink(
        _stream_of(spark, table(spark, sf, "events"), "validated_in"), lambda df: [Q.in_range("value", max_val=50)], good, bad, report,
        scratch_path(spark, "validated_ck"), bad_row=F.col("value") > 50,
    ).awaitTermination()
    failed = spark.read.parquet(report).agg(F.sum("failed_count")).first()[0]
    rows = spark.read.parquet(good).select("event_id", F.lit(True).alias("good")).unionByName(
        spark.read.parquet(bad).select("event_id", F.lit(False).alias("good"))
    )
    return rows.withColumn("reported", F.lit(failed))


@register(
    "etl_end_to_end",
    f"""SELECT o_orderkey AS id, o_custkey AS customer, o_totalprice AS amount,
               CAST(o_orderdate AS DATE) AS order_date, upper(o_orderpriority) AS priority,
               TIMESTAMP '{FIXED_NOW}' AS processed_at
        FROM orders""",
)
def etl_end_to_end(spark, sf):
    """Extract text rows -> cast, upper-case, stamp -> quality gate -> write ->
    stage metrics.  Returns the written table."""
    run = M.PipelineRun("orders_etl")
    o = table(spark, sf, "orders")
    raw_path = scratch_path(spark, "etl_raw")
    io.write_csv(o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"),
                          F.col("o_totalprice").cast("string").alias("amount"),
                          F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
                          F.col("o_orderpriority").alias("priority")), raw_path)
    raw = io.read_csv(spark, raw_path)
    typed = X.cast_columns(raw, {"id": "long", "customer": "long", "amount": "double", "order_date": "date"})
    typed = X.add_processing_time(X.upper_column(typed, "priority"), now=F.lit(FIXED_NOW).cast("timestamp_ntz"))
    Q.validate_dataframe(typed, [Q.not_null("id"), Q.unique("id"), Q.in_range("amount", min_val=0)], "orders_etl")
    out = scratch_path(spark, "etl_out")
    with run.stage("load", typed, input_rows=raw.count()) as observed:
        io.write_parquet(observed, out)
    run.finish()
    Q.require_checks(M.stage_balance(run.stages(spark)), {"rows in = rows out": F.min("balanced")})
    return io.read_parquet(spark, out)


if __name__ == "__main__":
    sys.exit(main())
