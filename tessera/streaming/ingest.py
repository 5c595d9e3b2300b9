"""Structured Streaming counterparts of the batch operators.

* :func:`file_ingest` – file source (explicit schema) -> processing time ->
  Parquet sink with a checkpoint: exactly-once per file, restartable.
* :func:`hourly_counts` – watermark + tumbling window, append mode.
* :func:`dedup_on_key` – ``dropDuplicatesWithinWatermark``.
* :func:`validated_sink` – quality rules per micro-batch via ``foreachBatch``;
  failing rows diverted to a quarantine path; a replayed batch replaces itself.
* :func:`upsert_into` – per micro-batch merge into a versioned table; query
  and batch id in the merge's commit make a replayed batch a no-op.

Checkpoints live in the shared folder; tests use ``availableNow`` triggers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import qcol
from tessera.operators import quality as Q
from tessera.operators.versioned import VersionedTable


def read_files(spark: SparkSession, path: str, schema: T.StructType, format: str = "csv",
               max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Streaming file source; the schema is required (no inference on streams)."""
    r = spark.readStream.format(format).schema(schema)
    if format == "csv":
        r = r.option("header", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def file_ingest(spark: SparkSession, source: str, sink: str, checkpoint: str, schema: T.StructType,
                format: str = "csv", available_now: bool = True, processed_col: str = "processed_at",
                now: Column | None = None):
    """Start the ingest stream; returns the ``StreamingQuery``."""
    df = read_files(spark, source, schema, format)
    df = df.withColumn(processed_col, now if now is not None else F.current_timestamp())
    w = df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def hourly_counts(events: DataFrame, ts_col: str = "ts", watermark: str = "1 hour",
                  window: str = "1 hour") -> DataFrame:
    """Events per closed hour window; rows are emitted once the watermark
    passes the window end (append mode)."""
    return (
        events.withWatermark(ts_col, watermark)
        .groupBy(F.window(qcol(ts_col), window).alias("w"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(F.col("w.start").alias("hour"), "event_count")
    )


def dedup_on_key(events: DataFrame, keys: Sequence[str], ts_col: str = "ts",
                 watermark: str = "1 hour") -> DataFrame:
    """First row per key among rows within the watermark delay."""
    return events.withWatermark(ts_col, watermark).dropDuplicatesWithinWatermark(list(keys))


def _start(stream: DataFrame, handle, checkpoint: str, available_now: bool):
    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch under its id; writing it again replaces it."""
    rows.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("batch_id").parquet(path)


def validated_batch(batch: DataFrame, batch_id: int, rules_for, good_path: str, bad_path: str, report_path: str, bad_row: Column) -> None:
    """Report, good rows and bad rows of one micro-batch, which is evaluated once."""
    flagged = batch.withColumn("__bad", F.coalesce(bad_row, F.lit(True))).persist()
    try:
        rows = flagged.drop("__bad")
        write_batch(Q.report_frame(rows, rules_for(rows)), report_path, batch_id)
        write_batch(flagged.where(~F.col("__bad")).drop("__bad"), good_path, batch_id)
        write_batch(flagged.where(F.col("__bad")).drop("__bad"), bad_path, batch_id)
    finally:
        flagged.unpersist()


def validated_sink(stream: DataFrame, rules_for, good_path: str, bad_path: str, report_path: str,
                   checkpoint: str, bad_row: Column, available_now: bool = True):
    """Per micro-batch: write the fused rule report, the rows passing
    ``bad_row = false`` to ``good_path`` and the others to ``bad_path``, each
    under ``batch_id``; a batch that is run again replaces what it wrote."""

    def handle(batch: DataFrame, batch_id: int):
        validated_batch(batch, batch_id, rules_for, good_path, bad_path, report_path, bad_row)

    return _start(stream, handle, checkpoint, available_now)


def upsert_into(stream: DataFrame, table: VersionedTable, on: Sequence[str], checkpoint: str,
                available_now: bool = True):
    """Merge every micro-batch into ``table``.  The merge's own commit record
    holds the query's id (new for a new checkpoint) and the batch's number, so
    a batch that is run again after a failure is a no-op, and batches of
    other streams never pass for it."""

    def handle(batch: DataFrame, batch_id: int):
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if query_id is None:
            raise RuntimeError("not called from a streaming query")
        table.merge(batch, on=list(on), stream=(query_id, batch_id))

    return _start(stream, handle, checkpoint, available_now)
