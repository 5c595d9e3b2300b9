"""Streams whose results depend on all rows so far: quality rules over a whole stream, joins of two streams, late rows.

State lives in Spark's state store and in small tables written per micro-batch, each
under its batch id, so that a batch that runs again after a failure replaces what it
wrote and a restart goes on where the stream was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import qcol
from tessera.operators import quality as Q
from tessera.streaming.ingest import write_batch


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What micro-batches wrote to ``path``; nothing if none has."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class RuleState:
    """Quality rules over a whole stream, not batch by batch.

    Two streaming aggregates keep the state: one row with the aggregates of all row-wise
    rules, and for the uniqueness rules one count per rule and key.  Of the
    latter only keys seen more than once leave the state store, so the report reads the
    duplicates and not the keys.  Rules that look at another table or run their own
    job have no streaming form and are refused.
    """

    def __init__(self, schema: DataFrame, rules: Sequence[Q.Rule], path: str):
        """``schema`` is a frame (or stream) with the stream's columns."""
        self.path, self.rules, self.spark = path.rstrip("/"), list(rules), schema.sparkSession
        for rule in self.rules:
            if rule.kind == "reference" or (rule.kind == "static" and rule.rule_name != "column_exists"):
                raise ValueError(f"rule {rule.name!r} cannot be kept over a stream")
        self.aggregates = {f"__r{i}_{k}": e for i, r in enumerate(self.rules) if r.kind == "agg" for k, e in r.aggregates(schema).items()}
        self.statics = {i: r.schema_check(schema) for i, r in enumerate(self.rules) if r.kind == "static"}
        self.distinct = {i: r for i, r in enumerate(self.rules) if r.kind == "distinct"}
        self.fused_schema = self._fused(self.spark.createDataFrame([], schema.schema)).schema.simpleString()[len("struct<") : -1].replace(":", " ").replace(",", ", ")

    def _fused(self, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(Q._TOTAL), *[e.alias(k) for k, e in self.aggregates.items()])

    def start(self, stream: DataFrame, available_now: bool = True) -> list:
        """Start the stream's queries; a restart from the same path goes on from its checkpoints."""

        def query(df: DataFrame, mode: str, name: str, keep: Column | None):
            def handle(batch: DataFrame, batch_id: int) -> None:
                write_batch(batch if keep is None else batch.where(keep), f"{self.path}/{name}", batch_id)

            w = df.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", f"{self.path}/{name}-checkpoint")
            return (w.trigger(availableNow=True) if available_now else w).start()

        queries = [query(self._fused(stream), "complete", "fused", None)]
        if self.distinct:
            keys = [
                F.struct(F.lit(i).alias("ordinal"), F.to_json(F.struct(*[qcol(c) for c in r.columns]), {"ignoreNullFields": "false"}).alias("key"))
                for i, r in self.distinct.items()
            ]
            counted = stream.select(F.inline(F.array(*keys))).groupBy("ordinal", "key").agg(F.count(F.lit(1)).alias("n"))
            queries.append(query(counted, "update", "keys", F.col("n") > 1))
        return queries

    def report(self) -> DataFrame:
        """The report over all rows the stream has had: rows as :func:`tessera.operators.quality.report_frame` gives them."""
        fused = stored(self.spark, f"{self.path}/fused", f"{self.fused_schema}, batch_id bigint")
        names = [c for c in fused.columns if c != "batch_id"]
        last = fused.agg(F.max_by(F.struct(*names), "batch_id").alias("s"))  # one row, of nulls before the first batch
        last = last.select(F.coalesce("s.`" + Q._TOTAL + "`", F.lit(0).cast("long")).alias(Q._TOTAL),
                           *[F.col(f"s.`{k}`").alias(k) for k in self.aggregates])
        seen = stored(self.spark, f"{self.path}/keys", "ordinal int, key string, n bigint, batch_id bigint")
        counts = seen.groupBy("ordinal", "key").agg(F.max("n").alias("n"))  # counts only grow
        surplus = counts.groupBy("ordinal").agg(F.sum(F.col("n") - 1).alias("s"))
        by_rule = surplus.agg(F.map_from_entries(F.collect_list(F.struct("ordinal", "s"))).alias("__surplus"))  # an entry per rule
        one = last.withColumn("__one", F.lit(1)).join(by_rule.withColumn("__one", F.lit(1)), "__one")  # a row each
        rows = []
        for i, rule in enumerate(self.rules):
            if rule.kind == "agg":
                nothing = "false" if rule.rule_name == rule.name else "0L"  # before the first row: of a custom rule, of a count
                cols = {k[len(f"__r{i}_") :]: Q.Sql(f"coalesce(`{k}`, {nothing})") for k in self.aggregates if k.startswith(f"__r{i}_")}
                rows.append(Q._outcome_row(i, rule, rule.outcome({**cols, "total": Q.Sql(Q._TOTAL)})))
            elif rule.kind == "static":
                rows.append(Q._static_row(i, rule, self.statics[i]))
            else:
                rows.append(Q._distinct_row(i, rule, Q.Sql(Q._TOTAL), Q.Sql(f"coalesce(try_element_at(__surplus, {i}), 0L)")))
        return one.selectExpr(f"inline(array({', '.join(rows)}))")


def split_late(stream: DataFrame, ts: str, delay_seconds: int, path: str, available_now: bool = True):
    """Start a stream that parts on-time rows (``path``/on_time) from late ones (``path``/late).

    A row is late if its time is more than ``delay_seconds`` before the greatest
    time of all earlier micro-batches; rows without a time are late.  Spark's own
    watermarks drop such rows without a trace.  Both parts are written under their batch id,
    and so is the batch's greatest time, from which a restart goes on.
    """
    path = path.rstrip("/")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, us = batch.sparkSession, F.unix_micros(qcol(ts).cast("timestamp"))
        earlier = stored(spark, f"{path}/seen", "us bigint, batch_id bigint").where(F.col("batch_id") < batch_id)
        bound = earlier.agg(F.max("us").alias("m")).first()["m"]  # one value
        late = F.lit(False) if bound is None else us < bound - delay_seconds * 1_000_000
        late = F.coalesce(late, F.lit(True)) | qcol(ts).isNull()
        rows = batch.withColumn("__late", late).persist()  # evaluated once for the three writes
        try:
            write_batch(rows.where(~F.col("__late")).drop("__late"), f"{path}/on_time", batch_id)
            write_batch(rows.where("__late").drop("__late"), f"{path}/late", batch_id)
            write_batch(rows.agg(F.max(us).alias("us")), f"{path}/seen", batch_id)
        finally:
            rows.unpersist()

    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", f"{path}/checkpoint")
    return (w.trigger(availableNow=True) if available_now else w).start()


def interval_join(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: str = "1 hour", delay: str = "10 minutes", how: str = "left_outer"
) -> DataFrame:
    """Rows of two streams with one key whose right time is within ``within`` after the left time.

    ``how`` is inner or left_outer: a left row without a partner comes out once both watermarks
    show that none can come any more.  State is bounded by the two delays and the interval.
    The right side's columns get the prefix ``r_``.
    """
    if how not in ("inner", "left_outer"):
        raise ValueError("how must be inner or left_outer")
    a = left.withWatermark(left_ts, delay)
    b = right.select(*[qcol(c).alias(f"r_{c}") for c in right.columns]).withWatermark(f"r_{right_ts}", delay)
    near = (F.col(f"r_{right_ts}") >= qcol(left_ts)) & (F.col(f"r_{right_ts}") <= qcol(left_ts) + F.expr(f"INTERVAL {within}"))
    return a.join(b, (qcol(key) == F.col(f"r_{key}")) & near, how)
