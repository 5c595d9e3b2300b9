"""Pipeline metrics kept as tables.

Samples are rows ``(name, value, type, labels map<string,string>, ts)``;
stage runs are rows ``(pipeline, run_id, stage, started_at, ended_at,
input_rows, output_rows, status, error)``.  Reports, roll-ups, alerts and the
text exposition are queries over those rows, so they work the same for one
run or for the metrics of a whole fleet.

:class:`PipelineRun` gathers the handful of sample and stage rows of one run
(metadata, not data) and turns them into frames.
Row counts for a stage come from an ``Observation`` on the frame being
written, not from extra ``count()`` jobs.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import functools
import operator
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import count_where, qcol

# Metric types and the default histogram bucket bounds (+Inf last).
COUNTER, GAUGE, HISTOGRAM, SUMMARY, TIMER = "counter", "gauge", "histogram", "summary", "timer"
DEFAULT_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, float("inf")]

SAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("values", T.ArrayType(T.DoubleType())),
        T.StructField("type", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("description", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
    ]
)

STAGE_SCHEMA = T.StructType(
    [
        T.StructField("pipeline", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("ended_at", T.TimestampNTZType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("output_rows", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("custom", T.MapType(T.StringType(), T.StringType())),
    ]
)

RUN_SCHEMA = "pipeline string, run_id string, status string, ended_at timestamp_ntz"


def merge_labels(common: Mapping[str, str] | Column, own: Column) -> Column:
    """Common labels plus the sample's own; on a shared key the sample wins.
    (Plain ``map_concat`` raises on duplicate keys.)"""
    if not isinstance(common, Column):
        common = F.create_map(*[F.lit(x) for kv in common.items() for x in kv]) if common else \
            F.create_map().cast("map<string,string>")
    own_keys = F.map_keys(own)
    kept = F.map_filter(common, lambda k, v: ~F.array_contains(own_keys, k))
    return F.map_concat(kept, own)


def samples_from_groups(
    df: DataFrame,
    name: str,
    value: Column,
    group_cols: Sequence[str],
    metric_type: str = GAUGE,
    common_labels: Mapping[str, str] | None = None,
    ts: Column | None = None,
) -> DataFrame:
    """One sample per group of ``df``: ``value`` is an aggregate, the group
    values become labels (merged with ``common_labels``)."""
    own = F.create_map(*[x for c in group_cols for x in (F.lit(c), qcol(c).cast("string"))]) if group_cols \
        else F.create_map().cast("map<string,string>")
    agg = df.groupBy(*[qcol(c) for c in group_cols]).agg(value.cast("double").alias("value"))
    return agg.select(
        F.lit(name).alias("name"),
        F.col("value"),
        F.lit(None).cast("array<double>").alias("values"),
        F.lit(metric_type).alias("type"),
        merge_labels(common_labels or {}, own).alias("labels"),
        F.lit("").alias("description"),
        (ts if ts is not None else F.localtimestamp()).cast("timestamp_ntz").alias("ts"),
    )


def histogram(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
              bounds: Sequence[float] = DEFAULT_BOUNDS) -> DataFrame:
    """Cumulative buckets (``le``, count of values ``<= le``) plus sum and
    count per group, from one aggregate; rows: group..., ``le``, ``bucket_count``,
    ``sum``, ``count``."""
    v = qcol(value_col)
    aggs = [count_where(v <= F.lit(b)).alias(f"__b{i}") for i, b in enumerate(bounds)]
    g = df.groupBy(*[qcol(c) for c in group_cols]).agg(
        *aggs, F.sum(v).alias("sum"), F.count(v).alias("count")
    )
    buckets = F.array(*[
        F.struct(F.lit("+Inf" if b == float("inf") else _bound_text(b)).alias("le"), F.col(f"__b{i}").alias("n"))
        for i, b in enumerate(bounds)
    ])
    return g.select(*[qcol(c) for c in group_cols], F.inline(buckets), "sum", "count").withColumnRenamed(
        "n", "bucket_count"
    )


def _bound_text(b: float) -> str:
    return str(int(b)) if float(b).is_integer() else repr(float(b))


def summary(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
            quantiles: Sequence[float] = (0.5, 0.9, 0.99), exact: bool = True, bins: int = 200) -> DataFrame:
    """Quantiles per group, with the sum and number of values.

    Exact ones interpolate between the two nearest ranks.  They come from
    approximate bounds that cut each group into ``bins`` ranges, counts per
    range, and a sort of only those ranges that hold a wanted rank: no task
    sorts or buffers a whole group.  ``exact=False`` is one approximate
    aggregate.
    """
    keys = [f"__g{i}" for i in range(max(1, len(group_cols)))]
    own = [qcol(c) for c in group_cols] or [F.lit(0)]
    rows = df.select(*[c.alias(k) for c, k in zip(own, keys)], qcol(value_col).cast("double").alias("__v")).where("__v IS NOT NULL")
    wanted = F.array(*[F.lit(float(q)) for q in quantiles])
    totals = [F.sum("__v").alias("sum"), F.count("__v").alias("count")]
    names = [F.col(k).alias(c) for c, k in zip(group_cols, keys)]
    if not exact:
        g = rows.groupBy(*keys).agg(F.percentile_approx("__v", list(quantiles), 10000).alias("__q"), *totals)
        pairs = F.arrays_zip(wanted.alias("quantile"), F.col("__q").alias("value"))
        return g.select(*names, F.inline(pairs), "sum", "count")

    def with_groups(left: DataFrame, right: DataFrame) -> DataFrame:
        other = right.select(*[F.col(k).alias(f"{k}r") for k in keys], *[c for c in right.columns if c not in keys])
        same = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"{k}r")) for k in keys])
        if not group_cols:
            other = F.broadcast(other)  # a few rows for the one group
        return left.join(other, same).drop(*[f"{k}r" for k in keys])

    cuts = [i / bins for i in range(1, bins)]
    groups = rows.groupBy(*keys).agg(F.percentile_approx("__v", cuts, 10 * bins).alias("__cuts"), *totals)
    binned = with_groups(rows, groups.select(*keys, "__cuts")).withColumn("__bin", F.size(F.filter("__cuts", lambda x: x < F.col("__v")))).drop("__cuts")
    counted = binned.groupBy(*keys, "__bin").agg(F.count(F.lit(1)).alias("__n"))
    below = Window.partitionBy(*keys).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)  # at most ``bins`` rows a group
    counted = counted.withColumn("__before", F.coalesce(F.sum("__n").over(below), F.lit(0)))
    asked = groups.select(*keys, "count", "sum", F.explode(wanted).alias("quantile")).withColumn("__at", F.col("quantile") * (F.col("count") - 1))
    ranks = asked.select(*keys, F.explode(F.array(F.floor("__at"), F.ceil("__at"))).alias("__rank")).distinct()
    holding = with_groups(counted, ranks).where("__rank >= __before AND __rank < __before + __n")
    part = binned.groupBy(*keys, "__bin", "__v").agg(F.count(F.lit(1)).alias("__c"))
    in_bin = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"{k}r")) for k in keys], F.col("__bin") == F.col("__binr"))
    bins_used = holding.select(*[F.col(k).alias(f"{k}r") for k in keys], F.col("__bin").alias("__binr"), "__before").distinct()
    part = part.join(bins_used, in_bin).drop(*[f"{k}r" for k in keys], "__binr")
    upto = Window.partitionBy(*keys, "__bin").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    part = part.withColumn("__first", F.col("__before") + F.coalesce(F.sum("__c").over(upto), F.lit(0)))
    values = with_groups(part.select(*keys, "__v", "__c", "__first"), ranks).where("__rank >= __first AND __rank < __first + __c")
    values = values.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__v"))).alias("__at_rank"))  # two a quantile
    low, high = F.element_at("__at_rank", F.floor("__at")), F.element_at("__at_rank", F.ceil("__at"))
    value = low + (high - low) * (F.col("__at") - F.floor("__at"))
    return with_groups(asked, values).select(*names, "quantile", value.alias("value"), "sum", "count")


def stage_runs_from_events(events: DataFrame, pipeline: str, run_col: str, stage_col: str, ts_col: str,
                           ok: Column, failed_stage: Column) -> DataFrame:
    """Derive stage-run rows from an event log: one row per (run, stage) with
    first/last event time, events in, events passing ``ok`` out, and status
    ``failed`` when any event of the stage satisfies ``failed_stage``."""
    g = events.groupBy(qcol(run_col).cast("string").alias("run_id"), qcol(stage_col).alias("stage")).agg(
        F.min(qcol(ts_col)).alias("started_at"),
        F.max(qcol(ts_col)).alias("ended_at"),
        F.count(F.lit(1)).alias("input_rows"),
        count_where(ok).alias("output_rows"),
        F.max(F.coalesce(failed_stage, F.lit(False)).cast("int")).alias("__failed"),
    )
    return g.select(
        F.lit(pipeline).alias("pipeline"),
        "run_id",
        "stage",
        F.col("started_at").cast("timestamp_ntz").alias("started_at"),
        F.col("ended_at").cast("timestamp_ntz").alias("ended_at"),
        "input_rows",
        "output_rows",
        F.when(F.col("__failed") == 1, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        F.when(F.col("__failed") == 1, F.lit("stage reported errors")).alias("error"),
        F.create_map().cast("map<string,string>").alias("custom"),
    )


def _seconds(start: Column, end: Column) -> Column:
    """Seconds between two timestamps; NULL until the stage has ended."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1_000_000.0


def stage_rollup(stages: DataFrame) -> DataFrame:
    """Stage rows with ``duration_seconds`` (NULL while running)."""
    return stages.withColumn("duration_seconds", _seconds(F.col("started_at"), F.col("ended_at")))


def run_rollup(stages: DataFrame, runs: DataFrame | None = None, report: bool = False) -> DataFrame:
    """One row per run: start, end, duration, stage counts, rows in/out, status.

    A run with a stage that has not ended is ``running``, without end or
    duration; else it is ``failed`` if a stage failed, else ``success``.  Rows
    ``runs`` (pipeline, run_id, status, ended_at), written when a run is
    finished, take precedence.  ``report`` adds the list of stages, from the
    same aggregate.
    """
    own = ("stage", "started_at", "ended_at", "duration_seconds", "input_rows", "output_rows", "status", "error")
    parts = [F.array_sort(F.collect_list(F.struct(*own))).alias("stage_list")] if report else []
    out = stage_rollup(stages).groupBy("pipeline", "run_id").agg(
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("__last"),
        F.count(F.lit(1)).alias("stages"),
        count_where(F.col("ended_at").isNull()).alias("__open"),
        count_where(F.col("status") == "failed").alias("failed_stages"),
        F.sum("input_rows").alias("input_rows"),
        F.sum("output_rows").alias("output_rows"),
        *parts,
    )
    ended = F.when(F.col("__open") == 0, F.col("__last"))
    status = F.when(F.col("__open") > 0, "running").when(F.col("failed_stages") > 0, "failed").otherwise("success")
    if runs is not None:
        said = runs.select("pipeline", "run_id", F.col("status").alias("__status"), F.col("ended_at").alias("__ended"))
        out = out.join(said, ["pipeline", "run_id"], "left")
        ended, status = F.coalesce("__ended", ended), F.coalesce("__status", status)
    out = out.withColumns({"ended_at": ended, "status": status}).withColumn("duration_seconds", _seconds(F.col("started_at"), F.col("ended_at")))
    return out.select("pipeline", "run_id", "started_at", "ended_at", "stages", "failed_stages", "input_rows", "output_rows",
                      "duration_seconds", "status", *(["stage_list"] if report else []))


def run_report(stages: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Nested report per run: run fields, the list of its stages, and a JSON
    rendering of the whole; one aggregate over the stages."""
    rep = run_rollup(stages, runs, report=True)
    return rep.withColumn("report_json", F.to_json(F.struct(*[F.col(c) for c in rep.columns])))


def stage_balance(stages: DataFrame) -> DataFrame:
    """Rows in against rows out of every ended stage: ``balanced`` if equal and successful."""
    return stages.where(F.col("ended_at").isNotNull()).select(
        "pipeline", "run_id", "stage", "input_rows", "output_rows",
        ((F.col("input_rows") == F.col("output_rows")) & (F.col("status") == "success")).alias("balanced"),
    )


def runs_report(runs: DataFrame) -> DataFrame:
    """All runs of each pipeline: number of runs, by status, total duration."""
    return runs.groupBy("pipeline").agg(
        F.count(F.lit(1)).alias("total_runs"),
        count_where(F.col("status") == "success").alias("successful_runs"),
        count_where(F.col("status") == "failed").alias("failed_runs"),
        F.sum("duration_seconds").alias("total_duration_seconds"),
    )


def alert_failed_runs(runs: DataFrame, as_of, minutes: int = 5) -> DataFrame:
    """Pipelines with failed runs ending within ``minutes`` before ``as_of``."""
    hi = F.lit(str(as_of)).cast("timestamp_ntz")
    lo = hi - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    recent = runs.where((F.col("status") == "failed") & (F.col("ended_at") > lo) & (F.col("ended_at") <= hi))
    return recent.groupBy("pipeline").agg(F.count(F.lit(1)).alias("failed_runs"))


def alert_slow_runs(runs: DataFrame, max_seconds: float = 3600) -> DataFrame:
    """Runs longer than ``max_seconds``."""
    return runs.where(F.col("duration_seconds") > F.lit(float(max_seconds))).select(
        "pipeline", "run_id", "duration_seconds"
    )


def _escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit('"'), F.lit('\\"'))
    return F.replace(c, F.lit("\n"), F.lit("\\n"))


def _label_text(labels: Column) -> Column:
    """``k1="v1",k2="v2"`` with keys sorted and values escaped."""
    entries = F.array_sort(F.map_entries(labels))
    parts = F.transform(entries, lambda e: F.concat(e["key"], F.lit('="'), _escape(e["value"]), F.lit('"')))
    return F.array_join(parts, ",")


def exposition_lines(samples: DataFrame) -> DataFrame:
    """Text exposition, one output row per line: ``name{labels} value``;
    histograms expand to cumulative ``_bucket`` lines plus ``_sum`` and
    ``_count``; timers are exposed as gauges."""
    lab = _label_text(F.col("labels"))
    braces = F.when(lab == "", F.lit("")).otherwise(F.concat(F.lit("{"), lab, F.lit("}")))
    plain = samples.where(F.col("type") != HISTOGRAM).select(
        F.col("name"),
        F.concat(F.col("name"), braces, F.lit(" "), F.col("value").cast("string")).alias("line"),
    )
    hist = samples.where(F.col("type") == HISTOGRAM)
    bounds = F.array(*[F.lit(b) for b in DEFAULT_BOUNDS])
    b = hist.select("name", "labels", "values", F.explode(bounds).alias("le"))
    le_text = F.when(F.col("le") == float("inf"), F.lit("+Inf")).otherwise(F.col("le").cast("string"))
    cnt = F.size(F.filter(F.col("values"), lambda x: x <= F.col("le")))
    le_lab = F.when(lab == "", F.concat(F.lit('le="'), le_text, F.lit('"'))).otherwise(
        F.concat(F.lit('le="'), le_text, F.lit('",'), lab))
    bucket_lines = b.select(
        "name", F.concat(F.col("name"), F.lit("_bucket{"), le_lab, F.lit("} "), cnt.cast("string")).alias("line")
    )
    total = F.aggregate(F.col("values"), F.lit(0.0), lambda acc, x: acc + x)
    sum_lines = hist.select("name", F.concat(F.col("name"), F.lit("_sum"), braces, F.lit(" "),
                                             total.cast("string")).alias("line"))
    count_lines = hist.select("name", F.concat(F.col("name"), F.lit("_count"), braces, F.lit(" "),
                                               F.size("values").cast("string")).alias("line"))
    return plain.unionByName(bucket_lines).unionByName(sum_lines).unionByName(count_lines)


def exposition(samples: DataFrame) -> DataFrame:
    """The whole text exposition: per metric its HELP (where a description is
    given) and TYPE line, then its samples; columns ``name``, ``section`` and
    ``line``, to be ordered by them.  Timers are gauges."""
    kind = F.when(F.col("type") == TIMER, F.lit(GAUGE)).otherwise(F.col("type"))
    heads = samples.groupBy("name").agg(F.max("description").alias("text"), F.max(kind).alias("kind"))
    help_line = F.concat(F.lit("# HELP "), F.col("name"), F.lit(" "), F.replace(F.replace("text", F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))
    helps = heads.where("text <> ''").select("name", F.lit(0).alias("section"), help_line.alias("line"))
    types = heads.select("name", F.lit(1).alias("section"), F.concat(F.lit("# TYPE "), F.col("name"), F.lit(" "), F.col("kind")).alias("line"))
    return helps.unionByName(types).unionByName(exposition_lines(samples).select("name", F.lit(2).alias("section"), "line"))


def save_report(df: DataFrame, path: str, format: str = "json") -> None:
    """Write report rows as JSON lines or as text lines (a ``line`` column)."""
    if format == "json":
        df.write.mode("overwrite").json(path)
    elif format in ("text", "exposition"):
        df.select("line").write.mode("overwrite").text(path)
    else:
        raise ValueError(f"unknown report format {format!r}; use 'json' or 'text'")


class PipelineRun:
    """The sample and stage rows of one run (a few per run), kept until written."""

    def __init__(self, pipeline: str, run_id: str | None = None, labels: Mapping[str, str] | None = None):
        self.key = (pipeline, run_id or f"{pipeline}_{uuid.uuid4().hex}")
        self.labels = {**(labels or {}), "pipeline": pipeline, "run_id": self.key[1]}
        self.sample_rows: list[tuple] = []
        self.stage_rows: list[tuple] = []
        self.run_row: tuple | None = None
        self.began = _now()

    def record(self, name: str, value, kind: str = GAUGE, description: str = "", **labels: str) -> None:
        """One sample; a list of values for a histogram."""
        many = kind == HISTOGRAM
        self.sample_rows.append((name, None if many else float(value), [float(v) for v in value] if many else None, kind,
                                 {**self.labels, **labels}, description, _now()))

    @contextlib.contextmanager
    def timed(self, name: str, **labels: str):
        """Record how long a block takes, also when it raises."""
        began = time.perf_counter()
        try:
            yield
        finally:
            self.record(name, time.perf_counter() - began, TIMER, **labels)

    @contextlib.contextmanager
    def stage(self, name: str, df: DataFrame | None = None, input_rows: int | None = None):
        """Run a stage.  Given ``df``, yields it observed; the rows of the action
        on it become the stage's output rows, and its input rows if none are given."""
        seen = Observation() if df is not None else None
        began, status, error = _now(), "success", None
        try:
            with self.timed("pipeline_stage_duration_seconds", stage=name):
                yield None if df is None else df.observe(seen, F.count(F.lit(1)).alias("rows"))
        except Exception as exc:
            status, error = "failed", str(exc)
            raise
        finally:
            ran = seen is not None and status == "success" and seen._jo is not None
            rows = seen.get.get("rows", 0) if ran else 0
            self.stage_rows.append((*self.key, name, began, _now(), rows if input_rows is None else input_rows, rows, status, error, {}))
            self.record("pipeline_stage_output_rows", rows, stage=name)

    def finish(self, status: str = "success") -> None:
        self.run_row = (*self.key, status, _now())
        self.record("pipeline_duration_seconds", (self.run_row[3] - self.began).total_seconds(), TIMER)
        self.record("pipeline_runs_total", 1, COUNTER, status=status)

    def samples(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.sample_rows, SAMPLE_SCHEMA)

    def stages(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.stage_rows, STAGE_SCHEMA)

    def runs(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([self.run_row] if self.run_row else [], RUN_SCHEMA)


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
