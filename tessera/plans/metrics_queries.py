"""Registered pipeline-metrics queries.  The event log stands in for pipeline
telemetry: each user is a run, each event type a stage of it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import exp_histogram as X
from tessera.operators import metrics as M
from tessera.plans.registry import register, table

COMMON = {"pipeline": "events", "run_id": "r1", "event_type": "all"}
BOUNDS_SQL = ", ".join(
    f"('{'+Inf' if b == float('inf') else M._bound_text(b)}', {'1e308' if b == float('inf') else b})"
    for b in M.DEFAULT_BOUNDS
)


def _samples(spark, sf):
    ev = table(spark, sf, "events")
    return M.samples_from_groups(ev, "events_total", F.count(F.lit(1)), ["event_type"], M.COUNTER, COMMON,
                                 ts=F.lit("2024-01-31").cast("timestamp_ntz"))


@register(
    "metric_samples",
    """SELECT 'events_total' AS name, CAST(COUNT(*) AS DOUBLE) AS value, 'counter' AS type,
              'event_type="' || event_type || '",pipeline="events",run_id="r1"' AS labels_text
       FROM events GROUP BY event_type""",
)
def metric_samples(spark, sf):
    s = _samples(spark, sf)
    return s.select("name", "value", "type", M._label_text(F.col("labels")).alias("labels_text"))


@register(
    "metric_lines",
    """SELECT 'events_total' AS name, 0 AS section, '# HELP events_total Events by type' AS line
       UNION ALL SELECT 'events_total', 1, '# TYPE events_total counter'
       UNION ALL
       SELECT 'events_total' AS name, 2,
              'events_total{event_type="' || event_type || '",pipeline="events",run_id="r1"} '
              || CAST(CAST(COUNT(*) AS DOUBLE) AS VARCHAR) AS line
       FROM events GROUP BY event_type""",
)
def metric_lines(spark, sf):
    return M.exposition(_samples(spark, sf).withColumn("description", F.lit("Events by type")))


@register(
    "metric_histogram",
    f"""SELECT e.event_type, b.le, COUNT(*) FILTER (WHERE e.value / 100 <= b.bound) AS bucket_count,
               ROUND(s.total, 4) AS sum, s.n AS count
        FROM events e
        CROSS JOIN (VALUES {BOUNDS_SQL}) b(le, bound)
        JOIN (SELECT event_type, SUM(value / 100) AS total, COUNT(value) AS n FROM events GROUP BY 1) s
          ON s.event_type = e.event_type
        GROUP BY e.event_type, b.le, s.total, s.n""",
)
def metric_histogram(spark, sf):
    ev = table(spark, sf, "events").withColumn("seconds", F.col("value") / 100)
    h = M.histogram(ev, "seconds", ["event_type"])
    return h.withColumn("sum", F.round("sum", 4))


@register(
    "metric_summary",
    "\nUNION ALL\n".join(
        f"""SELECT event_type, {q} AS quantile, ROUND(quantile_cont(value, {q}), 4) AS value,
               ROUND(SUM(value), 2) AS sum, COUNT(value) AS count FROM events GROUP BY event_type"""
        for q in (0.5, 0.9, 0.99)
    ),
)
def metric_summary(spark, sf):
    s = M.summary(table(spark, sf, "events"), "value", ["event_type"], (0.5, 0.9, 0.99))
    return s.select("event_type", "quantile", F.round("value", 4).alias("value"), F.round("sum", 2).alias("sum"),
                    "count")


def _stages(spark, sf):
    ev = table(spark, sf, "events")
    return M.stage_runs_from_events(ev, "events", "user_id", "event_type", "ts", ok=F.col("value") > 50,
                                    failed_stage=F.col("event_type") == "error")


STAGES_SQL = """(SELECT 'events' AS pipeline, CAST(user_id AS VARCHAR) AS run_id, event_type AS stage,
        MIN(ts) AS started_at, MAX(ts) AS ended_at, COUNT(*) AS input_rows,
        COUNT(*) FILTER (WHERE value > 50) AS output_rows,
        CASE WHEN bool_or(event_type = 'error') THEN 'failed' ELSE 'success' END AS status
 FROM events GROUP BY user_id, event_type)"""

RUNS_SQL = f"""(SELECT pipeline, run_id, MIN(started_at) AS started_at, MAX(ended_at) AS ended_at,
        COUNT(*) AS stages, COUNT(*) FILTER (WHERE status = 'failed') AS failed_stages,
        SUM(input_rows) AS input_rows, SUM(output_rows) AS output_rows,
        (epoch_us(MAX(ended_at)) - epoch_us(MIN(started_at))) / 1000000.0 AS duration_seconds,
        CASE WHEN COUNT(*) FILTER (WHERE status = 'failed') > 0 THEN 'failed' ELSE 'success' END AS status
 FROM {STAGES_SQL} GROUP BY pipeline, run_id)"""


@register(
    "stage_rollup",
    f"""SELECT run_id, stage, started_at, ended_at, input_rows, output_rows, status,
               (epoch_us(ended_at) - epoch_us(started_at)) / 1000000.0 AS duration_seconds
        FROM {STAGES_SQL}""",
)
def stage_rollup(spark, sf):
    return M.stage_rollup(_stages(spark, sf)).select(
        "run_id", "stage", "started_at", "ended_at", "input_rows", "output_rows", "status", "duration_seconds"
    )


@register(
    "run_rollup",
    f"""SELECT run_id, started_at, ended_at, stages, failed_stages, CAST(input_rows AS BIGINT) AS input_rows,
               CAST(output_rows AS BIGINT) AS output_rows, duration_seconds, status FROM {RUNS_SQL}""",
)
def run_rollup(spark, sf):
    return M.run_rollup(_stages(spark, sf)).select(
        "run_id", "started_at", "ended_at", "stages", "failed_stages", "input_rows", "output_rows",
        "duration_seconds", "status"
    )


@register(
    "run_report",
    f"""SELECT r.run_id, r.status, r.duration_seconds, s.stage, s.input_rows, s.output_rows, s.status AS stage_status, r.run_id AS json_id,
               r.stages AS json_stages
        FROM {RUNS_SQL} r JOIN {STAGES_SQL} s ON r.run_id = s.run_id""",
)
def run_report(spark, sf):
    """The nested report taken apart again: a row per stage, with what the JSON text says."""
    rep = M.run_report(_stages(spark, sf))
    rows = rep.select("run_id", "status", "duration_seconds", "report_json", F.explode("stage_list").alias("s"))
    said = F.from_json("report_json", "run_id string, stage_list array<struct<stage: string>>")
    return rows.select("run_id", "status", "duration_seconds", "s.stage", "s.input_rows", "s.output_rows", F.col("s.status").alias("stage_status"),
                       said["run_id"].alias("json_id"), F.size(said["stage_list"]).cast("long").alias("json_stages"))


@register("stage_balance", f"SELECT run_id, stage, input_rows = output_rows AND status = 'success' AS balanced FROM {STAGES_SQL}")
def stage_balance(spark, sf):
    return M.stage_balance(_stages(spark, sf)).select("run_id", "stage", "balanced")


@register(
    "runs_report",
    f"""SELECT pipeline, COUNT(*) AS total_runs, COUNT(*) FILTER (WHERE status = 'success') AS successful_runs,
               COUNT(*) FILTER (WHERE status = 'failed') AS failed_runs,
               ROUND(SUM(duration_seconds), 3) AS total_duration_seconds
        FROM {RUNS_SQL} GROUP BY pipeline""",
)
def runs_report(spark, sf):
    r = M.runs_report(M.run_rollup(_stages(spark, sf)))
    return r.withColumn("total_duration_seconds", F.round("total_duration_seconds", 3))


ALERT_AS_OF = "2024-01-31 00:00:00"


@register(
    "alert_failures",
    f"""SELECT pipeline, COUNT(*) AS failed_runs FROM {RUNS_SQL}
        WHERE status = 'failed' AND ended_at > TIMESTAMP '{ALERT_AS_OF}' - INTERVAL 180 MINUTE
          AND ended_at <= TIMESTAMP '{ALERT_AS_OF}'
        GROUP BY pipeline""",
)
def alert_failures(spark, sf):
    return M.alert_failed_runs(M.run_rollup(_stages(spark, sf)), ALERT_AS_OF, minutes=180)


@register(
    "alert_slow",
    f"SELECT pipeline, run_id, duration_seconds FROM {RUNS_SQL} WHERE duration_seconds > 3600",
)
def alert_slow(spark, sf):
    return M.alert_slow_runs(M.run_rollup(_stages(spark, sf)), 3600)


EXP_SIZE = 24  # few buckets, so that histograms are brought to coarser scales
EXP_SQL = f"""WITH v AS (SELECT event_type, value - 50 AS v FROM events WHERE value IS NOT NULL),
near AS (SELECT *, abs(v) AS a, CAST(CASE WHEN v <> 0 THEN floor(log2(abs(v))) ELSE 0 END AS INTEGER) AS e FROM v),
split AS (SELECT *, e + CASE WHEN v = 0 THEN 0 WHEN a / pow(2.0, e) > 2 THEN 1 WHEN a / pow(2.0, e) <= 1 THEN -1 ELSE 0 END AS power FROM near),
fine AS (SELECT event_type, v, CAST(sign(v) AS INTEGER) AS sign,
                CASE WHEN v = 0 THEN 0 ELSE power * {2**X.SCALE} + len(list_filter({X.bounds(X.SCALE)[1:-1]}, lambda b: b < a / pow(2.0, power))) END AS idx
         FROM split),
spans AS (SELECT event_type, min(idx) FILTER (sign = 1) AS p0, max(idx) FILTER (sign = 1) AS p1,
                 min(idx) FILTER (sign = -1) AS m0, max(idx) FILTER (sign = -1) AS m1 FROM fine GROUP BY ALL),
downs AS (SELECT event_type, min(d) AS d FROM spans, (SELECT unnest(range(41)) AS d)
          WHERE coalesce(floor(p1 / pow(2, d)) - floor(p0 / pow(2, d)) < {EXP_SIZE}, TRUE)
            AND coalesce(floor(m1 / pow(2, d)) - floor(m0 / pow(2, d)) < {EXP_SIZE}, TRUE) GROUP BY ALL),
filled AS (SELECT event_type, {X.SCALE} - d AS scale, sign, CAST(floor(idx / pow(2, d)) AS BIGINT) AS idx, COUNT(*) AS n
           FROM fine JOIN downs USING (event_type) GROUP BY ALL)"""


def _exp_merged(spark, sf):
    """Histograms per event type and day, merged per event type."""
    ev = table(spark, sf, "events").select("event_type", F.to_date("ts").alias("day"), (F.col("value") - 50).alias("v"))
    return X.merge(X.build(ev, "v", ["event_type", "day"], size=EXP_SIZE), ["event_type"], size=EXP_SIZE)


@register("metric_exp_histogram", f"{EXP_SQL} SELECT * FROM filled")
def metric_exp_histogram(spark, sf):
    return X.buckets(_exp_merged(spark, sf), ["event_type"]).select("event_type", "scale", "sign", "idx", "n")


@register(
    "metric_exp_quantiles",
    f"""{EXP_SQL}, edges AS (
  SELECT event_type, sign, n, CASE sign WHEN 0 THEN 0 WHEN 1 THEN pow(2.0, idx / pow(2.0, scale)) ELSE -pow(2.0, (idx + 1) / pow(2.0, scale)) END AS lower,
         CASE sign WHEN 0 THEN 0 WHEN 1 THEN pow(2.0, (idx + 1) / pow(2.0, scale)) ELSE -pow(2.0, idx / pow(2.0, scale)) END AS upper FROM filled),
ranked AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY lower, upper) AS upto FROM edges),
ends AS (SELECT event_type, count(*) AS total, min(v) AS low, max(v) AS high FROM v GROUP BY ALL),
asked AS (SELECT event_type, q AS quantile, q * total AS rank, low, high FROM ends, (SELECT unnest({list(X.QUANTILES)}) AS q))
SELECT event_type, quantile, ROUND(least(greatest(
         CASE sign WHEN 0 THEN 0 WHEN 1 THEN lower * pow(upper / lower, (rank - upto + n) / n) ELSE lower * pow(upper / lower, (rank - upto + n) / n) END,
         low), high), 4) AS value
FROM asked JOIN ranked USING (event_type) WHERE rank > upto - n AND rank <= upto""",
)
def metric_exp_quantiles(spark, sf):
    return X.quantiles(_exp_merged(spark, sf), ["event_type"]).withColumn("value", F.round("value", 4))
