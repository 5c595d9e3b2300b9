"""Registered alert queries.

The event log stands in for the scraped samples of pipelines: an event type is a
pipeline, its running number of events since midnight a counter that restarts
with its process every day, and an event's value a gauge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import alerts as A
from tessera.plans.registry import register, table

AS_OF = "2024-01-30 12:00:00"

COUNTER_SQL = """counter AS (
  SELECT event_type, ts, CAST(row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS DOUBLE) AS value FROM events)"""
DELTA_SQL = """deltas AS (
  SELECT event_type, ts, CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END AS delta
  FROM (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY ts, value) AS before FROM counter))"""
GRID_SQL = """grid AS (
  SELECT t.event_type, g.tick FROM (SELECT DISTINCT event_type FROM events) t,
         (SELECT unnest(generate_series(date_trunc('hour', min(ts)), max(ts) + INTERVAL 1 HOUR, INTERVAL 1 MINUTE)) AS tick FROM events) g)"""


def instances_sql(holds: str, minutes: int, peak: str) -> str:
    """Islands of the one-minute grid points in ``holds``, an alert firing after ``minutes``."""
    return f"""
    SELECT event_type, started_at, CASE WHEN lasted >= {minutes} THEN started_at + INTERVAL {minutes} MINUTE END AS fired_at,
           CASE WHEN ended_at < TIMESTAMP '{AS_OF}' THEN ended_at + INTERVAL 1 MINUTE END AS resolved_at,
           CASE WHEN ended_at < TIMESTAMP '{AS_OF}' THEN CASE WHEN lasted >= {minutes} THEN 'resolved' ELSE 'cancelled' END
                ELSE CASE WHEN lasted >= {minutes} THEN 'firing' ELSE 'pending' END END AS state,
           evaluations, ROUND(peak, 4) AS peak
    FROM (SELECT event_type, min(tick) AS started_at, max(tick) AS ended_at, count(*) AS evaluations, max({peak}) AS peak,
                 datediff('minute', min(tick), max(tick)) AS lasted
          FROM (SELECT *, sum(fresh) OVER (PARTITION BY event_type ORDER BY tick) AS island
                FROM (SELECT *, CASE WHEN lag(tick) OVER (PARTITION BY event_type ORDER BY tick) = tick - INTERVAL 1 MINUTE THEN 0 ELSE 1 END AS fresh
                      FROM {holds} WHERE tick <= TIMESTAMP '{AS_OF}'))
          GROUP BY event_type, island)"""


def increase_sql(threshold: int) -> str:
    return f"""WITH {COUNTER_SQL}, {DELTA_SQL}, {GRID_SQL}, increases AS (
  SELECT g.event_type, g.tick, sum(d.delta) AS increase FROM grid g
  JOIN deltas d ON d.event_type = g.event_type AND d.ts > g.tick - INTERVAL 5 MINUTE AND d.ts <= g.tick GROUP BY ALL),
holds AS (SELECT * FROM increases WHERE increase > {threshold}) {instances_sql("holds", 1, "increase")}"""


def _counter(spark, sf) -> DataFrame:
    since = Window.partitionBy("event_type", F.to_date("ts")).orderBy("ts", "event_id")
    return table(spark, sf, "events").select("event_type", "ts", F.row_number().over(since).cast("double").alias("value"))


@register("counter_deltas", f"WITH {COUNTER_SQL}, {DELTA_SQL} SELECT event_type, ts, delta FROM deltas")
def counter_deltas(spark, sf):
    return A.counter_deltas(_counter(spark, sf), ["event_type"])


@register("alert_increase", increase_sql(0))
def alert_increase(spark, sf):
    """``increase(counter[5m]) > 0`` for 1m."""
    return A.increase_alerts(_counter(spark, sf), ["event_type"], AS_OF)


@register("alert_increase_burst", increase_sql(2))
def alert_increase_burst(spark, sf):
    """``increase(counter[5m]) > 2`` for 1m: some end before they fire."""
    return A.increase_alerts(_counter(spark, sf), ["event_type"], AS_OF, threshold=2)


@register(
    "alert_duration",
    f"""WITH {GRID_SQL}, seen AS (
  SELECT g.event_type, g.tick, arg_max(e.value, (e.ts, e.value)) AS value FROM grid g
  JOIN events e ON e.event_type = g.event_type AND e.ts >= g.tick - INTERVAL 5 MINUTE AND e.ts <= g.tick WHERE e.value IS NOT NULL GROUP BY ALL),
holds AS (SELECT * FROM seen WHERE value > 30) {instances_sql("holds", 5, "value")}""",
)
def alert_duration(spark, sf):
    """``gauge > 30`` for 5m, a sample being seen for 5 minutes."""
    out = A.threshold_alerts(table(spark, sf, "events"), ["event_type"], AS_OF, threshold=30)
    return out.withColumn("peak", F.round("peak", 4))
