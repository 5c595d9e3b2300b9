"""Registered queries over validity intervals.

Each day's last event of every user that was active on that day is the day's snapshot of a table of users.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import history as H
from tessera.plans.registry import register, table
from tessera.session import scratch_path

FIRST, SECOND = "2024-01-10", "2024-01-20"

SNAPSHOTS_SQL = """snaps AS (
  SELECT CAST(ts AS DATE) AS day, user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value > 50, (ts, event_id)) AS large
  FROM events GROUP BY ALL),
times AS (SELECT day, row_number() OVER (ORDER BY day) AS no FROM (SELECT DISTINCT day FROM snaps))"""
# by comparing each snapshot with the one before and the one after
INTERVALS_SQL = f"""{SNAPSHOTS_SQL}, numbered AS (SELECT snaps.*, no FROM snaps JOIN times USING (day)),
starts AS (SELECT n.*, (p.user_id IS NULL) AS begins FROM numbered n LEFT JOIN numbered p
           ON p.no = n.no - 1 AND p.user_id = n.user_id AND p.event_type = n.event_type AND p.large = n.large),
runs AS (SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY no) AS run FROM starts),
history AS (SELECT user_id, event_type, large, min(r.day) AS valid_from, any_value(t.day) AS valid_to
            FROM (SELECT user_id, run, any_value(event_type) AS event_type, any_value(large) AS large, min(day) AS day, max(no) AS last FROM runs GROUP BY ALL) r
            LEFT JOIN times t ON t.no = r.last + 1 GROUP BY user_id, run, event_type, large)"""


def _snapshots(spark, sf):
    last = F.struct("ts", "event_id")
    ev = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day"), "user_id")
    return ev.agg(F.max_by("event_type", last).alias("event_type"), F.max_by(F.col("value") > 50, last).alias("large"))


def _history(spark, sf):
    """Written and read back, as a history is stored."""
    path = scratch_path(spark, "history")
    H.from_snapshots(_snapshots(spark, sf), ["user_id"], "day").write.parquet(path)
    return spark.read.parquet(path)


@register("history_intervals", f"WITH {INTERVALS_SQL} SELECT * FROM history")
def history_intervals(spark, sf):
    return _history(spark, sf)


@register("history_extended", f"WITH {INTERVALS_SQL} SELECT * FROM history")
def history_extended(spark, sf):
    """The history of all days but the last two, then one more snapshot at a time."""
    snaps = _snapshots(spark, sf)
    path = scratch_path(spark, "snapshots")
    snaps.write.partitionBy("day").parquet(path)
    snaps = spark.read.parquet(path)
    *early, before, last = sorted(r["day"] for r in snaps.select("day").distinct().collect())  # one row a day
    history = H.from_snapshots(snaps.where(F.col("day") <= F.lit(early[-1])), ["user_id"], "day").select("user_id", "event_type", "large", "valid_from", "valid_to")
    for day in (before, last):
        history = H.extend(history, snaps.where(F.col("day") == F.lit(day)).drop("day"), ["user_id"], F.lit(day))
    return history


@register("history_as_of", f"WITH {SNAPSHOTS_SQL} SELECT user_id, event_type, large FROM snaps WHERE day = DATE '{FIRST}'")
def history_as_of(spark, sf):
    return H.as_of(_history(spark, sf), F.lit(FIRST).cast("date"))


@register(
    "history_diff",
    f"""WITH {SNAPSHOTS_SQL}, a AS (SELECT * FROM snaps WHERE day = DATE '{FIRST}'), b AS (SELECT * FROM snaps WHERE day = DATE '{SECOND}')
        SELECT coalesce(a.user_id, b.user_id) AS user_id,
               CASE WHEN a.user_id IS NULL THEN 'insert' WHEN b.user_id IS NULL THEN 'delete' ELSE 'update' END AS change,
               a.event_type AS type_before, b.event_type AS type_after, a.large AS large_before, b.large AS large_after
        FROM a FULL JOIN b ON a.user_id = b.user_id
        WHERE a.user_id IS NULL OR b.user_id IS NULL OR a.event_type <> b.event_type OR a.large <> b.large""",
)
def history_diff(spark, sf):
    d = H.diff(_history(spark, sf), ["user_id"], F.lit(FIRST).cast("date"), F.lit(SECOND).cast("date"))
    return d.select("user_id", "change", F.col("before.event_type").alias("type_before"), F.col("after.event_type").alias("type_after"),
                    F.col("before.large").alias("large_before"), F.col("after.large").alias("large_after"))


@register(
    "history_changes",
    f"""WITH {SNAPSHOTS_SQL}, days AS (SELECT no, day, (SELECT day FROM times n WHERE n.no = t.no - 1) AS prior FROM times t)
        SELECT coalesce(b.user_id, a.user_id) AS user_id, d.day AS at,
               CASE WHEN a.user_id IS NULL THEN 'insert' WHEN b.user_id IS NULL THEN 'delete' ELSE 'update' END AS change,
               coalesce(b.event_type, a.event_type) AS event_type, coalesce(b.large, a.large) AS large
        FROM (SELECT d.day, d.prior, s.user_id FROM days d JOIN snaps s ON s.day = d.day OR s.day = d.prior GROUP BY ALL) d
        LEFT JOIN snaps a ON a.day = d.prior AND a.user_id = d.user_id LEFT JOIN snaps b ON b.day = d.day AND b.user_id = d.user_id
        WHERE a.user_id IS NULL OR b.user_id IS NULL OR a.event_type <> b.event_type OR a.large <> b.large""",
)
def history_changes(spark, sf):
    return H.changes(_history(spark, sf), ["user_id"])
