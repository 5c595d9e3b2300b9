"""Registered queries over streams whose results depend on all rows so far.

The events arrive in parts, a file and a micro-batch each, in the order of time but for some
that come with the last part.
"""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.plans.quality_queries import REPORT_COLS
from tessera.plans.registry import register, table
from tessera.session import scratch_path
from tessera.streaming import ingest as S
from tessera.streaming import stateful as W

CUTS = ["2024-01-08", "2024-01-16", "2024-01-24"]
LATE = "event_id % 50 = 7 AND ts < TIMESTAMP '2024-01-10'"
PART = " + ".join(f"CAST(ts >= TIMESTAMP '{c}' AS INT)" for c in CUTS)


def _parts(spark, df, name):
    """A folder with one file per part of ``df``, written in order, and its stream, a file at a time."""
    path = scratch_path(spark, name)
    df = df.withColumn("part", F.expr(f"CASE WHEN {LATE.replace('TIMESTAMP ', 'TIMESTAMP_NTZ ')} THEN {len(CUTS)} ELSE {PART.replace('TIMESTAMP ', 'TIMESTAMP_NTZ ')} END"))
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    for k in range(len(CUTS) + 1):
        df.where(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(path)
    return S.read_files(spark, path, df.drop("part").schema, format="parquet", max_files_per_trigger=1)


def _rules():
    return [Q.in_range("value", min_val=1, max_val=99), Q.unique("event_id"), Q.no_duplicates(["user_id", "event_type"]), Q.in_set("event_type", ["click", "view"]),
            Q.not_null("props"), Q.row_count(min_count=1000), Q.column_exists(["ts", "nope"]), Q.custom("total_positive", F.sum("value") > 0, "no total")]


def _fails(cond: str) -> str:
    return f"(SELECT COUNT(*) FILTER (WHERE {cond}) AS f, COUNT(*) AS t FROM events)"


_RULE_SQL = [
    ("in_range_value", "in_range", "'value'", _fails("value < 1 OR value > 99")),
    ("unique_event_id", "unique", "'event_id'", "(SELECT COUNT(*) - COUNT(DISTINCT event_id) AS f, COUNT(*) AS t FROM events)"),
    ("no_duplicates", "no_duplicates", "'user_id,event_type'",
     "(SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) AS f, COUNT(*) AS t FROM events)"),
    ("in_set_event_type", "in_set", "'event_type'", _fails("event_type NOT IN ('click', 'view')")),
    ("not_null_props", "not_null", "'props'", _fails("props IS NULL")),
    ("row_count", "row_count", "NULL", "(SELECT CAST(COUNT(*) < 1000 AS INT) AS f, 1 AS t FROM events)"),
    ("column_exists", "column_exists", "NULL", "(SELECT 1 AS f, 2 AS t)"),
    ("total_positive", "total_positive", "NULL", "(SELECT CAST(SUM(value) <= 0 AS INT) AS f, 1 AS t FROM events)"),
]


@register(
    "stream_rules_state",
    "\nUNION ALL\n".join(
        f"""SELECT {i} AS ordinal, '{rule}' AS rule, '{name}' AS rule_name, {column} AS "column", CASE WHEN f = 0 THEN 'passed' ELSE 'failed' END AS status,
            'error' AS severity, CAST(f AS BIGINT) AS failed_count, CAST(t AS BIGINT) AS total_count, CAST(f AS DOUBLE) / t AS failure_rate,
            (SELECT COUNT(*) FROM events) AS frame_rows FROM {source}"""
        for i, (rule, name, column, source) in enumerate(_RULE_SQL)
    ),
)
def stream_rules_state(spark, sf):
    """Rules over a stream that is stopped and started again between its files: the report of all rows."""
    stream = _parts(spark, table(spark, sf, "events"), "rules_in")
    state = W.RuleState(stream, _rules(), scratch_path(spark, "rules_state"))
    for _ in range(2):  # the second start finds nothing new
        for query in state.start(stream):
            query.awaitTermination()
    return state.report().select(*REPORT_COLS)


JOIN_SQL = f"""WITH parts AS (SELECT *, CASE WHEN {LATE} THEN {len(CUTS)} ELSE {PART} END AS part FROM events WHERE event_type IN ('click', 'purchase')),
ends AS (SELECT event_type, part, max(ts) AS last FROM parts GROUP BY ALL),
judged AS (SELECT p.*, coalesce(p.ts < (SELECT max(last) FROM ends e WHERE e.event_type = p.event_type AND e.part < p.part) - INTERVAL 10 MINUTE, FALSE) AS late
           FROM parts p),
l AS (SELECT * FROM judged WHERE NOT late AND event_type = 'click'), r AS (SELECT * FROM judged WHERE NOT late AND event_type = 'purchase'),
shut AS (SELECT least((SELECT max(ts) FROM l), (SELECT max(ts) FROM r)) - INTERVAL 10 MINUTE AS bound)"""


@register(
    "stream_join_outer",
    f"""{JOIN_SQL} SELECT l.event_id, l.user_id, r.event_id AS r_event_id FROM l LEFT JOIN r
        ON r.user_id = l.user_id AND r.ts >= l.ts AND r.ts <= l.ts + INTERVAL 6 HOUR
        WHERE r.event_id IS NOT NULL OR l.ts + INTERVAL 6 HOUR < (SELECT bound FROM shut)""",
)
def stream_join_outer(spark, sf):
    """Clicks with the purchases of the six hours after them, from two streams; clicks without any once no more can come."""
    sides = []
    for kind in ("click", "purchase"):
        path = scratch_path(spark, f"join-{kind}")
        arriving = _parts(spark, table(spark, sf, "events").where(F.col("event_type") == kind), f"join-in-{kind}")
        W.split_late(arriving, "ts", 600, path).awaitTermination()
        on_time = spark.read.parquet(f"{path}/on_time")
        sides.append(S.read_files(spark, f"{path}/on_time", on_time.schema, format="parquet").drop("batch_id"))
    out = scratch_path(spark, "joined")
    joined = W.interval_join(*sides, "user_id", "ts", "ts", "6 hours", "10 minutes")
    joined.select("event_id", "user_id", "r_event_id").writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", scratch_path(spark, "joined-checkpoint")
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


@register("stream_late_rows", f"{JOIN_SQL} SELECT event_id, event_type, CAST(part AS INTEGER) AS part FROM judged WHERE late")
def stream_late_rows(spark, sf):
    """The rows of both streams that came too late, with the micro-batch they came in."""
    frames = []
    for kind in ("click", "purchase"):
        path = scratch_path(spark, f"late-{kind}")
        W.split_late(_parts(spark, table(spark, sf, "events").where(F.col("event_type") == kind), f"late-in-{kind}"), "ts", 600, path).awaitTermination()
        frames.append(spark.read.parquet(f"{path}/late").select("event_id", "event_type", F.col("batch_id").cast("int").alias("part")))
    return functools.reduce(lambda a, b: a.unionByName(b), frames)
