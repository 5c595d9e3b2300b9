"""Aggregations and joins: the event analytics queries, group summaries,
duplicate-key and null-count reports, and a size-checked dimension join.

All aggregates are declarative, so Spark plans them as partial (map-side)
plus final hash aggregates: a key that holds a third of the rows collapses
to one row per input partition before the shuffle.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import count_where, qcol


def with_event_date(events: DataFrame, ts_col: str = "ts", date_col: str = "date") -> DataFrame:
    """Materialise the calendar day of the event time (the table's partition key)."""
    if date_col in events.columns:
        return events
    return events.withColumn(date_col, F.to_date(qcol(ts_col)))


def daily_event_counts(events: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Q1: events per day and type, newest day first, busiest type first."""
    return (
        with_event_date(events, ts_col)
        .groupBy("date", "event_type")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.col("date").desc(), F.col("event_count").desc())
    )


def user_activity(events: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Q2: per user the number of distinct event types, events, first and last event."""
    return (
        events.groupBy("user_id")
        .agg(
            F.count_distinct("event_type").alias("unique_events"),
            F.count(F.lit(1)).alias("total_events"),
            F.min(qcol(ts_col)).alias("first_event"),
            F.max(qcol(ts_col)).alias("last_event"),
        )
        .orderBy(F.col("total_events").desc())
    )


def hourly_counts(
    events: DataFrame,
    as_of: str | _dt.date,
    days: int = 7,
    ts_col: str = "ts",
) -> DataFrame:
    """Q3: events per hour over the ``days`` days up to ``as_of`` (a parameter,
    not ``CURRENT_DATE``, so the result is reproducible).

    The day filter is on the date key, so a table partitioned by day prunes;
    the same bound is also stated on the raw timestamp so a Parquet scan can
    skip row groups by their min/max statistics.
    """
    lo_day = F.date_sub(F.lit(str(as_of)).cast("date"), days)
    dated = with_event_date(events, ts_col)
    ts = qcol(ts_col)
    hour = F.date_trunc("hour", ts).cast(events.schema[ts_col].dataType)
    return (
        dated.where((F.col("date") >= lo_day) & (ts >= lo_day.cast(events.schema[ts_col].dataType)))
        .groupBy(hour.alias("hour"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .orderBy(F.col("hour").desc())
    )


def group_summary(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """``groupBy(keys).agg(name=expr, ...)`` with every output aliased."""
    return df.groupBy(*[qcol(k) for k in keys]).agg(*[e.alias(n) for n, e in aggs.items()])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (HAVING count > 1)."""
    return (
        df.groupBy(*[qcol(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("dup_count"))
        .where(F.col("dup_count") > 1)
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the NULL count of every column, in one pass."""
    cols = list(columns) if columns is not None else df.columns
    return df.agg(*[count_where(qcol(c).isNull()).alias(c) for c in cols])


def global_metrics(df: DataFrame, column: str) -> DataFrame:
    """count / sum / avg / min / max of one column in one aggregate."""
    c = qcol(column)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(c).alias("total"),
        F.avg(c).alias("average"),
        F.min(c).alias("minimum"),
        F.max(c).alias("maximum"),
    )


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a fact table to a dimension.  No hint: the planner broadcasts a
    side by its size in bytes, known at planning or, with AQE, at run time."""
    return fact.join(dim, on, how)
