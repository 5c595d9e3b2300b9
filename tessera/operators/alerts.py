"""Alert rules over metric samples: counter increases, gauge thresholds, pending and firing.

A rule is evaluated on a grid of ``step`` seconds.  A counter rule compares the
increase over the last ``range`` seconds, a gauge rule the last value not older
than ``lookback``.  An alert is *pending* from the first evaluation at which
its condition holds, *firing* from the first one at least ``hold`` seconds
later if the condition has held at every evaluation between, and *resolved* at the
first at which it does not hold.

Series may be of any size: what needs the sample before is read within time
buckets, with the last sample of the bucket before joined on; increases are
summed per grid cell before anything is shuffled.  Only grid points at which a
condition holds are put in order per series, whose number is bounded by time
over ``step``, however many samples there are.

Samples that are null, NaN, or without a time are left out.  Samples of one
time count in the order of their values.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import qcol

SECOND = 1_000_000


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def as_time(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def _samples(df: DataFrame, series: Sequence[str], ts: str, value: str) -> DataFrame:
    v = qcol(value).cast("double")
    rows = df.select(*[qcol(c) for c in series], micros(qcol(ts)).alias("__us"), v.alias("__v"))
    return rows.where(F.col("__us").isNotNull() & F.col("__v").isNotNull() & ~F.isnan("__v"))


def _with_neighbour(rows: DataFrame, series: Sequence[str], bucket_seconds: int, after: bool) -> DataFrame:
    """``rows`` with ``__other``: the struct (us, v) of the series' sample before (or after), null at its end.

    Within a time bucket by a window; at a bucket's edge from the nearest other
    bucket that has samples, which is known from one row per bucket.
    """
    keys = [f"__g{i}" for i in range(len(series))]
    bucket = F.floor(F.col("__us") / (bucket_seconds * SECOND)).alias("__b")
    rows = rows.select(*[qcol(c).alias(k) for c, k in zip(series, keys)], "__us", "__v", bucket)
    here = F.struct(F.col("__us").alias("us"), F.col("__v").alias("v"))
    edge = (F.min if after else F.max)(here).alias("__edge")  # of the bucket's samples the one next to the other bucket
    buckets = rows.groupBy(*keys, "__b").agg(edge)
    beyond = (F.lead if after else F.lag)("__edge").over(Window.partitionBy(*keys).orderBy("__b"))
    buckets = buckets.select(*[F.col(k).alias(f"{k}r") for k in keys], F.col("__b").alias("__br"), beyond.alias("__beyond"))
    in_bucket = Window.partitionBy(*keys, "__b").orderBy("__us", "__v")
    near = rows.withColumn("__near", (F.lead if after else F.lag)(here).over(in_bucket))
    same = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"{k}r")) for k in keys], F.col("__b") == F.col("__br"))
    names = [F.col(k).alias(c) for k, c in zip(keys, series)]
    return near.join(buckets, same).select(*names, "__us", "__v", F.coalesce("__near", "__beyond").alias("__other"))


def counter_deltas(samples: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value", bucket_seconds: int = 3600) -> DataFrame:
    """Per sample what the counter grew by since the series' sample before: series, ``ts``, ``delta``.

    A value below the one before is a reset: the counter began again at 0, so
    all of the value is growth.  A series' first sample has no growth.
    """
    rows = _with_neighbour(_samples(samples, series, ts, value), series, bucket_seconds, after=False)
    before = F.col("__other.v")
    grown = F.when(before.isNull(), 0.0).when(F.col("__v") < before, F.col("__v")).otherwise(F.col("__v") - before)
    return rows.select(*[qcol(c) for c in series], as_time(F.col("__us")).alias("ts"), grown.alias("delta"))


def counter_increase(
    samples: DataFrame, series: Sequence[str], range_seconds: int = 300, step_seconds: int = 60, ts: str = "ts", value: str = "value"
) -> DataFrame:
    """series, ``at``, ``increase``: at each grid point the growth over the ``range_seconds`` up to it, where there is a sample in them.

    A sample counts at the grid points in [its time, its time + range): those
    whose left-open range holds it.
    """
    if range_seconds <= 0 or step_seconds <= 0 or range_seconds % step_seconds:
        raise ValueError("the range must be a positive multiple of the step")
    step, keys = step_seconds * SECOND, [qcol(c) for c in series]
    deltas = counter_deltas(samples, series, ts, value)
    cell = F.ceil(micros(F.col("ts")) / step) * step
    cells = deltas.groupBy(*keys, cell.alias("__cell")).agg(F.sum("delta").alias("__d"))
    points = F.sequence(F.col("__cell"), F.col("__cell") + (range_seconds // step_seconds - 1) * step, F.lit(step))
    at = cells.select(*keys, F.explode(points).alias("__at"), "__d")
    summed = at.groupBy(*keys, "__at").agg(F.sum("__d").alias("increase"))
    return summed.select(*keys, as_time(F.col("__at")).alias("at"), "increase")


def gauge_values(
    samples: DataFrame, series: Sequence[str], lookback_seconds: int = 300, step_seconds: int = 60, ts: str = "ts", value: str = "value"
) -> DataFrame:
    """series, ``at``, ``value``: at each grid point the last sample not older than ``lookback_seconds``."""
    step, keys = step_seconds * SECOND, [qcol(c) for c in series]
    rows = _with_neighbour(_samples(samples, series, ts, value), series, 3600, after=True)
    stale = F.col("__us") + lookback_seconds * SECOND  # seen up to here, and before the sample after
    first, last = F.ceil(F.col("__us") / step) * step, F.floor(stale / step) * step
    last = F.least(last, F.ceil(F.col("__other.us") / step) * step - step)
    points = F.when(first <= last, F.sequence(first, last, F.lit(step)))
    return rows.select(*keys, F.explode(points).alias("__at"), F.col("__v").alias("value")).select(*keys, as_time(F.col("__at")).alias("at"), "value")


def alert_instances(holds: DataFrame, series: Sequence[str], hold_seconds: int, as_of, step_seconds: int = 60, peak: str | None = None) -> DataFrame:
    """One row per stretch of grid points (``at``) at which a condition holds, as known at the evaluation of ``as_of``.

    series, ``started_at``, ``fired_at`` (null if it never held long enough),
    ``resolved_at`` (null while it holds at ``as_of``), ``state``
    (pending, firing, resolved, or cancelled: ended without firing),
    ``evaluations``, and ``peak``, the greatest value of that column.
    """
    step, keys = step_seconds * SECOND, [qcol(c) for c in series]
    now = F.floor(micros(F.lit(str(as_of)).cast("timestamp_ntz")) / step) * step
    points = holds.select(*keys, micros(F.col("at")).alias("__at"), (qcol(peak).cast("double") if peak else F.lit(None).cast("double")).alias("__p"))
    points = points.where(F.col("__at") <= now)
    # consecutive grid points have one difference to their rank
    island = F.col("__at") - F.row_number().over(Window.partitionBy(*keys).orderBy("__at")).cast("long") * step
    runs = points.withColumn("__island", island).groupBy(*keys, "__island").agg(
        F.min("__at").alias("__start"), F.max("__at").alias("__end"), F.count(F.lit(1)).alias("evaluations"), F.max("__p").alias("peak")
    )
    wait = -(-hold_seconds // step_seconds) * step  # the first evaluation at least so much later
    fired = F.when(F.col("__end") - F.col("__start") >= wait, F.col("__start") + wait)
    resolved = F.when(F.col("__end") < now, F.col("__end") + step)
    state = (
        F.when(resolved.isNull() & fired.isNull(), "pending").when(resolved.isNull(), "firing").when(fired.isNull(), "cancelled").otherwise("resolved")
    )
    return runs.select(
        *keys, as_time(F.col("__start")).alias("started_at"), as_time(fired).alias("fired_at"), as_time(resolved).alias("resolved_at"),
        state.alias("state"), "evaluations", "peak",
    )


def increase_alerts(
    samples: DataFrame, series: Sequence[str], as_of, threshold: float = 0.0, range_seconds: int = 300, hold_seconds: int = 60,
    step_seconds: int = 60, ts: str = "ts", value: str = "value",
) -> DataFrame:
    """Alerts of ``increase(counter[range]) > threshold`` that must hold for ``hold_seconds``."""
    holds = counter_increase(samples, series, range_seconds, step_seconds, ts, value).where(F.col("increase") > threshold)
    return alert_instances(holds, series, hold_seconds, as_of, step_seconds, "increase")


def threshold_alerts(
    samples: DataFrame, series: Sequence[str], as_of, threshold: float = 3600.0, hold_seconds: int = 300, lookback_seconds: int = 300,
    step_seconds: int = 60, ts: str = "ts", value: str = "value",
) -> DataFrame:
    """Alerts of ``gauge > threshold`` that must hold for ``hold_seconds``."""
    holds = gauge_values(samples, series, lookback_seconds, step_seconds, ts, value).where(F.col("value") > threshold)
    return alert_instances(holds, series, hold_seconds, as_of, step_seconds, "value")
