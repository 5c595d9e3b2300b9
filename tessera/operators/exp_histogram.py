"""Exponential histograms: buckets that follow the data, merged by coarsening.

At scale ``s`` bucket ``i`` holds the values in (2^(i / 2^s), 2^((i + 1) / 2^s)]; every step down
in scale joins two neighbours, so a histogram of a finer scale can always be brought
to a coarser one without its values.  A histogram is one row: its groups and

``count, sum, min, max, zero_count, scale, offset, counts, negative_offset, negative_counts``

with ``counts[k]`` the number of values in bucket ``offset + k`` (null offset: none) and the
same for the sizes of negative values.  Its scale is the finest, up to the one
recorded at, at which neither side spans more than ``size`` buckets.  That
depends on the least and greatest bucket only, so merging is associative: any order
and grouping of merges gives the histogram of all values at once.

Bucket numbers are exact: the power of two is split off, and the rest
compared with the bounds as doubles, which logarithms alone would miss
for values on or beside a bound.

Nulls, NaN and infinite values are left out.  Counting is a partial and final aggregate per
bucket; the windows and lists after it hold at most the buckets of one group, a number
bounded by the scale and the range of doubles.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import qcol

#: Scale at which values are recorded (buckets 2.2 % wide), most buckets a side, quantiles.
SCALE, SIZE, QUANTILES = 5, 160, (0.5, 0.9, 0.99)
STATS = ["count", "sum", "min", "max", "zero_count", "scale", "offset", "counts", "negative_offset", "negative_counts"]


def bounds(scale: int) -> list[float]:
    """Lower bounds of the buckets between 1 and 2, and 2."""
    return [2.0 ** (j / 2**scale) for j in range(2**scale + 1)]


def bucket(size: Column, scale: int = SCALE) -> Column:
    """Number of the bucket of a positive finite double."""
    n = 2**scale
    tiny = size < 2.0**-1000  # its power of two may be below all doubles
    size = F.when(tiny, size * 2.0**100).otherwise(size)
    near = F.floor(F.log2(size)).cast("int")
    rest = size / F.pow(F.lit(2.0), near)  # exact; the logarithm may be one off where it is close to a whole number
    power = near + F.when(rest > 2, 1).when(rest <= 1, -1).otherwise(0)
    rest = size / F.pow(F.lit(2.0), power)  # in (1, 2]
    edges = F.array(*[F.lit(b) for b in bounds(scale)])
    guess = F.least(F.greatest(F.ceil(F.log2(rest) * n) - 1, F.lit(0)), F.lit(n - 1)).cast("int")
    part = guess + F.when(rest <= F.element_at(edges, guess + 1), -1).when(rest > F.element_at(edges, guess + 2), 1).otherwise(0)
    return (power - F.when(tiny, 100).otherwise(0)).cast("long") * n + part


def _fit(rows: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """One histogram per group from rows (keys, scale, sign, idx, n, sum, min, max).

    Sign 0 rows count zeros; sums and extremes may stand on any rows.
    """
    group = Window.partitionBy(*keys)
    summed = [F.sum("n").alias("n"), F.sum("sum").alias("sum"), F.min("min").alias("min"), F.max("max").alias("max")]
    known = rows.groupBy(*keys, "scale", "sign", "idx").agg(*summed)
    known = known.withColumn("base", F.min("scale").over(group)).withColumn("idx", F.expr("shiftright(idx, scale - base)"))
    side = {"p": F.when(F.col("sign") == 1, F.col("idx")), "m": F.when(F.col("sign") == -1, F.col("idx"))}
    known = known.withColumns({f"{f}_{s}": getattr(F, f)(c).over(group) for s, c in side.items() for f in ("min", "max")})
    fits = " AND ".join(f"coalesce(shiftright(max_{s}, d) - shiftright(min_{s}, d) < {int(size)}, true)" for s in side)
    known = known.withColumn("down", F.expr(f"array_min(filter(sequence(0, 40), d -> {fits}))"))
    fitted = known.withColumns({"scale": F.col("base") - F.col("down"), "idx": F.expr("shiftright(idx, down)")})
    fitted = fitted.groupBy(*keys, "scale", "sign", "idx").agg(*summed)

    def of(sign: int, then: Column) -> Column:
        return F.when(F.col("sign") == sign, then)

    entries = {s: F.collect_list(of(v, F.struct("idx", "n"))) for s, v in (("p", 1), ("m", -1))}  # nulls are left out
    out = fitted.groupBy(*keys, "scale").agg(
        F.sum("n").alias("count"), F.sum("sum").alias("sum"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.coalesce(F.sum(of(0, F.col("n"))), F.lit(0)).alias("zero_count"),
        F.min(of(1, F.col("idx"))).alias("offset"), F.max(of(1, F.col("idx"))).alias("max_p"),
        F.min(of(-1, F.col("idx"))).alias("negative_offset"), F.max(of(-1, F.col("idx"))).alias("max_m"),
        F.map_from_entries(entries["p"]).alias("map_p"), F.map_from_entries(entries["m"]).alias("map_m"),
    )

    def dense(low: str, high: str, numbers: str) -> Column:
        filled = F.transform(F.sequence(low, high), lambda i: F.coalesce(F.try_element_at(numbers, i), F.lit(0).cast("long")))
        return F.when(F.col(low).isNull(), F.array().cast("array<bigint>")).otherwise(filled)

    out = out.withColumns({"counts": dense("offset", "max_p", "map_p"), "negative_counts": dense("negative_offset", "max_m", "map_m")})
    return out.select(*keys, *STATS)


def build(df: DataFrame, value: str, groups: Sequence[str] = (), scale: int = SCALE, size: int = SIZE) -> DataFrame:
    """One histogram per group of the finite values of a column."""
    if not 0 <= scale <= 10 or size < 2:
        raise ValueError("the scale must be between 0 and 10, the size 2 or more")
    v = qcol(value).cast("double")
    keys = [f"__g{i}" for i in range(len(groups))]
    rows = df.select(*[qcol(c).alias(k) for c, k in zip(groups, keys)], v.alias("v"))
    rows = rows.where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")))
    sign = F.signum("v").cast("int")
    idx = F.when(sign == 0, F.lit(0)).otherwise(bucket(F.abs("v"), scale)).cast("long")
    rows = rows.select(*keys, F.lit(scale).alias("scale"), sign.alias("sign"), idx.alias("idx"), F.lit(1).cast("long").alias("n"),
                       F.col("v").alias("sum"), F.col("v").alias("min"), F.col("v").alias("max"))
    return _fit(rows, keys, size).withColumnsRenamed(dict(zip(keys, groups)))


def merge(histograms: DataFrame, groups: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """One histogram per group from histograms of any scales."""
    keys = [f"__g{i}" for i in range(len(groups))]
    long, none = "bigint", F.lit(None).cast("double")

    def side(sign: int, offset: str, counts: str) -> Column:
        rows = F.transform(counts, lambda n, k: F.struct(
            F.lit(sign).alias("sign"), (F.col(offset) + k).cast(long).alias("idx"), n.alias("n"), none.alias("sum"), none.alias("min"), none.alias("max")
        ))
        return F.filter(rows, lambda x: x["n"] > 0)

    zero = F.array(F.struct(F.lit(0).alias("sign"), F.lit(0).cast(long).alias("idx"), F.col("zero_count").alias("n"), "sum", "min", "max"))
    rows = histograms.select(
        *[qcol(c).alias(k) for c, k in zip(groups, keys)], "scale",
        F.inline(F.concat(zero, side(1, "offset", "counts"), side(-1, "negative_offset", "negative_counts"))),
    )
    return _fit(rows, keys, size).withColumnsRenamed(dict(zip(keys, groups)))


def buckets(histograms: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """A row per bucket that holds values: groups, ``scale``, ``sign``, ``idx``, ``lower``, ``upper`` (lower < upper), ``n``."""

    def side(sign: int, offset: str, counts: str) -> Column:
        rows = F.transform(counts, lambda n, k: F.struct(F.lit(sign).alias("sign"), (F.col(offset) + k).alias("idx"), n.alias("n")))
        return F.filter(rows, lambda x: x["n"] > 0)

    zero = F.filter(F.array(F.struct(F.lit(0).alias("sign"), F.lit(0).cast("bigint").alias("idx"), F.col("zero_count").alias("n"))), lambda x: x["n"] > 0)
    rows = histograms.select(
        *[qcol(c) for c in groups], "scale",
        F.inline(F.concat(side(-1, "negative_offset", "negative_counts"), zero, side(1, "offset", "counts"))),
    )
    near, far = (F.pow(F.lit(2.0), (F.col("idx") + k) / F.pow(F.lit(2.0), F.col("scale"))) for k in (0, 1))
    lower = F.when(F.col("sign") == 0, 0.0).when(F.col("sign") == 1, near).otherwise(-far)
    upper = F.when(F.col("sign") == 0, 0.0).when(F.col("sign") == 1, far).otherwise(-near)
    return rows.select(*[qcol(c) for c in groups], "scale", "sign", "idx", lower.alias("lower"), upper.alias("upper"), "n")


def quantiles(histograms: DataFrame, groups: Sequence[str] = (), wanted: Sequence[float] = QUANTILES) -> DataFrame:
    """groups, ``quantile``, ``value``: interpolated within the bucket that holds the rank, evenly in the logarithm, between min and max.

    Off by at most the bucket's width, a factor of 2^(2^-scale).
    """
    keys = ["__one", *[f"__g{i}" for i in range(len(groups))]]
    named = histograms.withColumnsRenamed(dict(zip(groups, keys[1:]))).withColumn("__one", F.lit(1))
    rows = buckets(named, keys)
    upto = Window.partitionBy(*keys).orderBy("lower", "upper")  # a group's buckets: at most twice the size, and zero
    rows = rows.withColumn("upto", F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("before", F.col("upto") - F.col("n"))
    asked = named.where("count > 0").select(
        *[F.col(k).alias(f"{k}r") for k in keys], "count", "min", "max", F.explode(F.array(*[F.lit(float(q)) for q in wanted])).alias("quantile")
    )
    same = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"{k}r")) for k in keys])
    rank = F.col("quantile") * F.col("count")
    holds = (rank > F.col("before")) & (rank <= F.col("upto")) | (F.col("quantile") <= 0) & (F.col("before") == 0)
    found = asked.join(rows, same & holds)
    share = (rank - F.col("before")) / F.col("n")
    inside = (
        F.when(F.col("sign") == 0, 0.0)
        .when(F.col("sign") == 1, F.col("lower") * F.pow(F.col("upper") / F.col("lower"), share))
        .otherwise(-(F.abs("lower") * F.pow(F.col("upper") / F.col("lower"), share)))
    )
    value = F.least(F.greatest(inside, "min"), "max")
    return found.select(*[F.col(f"{k}r").alias(c) for k, c in zip(keys[1:], groups)], "quantile", value.alias("value"))
