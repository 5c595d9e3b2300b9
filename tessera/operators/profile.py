"""One-pass column profile.

Every statistic of every column is an aggregate in a single ``df.agg``; the
one result row is unpivoted to one row per column with ``inline``.  Very wide
tables are profiled in chunks of columns so the generated code stays within
JVM method limits; each chunk reads only its own columns (column pruning), so
the bytes read stay those of one pass.

Numeric statistics apply to every numeric type.  Extremes keep the column's
own type: ``min``/``max`` for float and double, ``min_exact``/``max_exact``
(their text) for integers and decimals, which a double cannot hold.  String
statistics apply to strings only; nested types get the common part (nulls, approximate distinct count
where the type is hashable).
"""

from __future__ import annotations

import decimal
import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("type_name", T.StringType()),
        T.StructField("nullable", T.BooleanType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("total_columns", T.IntegerType()),
        T.StructField("null_count", T.LongType()),
        T.StructField("null_percentage", T.DoubleType()),
        T.StructField("approx_distinct_count", T.LongType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
        T.StructField("min_exact", T.StringType()),
        T.StructField("max_exact", T.StringType()),
        T.StructField("avg", T.DoubleType()),
        T.StructField("stddev", T.DoubleType()),
        T.StructField("min_length", T.IntegerType()),
        T.StructField("max_length", T.IntegerType()),
        T.StructField("avg_length", T.DoubleType()),
        T.StructField("empty_count", T.LongType()),
    ]
)

#: Columns per aggregate, a parameter.  One aggregate over more would pass the
#: JVM's limit on generated code; each further aggregate is one more scan, of
#: its own columns only, so the bytes read stay those of one pass.
CHUNK = 50


def _distinct_ok(dtype: T.DataType) -> bool:
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _column_stats(i: int, field: T.StructField, n_cols: int) -> tuple[list[str], str]:
    """Aggregates of one column and the struct that reads them back, as SQL text.

    Text, because building columns one call at a time costs the driver more than the job.
    """
    c, dt = _quoted(field.name), field.dataType
    numeric, text = isinstance(dt, T.NumericType), isinstance(dt, T.StringType)
    inexact = isinstance(dt, (T.FloatType, T.DoubleType))
    aggs = {"nulls": f"count_if({c} IS NULL)"}
    if _distinct_ok(dt):
        aggs["ndv"] = f"approx_count_distinct({c})"
    if numeric:
        aggs |= {"min": f"min({c})", "max": f"max({c})", "avg": f"avg(CAST({c} AS DOUBLE))", "std": f"stddev_samp(CAST({c} AS DOUBLE))"}
    if text:
        aggs |= {"minl": f"min(length({c}))", "maxl": f"max(length({c}))", "avgl": f"avg(length({c}))", "empty": f"count_if(coalesce({c} = '', false))"}

    def known(name: str, given: bool = True) -> str:
        return f"__c{i}_{name}" if given and name in aggs else "NULL"

    values = {
        "ordinal": str(i),
        "column_name": _literal(field.name),
        "data_type": _literal(str(dt)),
        "type_name": _literal(dt.simpleString()),
        "nullable": str(field.nullable).lower(),
        "total_rows": "__total",
        "total_columns": str(n_cols),
        "null_count": known("nulls"),
        "null_percentage": f"CASE WHEN __total > 0 THEN CAST({known('nulls')} AS DOUBLE) / CAST(__total AS DOUBLE) * 100D ELSE 0D END",
        "approx_distinct_count": known("ndv"),
        "min": known("min", inexact),
        "max": known("max", inexact),
        "min_exact": known("min", not inexact),
        "max_exact": known("max", not inexact),
        "avg": known("avg"),
        "stddev": known("std"),
        "min_length": known("minl"),
        "max_length": known("maxl"),
        "avg_length": known("avgl"),
        "empty_count": known("empty"),
    }
    fields = [f"'{f.name}', CAST({values[f.name]} AS {f.dataType.simpleString()})" for f in PROFILE_SCHEMA.fields]
    return [f"{e} AS __c{i}_{k}" for k, e in aggs.items()], f"named_struct({', '.join(fields)})"


def profile_frame(df: DataFrame, columns: Sequence[str] | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row per column (``PROFILE_SCHEMA``), computed in one aggregate per
    ``chunk`` columns."""
    fields = [f for f in df.schema.fields if columns is None or f.name in set(columns)]
    n_cols = len(df.columns)
    if not fields:
        return df.sparkSession.createDataFrame([], PROFILE_SCHEMA)
    parts = []
    for start in range(0, len(fields), chunk):
        aggs, rows = ["count(1) AS __total"], []
        for i, f in enumerate(fields[start : start + chunk], start=start):
            own, row = _column_stats(i, f, n_cols)
            aggs += own
            rows.append(row)
        parts.append(df.selectExpr(*aggs).selectExpr(f"inline(array({', '.join(rows)}))"))
    return functools.reduce(DataFrame.unionByName, parts)


def profile(df: DataFrame) -> dict:
    """The profile as a nested dict, built from :func:`profile_frame`
    (one small collect: one row per column)."""
    rows = sorted(profile_frame(df).collect(), key=lambda r: r["ordinal"])
    total = rows[0]["total_rows"] if rows else df.count()
    out = {"total_rows": total, "total_columns": len(df.columns), "columns": {}}
    for r in rows:
        d = {
            "data_type": r["data_type"],
            "nullable": r["nullable"],
            "null_count": r["null_count"],
            "null_percentage": r["null_percentage"],
            "approx_distinct_count": r["approx_distinct_count"],
        }
        dtype = df.schema[r["column_name"]].dataType
        if isinstance(dtype, T.NumericType):
            native = decimal.Decimal if isinstance(dtype, T.DecimalType) else int
            for k in ("min", "max"):
                d[k] = native(r[f"{k}_exact"]) if r[f"{k}_exact"] is not None else r[k]
            d.update({"avg": r["avg"], "stddev": r["stddev"]})
        if r["empty_count"] is not None:
            d.update(
                {
                    "min_length": r["min_length"],
                    "max_length": r["max_length"],
                    "avg_length": r["avg_length"],
                    "empty_count": r["empty_count"],
                }
            )
        out["columns"][r["column_name"]] = d
    return out
