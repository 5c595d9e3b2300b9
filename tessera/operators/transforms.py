"""Row-wise DataFrame transforms: audit, partition, lineage and name columns,
keep-latest deduplication, tolerant casts, defaults, null removal.

Every function is ``DataFrame -> DataFrame`` so they chain with
``df.transform(fn, ...)``.  None adds a shuffle except the deduplications,
which shuffle once on their keys.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import orderable, qcol, standard_name


def _now(now) -> Column:
    """``current_timestamp()`` or a fixed instant (for reproducible runs)."""
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    return F.lit(now).cast("timestamp")


def add_audit_columns(df: DataFrame, now=None) -> DataFrame:
    """``created_at`` and ``updated_at`` set to the same instant (replacing any existing ones)."""
    ts = _now(now)
    return df.withColumns({"created_at": ts, "updated_at": ts})


def add_processing_time(df: DataFrame, name: str = "processed_at", now=None) -> DataFrame:
    """One timestamp column, constant for the query (or micro-batch)."""
    return df.withColumn(name, _now(now))


def add_partition_columns(df: DataFrame, date_col: str = "created_at") -> DataFrame:
    """``year``, ``month``, ``day`` (int) derived from ``date_col``."""
    c = qcol(date_col)
    return df.withColumns({"year": F.year(c), "month": F.month(c), "day": F.dayofmonth(c)})


def add_lineage_columns(
    df: DataFrame,
    source_system: str,
    source_table: str,
    version: str,
    extracted_at=None,
    prefix: str = "",
) -> DataFrame:
    """Four lineage columns: source system and table, extraction time, version;
    ``prefix`` keeps them apart from columns of these names."""
    values = {
        "source_system": F.lit(source_system),
        "source_table": F.lit(source_table),
        "extraction_time": _now(extracted_at),
        "pipeline_version": F.lit(version),
    }
    return df.withColumns({prefix + k: v for k, v in values.items()})


def add_constant(df: DataFrame, name: str, value) -> DataFrame:
    """A literal column such as a pipeline or run id."""
    return df.withColumn(name, F.lit(value))


def standardize_column_names(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`standard_name` in one projection.

    Two input names that map to the same output raise ``ValueError`` instead
    of producing an ambiguous frame.
    """
    new = [standard_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both standardize to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def deduplicate(
    df: DataFrame,
    key_columns: Sequence[str],
    order_by: str | None = None,
) -> DataFrame:
    """Keep one row per key.

    With ``order_by`` the row with the greatest value is kept (NULLs last);
    remaining ties are broken by every other sortable column ascending so the
    survivor is deterministic.  This is the ``row_number() = 1`` shape, which
    Catalyst turns into a map-side ``WindowGroupLimit`` before the shuffle, so
    a hot key ships at most one row per input partition.

    Without ``order_by`` any row of the key survives (``dropDuplicates``,
    a partial + final hash aggregate).
    """
    keys = list(key_columns)
    if not order_by:
        return df.dropDuplicates(keys)
    rn = "__tessera_rn"
    while rn in df.columns:
        rn += "_"
    ties = [
        qcol(f.name).asc_nulls_first()
        for f in df.schema.fields
        if f.name not in keys and f.name != order_by and orderable(f.dataType)
    ]
    w = Window.partitionBy(*[qcol(k) for k in keys]).orderBy(qcol(order_by).desc_nulls_last(), *ties)
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def remove_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with NULL in any listed column.  NaN is kept (unlike ``na.drop``)."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & qcol(c).isNotNull()
    return df.where(cond)


def cast_columns(df: DataFrame, types: Mapping[str, str], tolerant: bool = False) -> DataFrame:
    """Cast columns in one projection.  Strict casts raise on bad text (ANSI);
    tolerant ones turn it into NULL."""
    return df.withColumns(
        {c: (qcol(c).try_cast(t) if tolerant else qcol(c).cast(t)) for c, t in types.items()}
    )


def flag_castable(df: DataFrame, column: str, to_type: str, flag: str = "_cast_ok") -> DataFrame:
    """Tolerant cast of ``column`` plus a boolean telling whether the original
    value (if not NULL) survived the cast.  Split good and bad rows with a
    filter on ``flag``; both sides come from one scan."""
    src = qcol(column)
    casted = src.try_cast(to_type)
    return df.withColumns({column: casted, flag: src.isNull() | casted.isNotNull()})


def split_castable(df: DataFrame, column: str, to_type: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose value casts, rows whose value does not) — the quarantine split."""
    flagged = flag_castable(df, column, to_type, "__tessera_ok")
    good = flagged.where(F.col("__tessera_ok")).drop("__tessera_ok")
    bad = df.where(qcol(column).isNotNull() & qcol(column).try_cast(to_type).isNull())
    return good, bad


def ensure_columns(df: DataFrame, defaults: Mapping[str, tuple[str, object]]) -> DataFrame:
    """Add missing columns with a typed default: ``{name: (type, default)}``."""
    missing = {n: F.lit(v).cast(t) for n, (t, v) in defaults.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def upper_column(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.upper(qcol(column)))


def filter_above_mark(df: DataFrame, column: str, mark) -> DataFrame:
    """Incremental read: rows strictly above the previous high-water mark.

    ``mark=None`` means a first run (everything).  The predicate is a plain
    comparison, so it reaches the Parquet scan as a pushed filter.
    """
    if mark is None:
        return df
    return df.where(qcol(column) > F.lit(mark))


def stamp_run_date(df: DataFrame, run_date: str | _dt.date, name: str = "run_date") -> DataFrame:
    return df.withColumn(name, F.lit(str(run_date)).cast(T.DateType()))
