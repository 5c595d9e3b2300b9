"""Column-level building blocks (all JVM-side expressions, no Python per row)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def qcol(name: str) -> Column:
    """Reference a column by its literal name, even with dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN for float/double columns (the not-null rule's notion)."""
    c = qcol(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def regex_found(c: Column, pattern: str) -> Column:
    """True when ``pattern`` finds a non-empty match in ``c``; NULL input -> False.

    A match of empty text counts as no match, as with the reference's
    ``regexp_extract(..) != ""`` test.
    """
    return F.coalesce(F.regexp_extract(c.cast("string"), pattern, 0) != F.lit(""), F.lit(False))


def in_values(c: Column, values: Iterable) -> Column:
    """Membership that treats NULL as not a member (even if None is listed)."""
    vals = [v for v in values if v is not None]
    if not vals:
        return F.lit(False)
    return F.coalesce(c.isin(vals), F.lit(False))


def count_where(cond: Column) -> Column:
    """Number of rows for which ``cond`` is true (NULL counts as false)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


_NON_ALNUM = re.compile(r"[^a-zA-Z0-9]")


def standard_name(name: str) -> str:
    """Every character outside [A-Za-z0-9] becomes ``_``, then lower case.

    No collapsing of runs, no trimming.
    """
    return _NON_ALNUM.sub("_", name).lower()


def orderable(dtype: T.DataType) -> bool:
    """Whether Spark can sort by a column of this type."""
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return True
