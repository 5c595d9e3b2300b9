"""Rewriting a table so that filters on several columns touch few files.

Rows are ranged by a Morton code: every column's values are cut into 2^bits ranges of about equal
numbers of rows, and the bits of the range numbers are interleaved.  Rows near one another in
all columns so get near codes, and a file, which holds a range of codes, has
narrow bounds in each column, by which readers skip it.

One pass finds the cuts (approximate quantiles) and the number of rows, one shuffle
ranges the rows.  Files are bounded in rows, so a value that many rows
share fills several files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import qcol

BITS, FILE_ROWS = 6, 1_000_000


def _number(df: DataFrame, name: str) -> Column:
    """A column as numbers in its order."""
    c, dtype = qcol(name), df.schema[name].dataType
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(dtype, T.StringType):  # its first six bytes; longer common beginnings fall in one range
        return F.conv(F.hex(F.rpad(F.substring(F.encode(c, "UTF-8"), 1, 6), 6, F.lit(b"\x00"))), 16, 10).cast("double")
    raise TypeError(f"no order by column {name!r} of type {dtype.simpleString()}")


def morton(ranges: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of range numbers interleaved, the first column's highest bit first."""
    code = F.lit(0).cast("long")
    for bit in range(bits):
        for i, r in enumerate(ranges):
            at = bit * len(ranges) + len(ranges) - 1 - i
            code = code.bitwiseOR(F.shiftleft(F.shiftright(r, bit).bitwiseAND(F.lit(1).cast("long")), at))
    return code


def clustered(df: DataFrame, columns: Sequence[str], file_rows: int = FILE_ROWS, bits: int = BITS) -> DataFrame:
    """``df`` in about rows / ``file_rows`` partitions, ranged and sorted by the Morton code of ``columns``.

    Nulls and NaN come first and last.  Reads ``df`` once more, for its cuts.
    """
    if not columns or not 1 <= bits * len(columns) <= 62:
        raise ValueError("give 1 to 62 bits in all")
    numbers = {f"__n{i}": _number(df, c) for i, c in enumerate(columns)}
    shares = [k / 2**bits for k in range(1, 2**bits)]
    seen = df.select(*[n.alias(k) for k, n in numbers.items()]).agg(
        F.count(F.lit(1)).alias("rows"), *[F.percentile_approx(k, shares, 100 * 2**bits).alias(k) for k in numbers]
    ).first()
    ranges = []
    for k, n in numbers.items():
        cuts = F.array(*[F.lit(float(x)) for x in sorted(set(seen[k] or []))]).cast("array<double>")
        ranges.append(F.coalesce(F.size(F.filter(cuts, lambda x, n=n: x < n)), F.lit(0)).cast("long") if seen[k] else F.lit(0).cast("long"))
    files = max(1, -(-seen["rows"] // file_rows))
    coded = df.withColumn("__code", morton([F.when(n.isNull(), F.lit(0).cast("long")).otherwise(r) for n, r in zip(numbers.values(), ranges)], bits))
    order = ["__code", *[qcol(c) for c in columns]]
    return coded.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("__code")


def rewrite(df: DataFrame, path: str, columns: Sequence[str], file_rows: int = FILE_ROWS, bits: int = BITS, mode: str = "error") -> None:
    """Writes ``df`` clustered by ``columns``, in files of at most ``file_rows`` rows."""
    clustered(df, columns, file_rows, bits).write.mode(mode).option("maxRecordsPerFile", file_rows).parquet(path)


def file_bounds(files: DataFrame, columns: Sequence[str]) -> DataFrame:
    """file, ``n``, and ``min_<column>`` and ``max_<column>`` of every file that ``files`` is read from."""
    parts = [f(qcol(c)).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return files.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"), *parts)


def files_touched(files: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """One row: ``touched`` of ``files`` whose bounds meet all of ``ranges`` (column: (low, high), inclusive), ``rows`` in these."""
    meets = F.lit(True)
    for c, (low, high) in ranges.items():
        meets = meets & (F.col(f"`max_{c}`") >= F.lit(low)) & (F.col(f"`min_{c}`") <= F.lit(high))
    bounds = file_bounds(files, list(ranges))
    hit = F.coalesce(meets, F.lit(False))
    return bounds.agg(F.count_if(hit).alias("touched"), F.count(F.lit(1)).alias("files"), F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("rows"))
