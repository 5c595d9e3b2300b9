"""CSV lines that do not parse, set apart with their file, text and reason.

A permissive CSV scan turns what it cannot read into nulls.  Here every line
is parsed with the whole schema, whatever columns a query selects later, and one
that does not fit is kept as it is.  Good and bad lines together are all lines
but headers and empty ones.  A line is a record: fields do not span lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import qcol

CHECKED = "_checked"


def _parsed(schema: T.StructType, options: dict[str, str], line: Column) -> Column:
    corrupt = "_corrupt"
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    return F.from_csv(line, _ddl(full), {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def read_csv_checked(spark: SparkSession, path: str, schema: str | T.StructType, header: bool = True, **options) -> DataFrame:
    """The columns of ``schema``, and ``_checked``: null for a good line, else a struct of its ``file``, ``line`` and ``reason``.

    The reason is ``wrong number of columns``, or ``column <name>`` for the first whose
    text is not a value of its type.  With ``header`` each file's first line, and any
    equal to it, is left out.  All columns are read as nullable.
    """
    types = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    typed = T.StructType([T.StructField(f.name, f.dataType) for f in types.fields])
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in types.fields])
    options = {k: str(v) for k, v in options.items()}
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file")).where("length(trim(line)) > 0")
    if header:
        first = F.from_csv("line", _ddl(texts), options)
        names = [first.getField(f.name) == F.lit(f.name) for f in types.fields]
        is_header = F.lit(True)
        for same in names:
            is_header = is_header & F.coalesce(same, F.lit(False))
        lines = lines.where(~is_header)
    rows = lines.select("line", "file", _parsed(typed, options, F.col("line")).alias("v"), _parsed(texts, options, F.col("line")).alias("t"))
    failing = [F.when(F.col(f"t.{_q(f.name)}").isNotNull() & F.col(f"v.{_q(f.name)}").isNull(), F.lit(f"column {f.name}")) for f in types.fields]
    reason = F.when(F.col("t._corrupt").isNotNull(), F.lit("wrong number of columns")).when(
        F.col("v._corrupt").isNotNull(), F.coalesce(*failing, F.lit("malformed"))
    )
    checked = F.when(reason.isNotNull(), F.struct("file", "line", reason.alias("reason")))
    return rows.select(*[F.col(f"v.{_q(f.name)}").alias(f.name) for f in types.fields], checked.alias(CHECKED))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def split_checked(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the check, quarantine rows ``file``, ``line``, ``reason``); both read the input when they are used."""
    good = rows.where(F.col(CHECKED).isNull()).drop(CHECKED)
    return good, rows.where(F.col(CHECKED).isNotNull()).select(f"{CHECKED}.file", f"{CHECKED}.line", f"{CHECKED}.reason")


def write_checked(rows: DataFrame, good_path: str, bad_path: str) -> dict[str, int]:
    """Writes both parts as Parquet, bad lines by reason; returns how many lines each got, from one observed pass each."""
    out = {}
    for name, part, path in zip(("good", "bad"), split_checked(rows), (good_path, bad_path)):
        seen = Observation()
        writer = part.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
        (writer.partitionBy("reason") if name == "bad" else writer).parquet(path)
        out[name] = seen.get["n"]
    return out


def first_occurrence(files: DataFrame, keys: list[str]) -> DataFrame:
    """Of the rows of each key the first one in the files: by file path, then place in the file.

    ``files`` is a frame read from files, with at most projections and filters since.
    The place is the row's index where the format knows it (Parquet), else its block's start and its
    order in it.  One partial and final aggregate: a hot key ships one row per task.
    """
    known = files.select("_metadata.*").columns
    if "row_index" in known:
        place = [F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r")]
    else:
        place = [F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("r")]
    rest = [c for c in files.columns if c not in keys]
    placed = files.select(*[qcol(c) for c in keys], F.struct(*[qcol(c) for c in rest], F.lit(0).alias("__any")).alias("__row"), F.struct(*place).alias("__place"))
    first = placed.groupBy(*[qcol(c) for c in keys]).agg(F.min_by("__row", "__place").alias("__row"))
    return first.select(*[qcol(c) if c in keys else F.col(f"__row.{_q(c)}") for c in files.columns])
