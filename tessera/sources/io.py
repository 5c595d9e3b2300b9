"""Readers and writers.

Readers take an explicit schema whenever the caller has one: inference is an
extra pass over the input (CSV) or over every footer (JSON).  Date-scoped
reads are partition filters, so a Hive-style layout is pruned instead of
being addressed by string-built paths.  Row counts for a write come from an
``Observation`` on the written frame, never from a separate ``count()``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import qcol
from tessera.session import scratch_path

WRITE_MODES = ("append", "overwrite", "error", "errorifexists", "ignore")
TABLE_MODES = ("append", "overwrite", "overwrite_partitions", "create_or_replace", "create")


def _reader(spark: SparkSession, schema=None, options: Mapping | None = None):
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r


def read_csv(spark: SparkSession, path: str, header: bool = True, schema=None, infer: bool = False,
             **options) -> DataFrame:
    """CSV scan.  Without a schema and ``infer=False`` every column is a string."""
    opts = {"header": str(header).lower(), **options}
    if schema is None and infer:
        opts["inferSchema"] = "true"
    return _reader(spark, schema, opts).csv(path)


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return _reader(spark, schema).parquet(path)


# Microsecond timestamp text keeps JSON round trips lossless (Spark's default
# JSON format stops at milliseconds).
LOSSLESS_TS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def read_json(spark: SparkSession, path: str, schema=None, **options) -> DataFrame:
    return _reader(spark, schema, {**LOSSLESS_TS, **options}).json(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table or temporary view by name."""
    return spark.table(name)


def read_any(spark: SparkSession, path: str, format: str = "parquet", schema=None, **options) -> DataFrame:
    """Any data source by format name with free options."""
    return _reader(spark, schema, options).format(format).load(path)


def read_by_date(spark: SparkSession, path: str, run_date=None, date_col: str = "date", format: str = "parquet",
                 schema=None, **options) -> DataFrame:
    """A Hive-partitioned dataset, restricted to one ``run_date`` if given
    (the whole dataset otherwise).

    A day is addressed by its folder, with the dataset as base path: no other
    day is listed, and inference (without a schema) reads that day alone.  A
    day that has no folder gives no rows."""
    if run_date is None:
        return read_any(spark, path, format, schema, **options)
    day = f"{path.rstrip('/')}/{date_col}={run_date}"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(day)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        if schema is None:
            raise ValueError(f"no data for {run_date} under {path}, and no schema to return no rows with")
        return spark.createDataFrame([], schema)
    df = _reader(spark, schema, {"basePath": path, **options}).format(format).load(day)
    return df.withColumn(date_col, F.col(date_col).cast(T.DateType()))


def write_files(df: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, dynamic: bool = True,
                observe: bool = False, **options) -> dict | None:
    """Write ``df`` in any file format.

    ``partition_by`` gives a Hive layout (``col=value/``); with
    ``dynamic=True`` an overwrite replaces only the partitions present in
    ``df``.  ``observe=True`` returns ``{"rows": n}`` measured during the
    write itself.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode {mode!r}; expected one of {WRITE_MODES}")
    obs = None
    if observe:
        obs = Observation("write")
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = df.write.mode(mode).format(format)
    if partition_by:
        w = w.partitionBy(*partition_by)
        if mode == "overwrite":
            w = w.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)
    return dict(obs.get) if obs is not None else None


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None, **options):
    return write_files(df, path, "parquet", mode, partition_by, **options)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True, **options):
    return write_files(df, path, "csv", mode, header=str(header).lower(), **options)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", **options):
    return write_files(df, path, "json", mode, **{**LOSSLESS_TS, **options})


def write_table(df: DataFrame, name: str, mode: str = "append", format: str = "parquet",
                partition_by: Sequence[str] | None = None) -> None:
    """Catalog-table sink with the mode dispatched explicitly.

    ``append`` adds rows; ``overwrite`` replaces all rows; ``overwrite_partitions``
    replaces the partitions present in ``df``; ``create_or_replace`` replaces
    the table and its schema; ``create`` fails if the table exists.  Unknown
    modes raise.

    Columns go by name into an existing table; missing or extra ones raise.
    Modes that replace rows stage ``df`` in the shared folder first, so it may
    read the table itself, and the table is untouched if computing it fails.
    """
    if mode not in TABLE_MODES:
        raise ValueError(f"unknown table mode {mode!r}; expected one of {TABLE_MODES}")
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    if mode == "overwrite_partitions" and not exists:
        raise ValueError(f"table {name} does not exist")
    w = df.write.format(format)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if not exists or mode == "create":
        w.mode("error").saveAsTable(name)
        return
    if mode == "create_or_replace":
        w = _staged(df).write.format(format)
        if partition_by:
            w = w.partitionBy(*partition_by)
        spark.sql(f"DROP TABLE {name}")
        w.mode("error").saveAsTable(name)
        return
    rows = _by_name(df, spark.table(name).columns, name)
    if mode == "append":
        rows.write.insertInto(name)
        return
    staged = _staged(rows)
    setting = "spark.sql.sources.partitionOverwriteMode"  # a catalog table's writer reads only the session's
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic" if mode == "overwrite_partitions" else "static")
    try:
        staged.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(setting, before)


def _by_name(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    if sorted(df.columns) != sorted(columns):
        raise ValueError(f"columns {df.columns} do not match {columns} of table {name}")
    return df.select(*[qcol(c) for c in columns])


def _staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch_path(df.sparkSession, "staged")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database if it does not exist, at ``location`` if given."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}" + (f" LOCATION '{location}'" if location else ""))


def drop_database(spark: SparkSession, name: str, cascade: bool = False) -> None:
    """Drop a database if it exists; one with tables only with ``cascade``."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} {'CASCADE' if cascade else 'RESTRICT'}")


def file_inventory(spark: SparkSession, prefix: str, glob: str | None = None) -> DataFrame:
    """Files under ``prefix`` with size and modification time.

    A distributed listing through the ``binaryFile`` source; the file
    content column is never selected, so no file body is read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(prefix).select(
        F.col("path"), F.col("length").alias("size"), F.col("modificationTime").alias("modified_at")
    )
