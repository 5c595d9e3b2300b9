"""Helpers shared by the training-data operators."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def reach(spark: SparkSession) -> None:
    """Lets Python workers import this library where they share the driver's folders.

    On a cluster that does not, ship it with ``--py-files``.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")

        @functools.wraps(fn)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            reach(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql.strip()
        return query

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts lineage: what follows survives lost executors without recomputing.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples, a slice of columns at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            yield from zip(*(c.to_pylist() for c in part.columns))


def chunks(rows: Iterator[tuple], size: Callable[[tuple], int], most: int = 1 << 21, rows_most: int = 4096):
    """Lists of consecutive rows, closed once their sizes reach ``most``.

    Bounds a task's memory whatever the batch size: one row above ``most``
    makes a list of its own.
    """
    out, total = [], 0
    for row in rows:
        out.append(row)
        total += size(row)
        if total >= most or len(out) >= rows_most:
            yield out
            out, total = [], 0
    if out:
        yield out


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def text_or_empty(col: str):
    return F.coalesce(F.col(col), F.lit(""))


def keep_rows(docs: DataFrame, wanted: Callable[[list[str]], list[bool]], text: str = "text") -> DataFrame:
    """The rows whose text ``wanted`` keeps, with all their columns; no shuffle. Null text counts as empty."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(names.index(text)).to_pylist()]
                yield part.filter(pa.array(wanted(texts), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
