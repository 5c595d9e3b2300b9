"""Dependencies that data shows: inclusions between columns, and minimal unique column sets.

``inclusions`` judges all pairs of columns of all given tables in one grouping: every value
is turned into the set of columns that hold it (a bit mask, combined before the shuffle); equal sets are
counted; and a set of columns adds its count to every pair within it, a
number that depends on the schema, not on the data.  A column is included in another if
they share as many values as it has.

``minimal_keys`` climbs the lattice of column sets.  A level's candidates are the sets
of which no subset is unique.  Duplicates in a part of the rows (all rows whose
hash is a multiple of a number) refute a candidate for good.  What no duplicate in that part
refutes can repeat only in rows that agree on each of its subsets, and where one subset has
few such rows, they are looked up once and serve all candidates with that subset.  So all
rows are shuffled, as hashes, once per such subset and not once per candidate.  Equal
hashes only choose rows; whether a candidate repeats is decided on the values.

Only candidate sets, whose number the schema bounds, reach the driver.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import qcol
from tessera.session import scratch_path

WORD = 62  # columns in one mask
#: The first part of a table has so many times the square root of its rows, and at least so many rows.
FIRST, FIRST_LEAST = 32, 16_384
#: A subset is looked up for candidates if at most this share of all rows repeat it.
SHARE = 0.125


def _kind(dtype: T.DataType) -> str | None:
    """Columns are compared within a kind; nested types and binary have none."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "float"
    if isinstance(dtype, T.DecimalType):
        return "decimal"
    if isinstance(dtype, T.IntegralType):
        return "integer"
    if isinstance(dtype, T.StringType):
        return "string"
    if isinstance(dtype, T.DateType):
        return "date"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return "boolean" if isinstance(dtype, T.BooleanType) else None


def _text(column: Column, dtype: T.DataType) -> Column:
    """Equal text for equal values of a kind."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        wide = column.cast("double")
        return F.when(wide == 0, F.lit("0.0")).otherwise(wide.cast("string"))
    if isinstance(dtype, T.DecimalType):
        return column.cast("decimal(38,18)").cast("string")
    return column.cast("string")


def _store(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def inclusions(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per ordered pair of columns of one kind that share a value.

    dependent_table, dependent_column, referenced_table, referenced_column, ``distinct_values`` (of
    the dependent column), ``matched`` (those the referenced column has too),
    ``holds`` (all of them), ``referenced_unique`` (it holds no value twice).
    Nulls are no values; columns without values are in no pair.
    """
    columns = [(t, f.name, f.dataType) for t, df in tables.items() for f in df.schema.fields if _kind(f.dataType)]
    if not columns:
        raise ValueError("no column to compare")
    ids = {(t, c): i for i, (t, c, _) in enumerate(columns)}
    words = range(-(-len(columns) // WORD))

    parts, counts = [], []
    for t, df in tables.items():
        own = [(c, d) for s, c, d in columns if s == t]
        if not own:
            continue
        cells = [F.struct(F.lit(ids[t, c]).alias("id"), F.lit(_kind(d)).alias("kind"), _text(qcol(c), d).alias("value")) for c, d in own]
        parts.append(df.select(F.inline(F.array(*cells))).where("value IS NOT NULL"))
        per_table = df.agg(*[F.count(qcol(c)).alias(str(ids[t, c])) for c, _ in own])
        counts.append(per_table.select(F.inline(F.array(*[F.struct(F.lit(ids[t, c]).alias("b"), F.col(str(ids[t, c])).alias("cells")) for c, _ in own]))))
    cells = functools.reduce(DataFrame.unionByName, parts)
    bit = F.expr(f"shiftleft(1L, id % {WORD})")
    masks = [F.bit_or(F.when(F.expr(f"id div {WORD} = {w}"), bit).otherwise(F.lit(0).cast("long"))).alias(f"m{w}") for w in words]
    sets = cells.groupBy("kind", "value").agg(*masks).groupBy(*[f"m{w}" for w in words]).agg(F.count(F.lit(1)).alias("values"))
    every = ", ".join(f"m{w}" for w in words)
    members = F.expr(
        f"filter(sequence(0, {len(columns) - 1}), i -> shiftright(element_at(array({every}), int(i div {WORD}) + 1), i % {WORD}) & 1 = 1)"
    )
    pairs = sets.select("values", members.alias("in")).select("values", "in", F.explode("in").alias("a")).select("values", "a", F.explode("in").alias("b"))
    shared = pairs.groupBy("a", "b").agg(F.sum("values").alias("matched"))
    shared = _store(shared, "inclusions")  # at most one row per pair of columns
    own = shared.where("a = b")
    unique = own.join(functools.reduce(DataFrame.unionByName, counts), "b").select("b", (F.col("cells") == F.col("matched")).alias("referenced_unique"))
    out = shared.where("a <> b").join(own.select("a", F.col("matched").alias("distinct_values")), "a").join(unique, "b")

    def name(which: int, id_: str) -> Column:
        return F.element_at(F.array(*[F.lit(c[which]) for c in columns]), F.col(id_) + 1)

    return out.select(
        name(0, "a").alias("dependent_table"), name(1, "a").alias("dependent_column"), name(0, "b").alias("referenced_table"),
        name(1, "b").alias("referenced_column"), "distinct_values", "matched", (F.col("matched") == F.col("distinct_values")).alias("holds"), "referenced_unique",
    )


def foreign_keys(found: DataFrame) -> DataFrame:
    """The inclusions of ``found`` into a unique column of another table."""
    return found.where("holds AND referenced_unique AND dependent_table <> referenced_table")


Columns = tuple[int, ...]


def _cell(column: Column, dtype: T.DataType) -> Column:
    """Equal text for equal values of one column, and for them only."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(column).cast("string")
    return column.cast("string") if isinstance(dtype, T.DecimalType) else _text(column, dtype)


def _repeated(rows: DataFrame, sets: Mapping[int, Sequence[Columns]]) -> DataFrame:
    """(set, key, n) of the values that several of ``rows`` (base, cells) have in one of their base's ``sets``."""
    spark = rows.sparkSession
    every = spark.createDataFrame([(b, [list(s) for s in own]) for b, own in sets.items()], "base int, sets array<array<int>>")
    spread = rows.repartition(spark.sparkContext.defaultParallelism)  # few bytes, but each row meets many sets
    each = spread.join(F.broadcast(every), "base").select(F.explode("sets").alias("set"), "cells")
    key = F.transform("set", lambda i: F.get("cells", i))
    return each.groupBy("set", key.alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _shares(part: DataFrame, sets: Sequence[Columns]) -> dict[Columns, int]:
    """How many rows of ``part`` repeat a value, for those of ``sets`` where any does."""
    if not sets:
        return {}
    rows = _repeated(part, {0: sets}).groupBy("set").agg(F.sum("n").alias("n")).collect()  # bounded by the schema
    return {tuple(r["set"]): r["n"] for r in rows}


def _rows_repeating(rows: DataFrame, cells: Column, sets: Sequence[Columns]) -> DataFrame:
    """(base, cells) of all ``rows`` whose hash in one of ``sets`` (base: its place there) other rows have too."""
    parts = []
    for base, own in enumerate(sets):
        hashed = F.xxhash64(*[F.col(f"c{i}") for i in own]).alias("h")
        # hardly any hash repeats, so it is no use to combine them before the shuffle
        counts = rows.select(hashed).repartition("h").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
        twice = _store(counts.where("n > 1").select("h"), "repeated")
        parts.append(rows.select("*", hashed).join(twice, "h", "left_semi").select(F.lit(base).alias("base"), cells.alias("cells")))
    return _store(functools.reduce(DataFrame.unionByName, parts), "repeating")


def _subsets(s: Columns) -> list[Columns]:
    return list(itertools.combinations(s, len(s) - 1))


def _bases(sets: Sequence[Columns], share: Mapping[Columns, float]) -> list[Columns]:
    """Sets to look up so that the rows of one decide each of ``sets``: a subset of several with a small share, or itself."""
    bases, left = [], set(sets)
    while left:
        serves: dict[Columns, int] = {}
        for s in left:
            for sub in _subsets(s):
                if 0 < share.get(sub, 0) <= SHARE:
                    serves[sub] = serves.get(sub, 0) + 1
        best = max(serves, key=lambda b: (serves[b], -share[b], b), default=None)
        if best is None or serves[best] < 2:
            return bases + sorted(left)
        bases.append(best)
        left -= {s for s in left if set(best) <= set(s)}
    return bases


def minimal_keys(df: DataFrame, columns: Sequence[str] | None = None, most: int = 3, part: int | None = None) -> DataFrame:
    """``key_columns`` (names, in the order of ``columns``) and ``size`` of every minimal unique set of up to ``most`` columns.

    Null is a value like others, as for the uniqueness rules.  Every set of an empty table is unique, so its single columns are minimal.
    Duplicates are looked for among one row in ``part`` first; without it that follows from the number of rows.
    """
    spark: SparkSession = df.sparkSession
    names = list(columns or [f.name for f in df.schema.fields if _kind(f.dataType)])
    types = [df.schema[c].dataType for c in names]
    floats = (T.FloatType, T.DoubleType)
    rows = df.select(*[(F.when(qcol(c) == 0, F.lit(0.0)).otherwise(qcol(c)) if isinstance(t, floats) else qcol(c)).alias(f"c{i}")
                       for i, (c, t) in enumerate(zip(names, types))])
    cells = F.array(*[_cell(F.col(f"c{i}"), t) for i, t in enumerate(types)])
    if part is None:
        total = rows.count()
        part = max(1, total // max(FIRST_LEAST, FIRST * math.isqrt(total)))
    digest = F.xxhash64(*rows.columns)
    few = _store(rows.where(F.pmod(digest, F.lit(part)) == 0).select(F.lit(0).alias("base"), cells.alias("cells"), digest.alias("h")), "part")
    fewer, few_rows = few.where(F.pmod("h", F.lit(16 * part)) == 0), few.count()

    repeated: set[Columns] = set()
    share: dict[Columns, float] = {}  # of all rows, judged by the part: a pair is in it once in part * part
    known: dict[Columns, tuple[DataFrame, int]] = {}  # all rows that may repeat a value of a set, and their base there
    found: list[Columns] = []
    candidates: list[Columns] = [(i,) for i in range(len(names))]
    for size in range(1, most + 1):
        refuted = set(_shares(fewer, candidates))
        for s, n in _shares(few, [s for s in candidates if s not in refuted]).items():
            refuted.add(s)
            share[s] = n * part / few_rows
        left = [s for s in candidates if s not in refuted]
        if part > 1 and left:
            bases = _bases([s for s in left if not any(b in known for b in _subsets(s))], share)
            if bases:
                looked = _rows_repeating(rows, cells, bases)
                known.update({b: (looked, i) for i, b in enumerate(bases)})
            tests: dict[DataFrame, dict[int, list[Columns]]] = {}
            for s in left:
                own = next(b for b in (s, *_subsets(s)) if b in known)
                tests.setdefault(known[own][0], {}).setdefault(known[own][1], []).append(s)
            for some, sets in tests.items():
                refuted |= {tuple(r["set"]) for r in _repeated(some, sets).select("set").distinct().collect()}
        found += [s for s in candidates if s not in refuted]
        repeated |= refuted
        wider = {(*s, i) for s in refuted for i in range(s[-1] + 1, len(names))}
        candidates = sorted(s for s in wider if all(sub in repeated for sub in _subsets(s)))
        if not candidates:
            break
    keys = [([names[i] for i in s], len(s)) for s in found]
    return spark.createDataFrame(keys, "key_columns array<string>, size int")
