"""Registered profile queries (one aggregate pass per table)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.profile import profile_frame
from tessera.plans.quality_queries import EVENTS_SQL, events_with_gaps
from tessera.plans.registry import register, table

# (column, Spark type text) of the profiled tables, in schema order.
CUSTOMER_COLS = [
    ("c_custkey", "LongType()"),
    ("c_name", "StringType()"),
    ("c_nationkey", "IntegerType()"),
    ("c_acctbal", "DoubleType()"),
    ("c_mktsegment", "StringType()"),
]
EVENT_COLS = [
    ("event_id", "LongType()"),
    ("user_id", "LongType()"),
    ("event_type", "StringType()"),
    ("ts", "TimestampNTZType()"),
    ("value", "DoubleType()"),
    ("props", "StringType()"),
]
EMBEDDING_COLS = [
    ("vec_id", "LongType()"),
    ("embedding", "ArrayType(FloatType(), True)"),
    ("label", "IntegerType()"),
]


def _base_sql(source: str, cols) -> str:
    parts = []
    for i, (c, t) in enumerate(cols):
        parts.append(
            f"""SELECT {i} AS ordinal, '{c}' AS column_name, '{t}' AS data_type, TRUE AS nullable,
       COUNT(*) AS total_rows, {len(cols)} AS total_columns,
       COUNT(*) FILTER (WHERE "{c}" IS NULL) AS null_count,
       CASE WHEN COUNT(*) > 0 THEN CAST(COUNT(*) FILTER (WHERE "{c}" IS NULL) AS DOUBLE) / COUNT(*) * 100.0
            ELSE 0.0 END AS null_percentage
FROM {source}"""
        )
    return "\nUNION ALL\n".join(parts)


BASE_COLS = ["ordinal", "column_name", "data_type", "nullable", "total_rows", "total_columns", "null_count",
             "null_percentage"]


@register(
    "profile_base",
    _base_sql("customer", CUSTOMER_COLS)
    + "\nUNION ALL\n"
    + _base_sql(EVENTS_SQL, EVENT_COLS).replace("SELECT 0 AS ordinal", "SELECT 100 AS ordinal").replace(
        "SELECT 1 AS", "SELECT 101 AS").replace("SELECT 2 AS", "SELECT 102 AS").replace(
        "SELECT 3 AS", "SELECT 103 AS").replace("SELECT 4 AS", "SELECT 104 AS").replace("SELECT 5 AS", "SELECT 105 AS"),
)
def profile_base(spark, sf):
    cust = profile_frame(table(spark, sf, "customer")).select(*BASE_COLS)
    ev = events_with_gaps(spark, sf).select([c for c, _ in EVENT_COLS])
    evp = profile_frame(ev).withColumn("ordinal", F.col("ordinal") + 100).select(*BASE_COLS)
    return cust.unionByName(evp)


@register(
    "profile_nested",
    _base_sql("embeddings", EMBEDDING_COLS),
)
def profile_nested(spark, sf):
    return profile_frame(table(spark, sf, "embeddings")).select(*BASE_COLS)


def _extremes(c: str, exact: bool) -> str:
    """Doubles as they are, integers and decimals as text."""
    kinds = ("CAST(NULL AS DOUBLE)", "CAST({} AS VARCHAR)") if exact else ("{}", "CAST(NULL AS VARCHAR)")
    return ", ".join(
        f"{kind.format(f'{fn}({c})')} AS {fn.lower()}{suffix}" for kind, suffix in zip(kinds, ("", "_exact")) for fn in ("MIN", "MAX")
    )


def _numeric_sql(source: str, cols) -> str:
    parts = []
    for c, exact in cols:
        parts.append(
            f"""SELECT '{c}' AS column_name, {_extremes(c, exact)},
       ROUND(AVG(CAST({c} AS DOUBLE)), 4) AS avg, ROUND(STDDEV_SAMP(CAST({c} AS DOUBLE)), 4) AS stddev
FROM {source}"""
        )
    return "\nUNION ALL\n".join(parts)


LINEITEM_EXACT = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "big_key", "price"]
LINEITEM_DOUBLE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# beside the table's own columns: a long beyond 2^53 and a decimal
LINEITEM_SQL = "(SELECT *, 9007199254740993 + 0 * l_orderkey AS big_key, CAST(l_orderkey AS DECIMAL(20, 3)) AS price FROM lineitem)"


@register(
    "profile_numeric",
    _numeric_sql(LINEITEM_SQL, [(c, True) for c in LINEITEM_EXACT] + [(c, False) for c in LINEITEM_DOUBLE]),
)
def profile_numeric(spark, sf):
    li = table(spark, sf, "lineitem").withColumns(
        {"big_key": F.lit(9007199254740993) + 0 * F.col("l_orderkey"), "price": F.col("l_orderkey").cast("decimal(20,3)")}
    )
    p = profile_frame(li).where(F.col("avg").isNotNull())
    return p.select(
        "column_name", "min", "max", "min_exact", "max_exact", F.round("avg", 4).alias("avg"), F.round("stddev", 4).alias("stddev")
    )


def _string_sql(source: str, cols) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"""SELECT '{c}' AS column_name, CAST(MIN(length({c})) AS INTEGER) AS min_length,
       CAST(MAX(length({c})) AS INTEGER) AS max_length, ROUND(AVG(length({c})), 4) AS avg_length,
       COUNT(*) FILTER (WHERE {c} = '') AS empty_count
FROM {source}"""
        )
    return "\nUNION ALL\n".join(parts)


DOC_STRINGS = ["text", "lang", "source"]


@register("profile_string", _string_sql("documents", DOC_STRINGS))
def profile_string(spark, sf):
    p = profile_frame(table(spark, sf, "documents")).where(F.col("empty_count").isNotNull())
    return p.select(
        "column_name", "min_length", "max_length", F.round("avg_length", 4).alias("avg_length"), "empty_count"
    )


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register(
    "profile_distinct",
    "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS exact, TRUE AS within FROM orders" for c in ORDER_COLS),
)
def profile_distinct(spark, sf):
    """The approximate count of every column lies within three standard
    deviations (5 % each) of the exact one."""
    orders = table(spark, sf, "orders")
    counts = orders.agg(*[F.count_distinct(c).alias(c) for c in ORDER_COLS]).unpivot([], ORDER_COLS, "column_name", "exact")
    off = F.abs(F.col("approx_distinct_count") - F.col("exact"))
    return profile_frame(orders).join(counts, "column_name").select(
        "column_name", "exact", (off <= F.greatest(F.lit(2.0), 0.15 * F.col("exact"))).alias("within")
    )
