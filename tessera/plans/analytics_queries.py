"""Registered queries: event analytics (Q1-Q3), scans, filters, projections,
joins and group aggregates.

Floating-point aggregates are rounded identically on both sides (sums of
two-decimal money columns to 2 places, averages and deviations to 4) so the
result does not depend on the summation order of either engine.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import analytics as A
from tessera.operators import transforms as X
from tessera.plans.registry import register, table
from tessera.session import scratch_path
from tessera.sources import io

AS_OF = "2024-01-31"  # fixed "today" for the relative-date query


@register(
    "q_daily_events",
    """
    SELECT CAST(ts AS DATE) AS date, event_type, COUNT(*) AS event_count
    FROM events GROUP BY 1, 2 ORDER BY date DESC, event_count DESC
    """,
)
def q_daily_events(spark, sf):
    return A.daily_event_counts(table(spark, sf, "events"))


@register(
    "q_user_activity",
    """
    SELECT user_id, COUNT(DISTINCT event_type) AS unique_events, COUNT(*) AS total_events,
           MIN(ts) AS first_event, MAX(ts) AS last_event
    FROM events GROUP BY user_id ORDER BY total_events DESC
    """,
)
def q_user_activity(spark, sf):
    return A.user_activity(table(spark, sf, "events"))


@register(
    "q_hourly_recent",
    f"""
    SELECT date_trunc('hour', ts) AS hour, COUNT(*) AS event_count
    FROM events WHERE CAST(ts AS DATE) >= DATE '{AS_OF}' - 7
    GROUP BY 1 ORDER BY hour DESC
    """,
)
def q_hourly_recent(spark, sf):
    return A.hourly_counts(table(spark, sf, "events"), as_of=AS_OF, days=7)


@register("scan_parquet", "SELECT COUNT(*) AS row_count FROM lineitem")
def scan_parquet(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("row_count"))


@register("scan_view", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_view(spark, sf):
    table(spark, sf, "nation").createOrReplaceTempView("tessera_nation")
    return spark.table("tessera_nation")


@register(
    "filter_compare",
    "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 5000",
)
def filter_compare(spark, sf):
    return table(spark, sf, "customer").where(F.col("c_acctbal") > 5000).select("c_custkey", "c_name", "c_acctbal")


@register(
    "filter_sql",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",
)
def filter_sql(spark, sf):
    return (
        table(spark, sf, "orders")
        .filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
        .select("o_orderkey", "o_custkey", "o_totalprice")
    )


@register(
    "filter_contains",
    "SELECT page_id, url FROM pages WHERE NOT contains(url, 'https')",
)
def filter_contains(spark, sf):
    return table(spark, sf, "pages").where(~F.col("url").contains("https")).select("page_id", "url")


@register(
    "project_alias",
    "SELECT p_partkey AS part_id, p_name AS part_name, p_retailprice AS price FROM part",
)
def project_alias(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("part_id"), F.col("p_name").alias("part_name"), F.col("p_retailprice").alias("price")
    )


@register(
    "case_when",
    """
    SELECT c_custkey,
           CASE WHEN c_acctbal < 0 THEN 'negative'
                WHEN c_acctbal < 5000 THEN 'standard'
                ELSE 'premium' END AS tier
    FROM customer
    """,
)
def case_when(spark, sf):
    bal = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.when(bal < 0, "negative").when(bal < 5000, "standard").otherwise("premium").alias("tier"),
    )


@register("upper_name", "SELECT p_partkey, upper(p_name) AS p_name FROM part")
def upper_name(spark, sf):
    return X.upper_column(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name")


@register(
    "json_props",
    """
    SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, COUNT(*) AS n_events
    FROM events GROUP BY 1
    """,
)
def json_props(spark, sf):
    parsed = F.from_json(F.col("props"), T.StructType([T.StructField("k", T.LongType())]))
    return (
        table(spark, sf, "events")
        .select(parsed.getField("k").alias("k"))
        .groupBy("k")
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


@register(
    "join_left",
    """
    SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice
    FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
    """,
)
def join_left(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@register(
    "join_labels_left",
    """
    SELECT d.doc_id, d.lang, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def join_labels_left(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    lab = table(spark, sf, "labels")
    return d.join(lab, "doc_id", "left").select("doc_id", "lang", "quality", "toxic")


@register(
    "join_broadcast",
    """
    SELECT r.r_name, n.n_name, COUNT(*) AS customers, ROUND(SUM(c.c_acctbal), 2) AS balance
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    GROUP BY r.r_name, n.n_name
    """,
)
def join_broadcast(spark, sf):
    c = table(spark, sf, "customer").select("c_nationkey", "c_acctbal")
    n = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    r = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    dim = A.join_dimension(n, r, "n_regionkey")
    joined = A.join_dimension(c, dim, "c_nationkey")
    return joined.groupBy("r_name", "n_name").agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@register(
    "group_count",
    "SELECT c_mktsegment, COUNT(*) AS count FROM customer GROUP BY c_mktsegment",
)
def group_count(spark, sf):
    return table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("count"))


@register(
    "group_avg",
    "SELECT o_orderpriority, ROUND(AVG(o_totalprice), 4) AS avg_price FROM orders GROUP BY 1 ORDER BY 1",
)
def group_avg(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy("o_orderpriority")
        .agg(F.round(F.avg("o_totalprice"), 4).alias("avg_price"))
        .orderBy("o_orderpriority")
    )


@register(
    "category_summary",
    """
    SELECT p_type AS category, COUNT(*) AS count, ROUND(AVG(p_retailprice), 4) AS avg_value
    FROM part GROUP BY p_type
    """,
)
def category_summary(spark, sf):
    """The summary job: group, then replace a catalog table; returns the table."""
    parts = table(spark, sf, "part").withColumnRenamed("p_type", "category")
    summary = A.group_summary(
        parts, ["category"], {"count": F.count(F.lit(1)), "avg_value": F.round(F.avg("p_retailprice"), 4)}
    )
    db = f"tessera_{uuid.uuid4().hex[:12]}"
    io.create_database(spark, db, scratch_path(spark, "db"))
    for _ in range(2):  # a second run replaces the first one's table
        io.write_table(summary, f"{db}.category_summary", "create_or_replace")
    return spark.table(f"{db}.category_summary")


@register(
    "group_sum",
    """
    SELECT l_returnflag, l_linestatus, ROUND(SUM(l_extendedprice), 2) AS revenue,
           ROUND(SUM(l_quantity), 2) AS quantity
    FROM lineitem GROUP BY 1, 2
    """,
)
def group_sum(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"), F.round(F.sum("l_quantity"), 2).alias("quantity"))
    )


@register(
    "run_metrics",
    """
    SELECT COUNT(*) AS row_count, ROUND(SUM(o_totalprice), 2) AS total,
           ROUND(AVG(o_totalprice), 4) AS average, MIN(o_totalprice) AS minimum,
           MAX(o_totalprice) AS maximum
    FROM orders
    """,
)
def run_metrics(spark, sf):
    m = A.global_metrics(table(spark, sf, "orders"), "o_totalprice")
    return m.select(
        "row_count",
        F.round("total", 2).alias("total"),
        F.round("average", 4).alias("average"),
        "minimum",
        "maximum",
    )


@register(
    "dict_agg",
    "SELECT ROUND(SUM(l_quantity), 2) AS sum_l_quantity, MAX(l_discount) AS max_l_discount FROM lineitem",
)
def dict_agg(spark, sf):
    out = table(spark, sf, "lineitem").agg({"l_quantity": "sum", "l_discount": "max"})
    return out.select(
        F.round(F.col("sum(l_quantity)"), 2).alias("sum_l_quantity"), F.col("max(l_discount)").alias("max_l_discount")
    )


@register(
    "dup_keys",
    """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS dup_count
    FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1
    """,
)
def dup_keys(spark, sf):
    return A.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(
    "null_counts",
    """
    SELECT COUNT(*) FILTER (WHERE event_id IS NULL) AS event_id,
           COUNT(*) FILTER (WHERE ts IS NULL) AS ts,
           COUNT(*) FILTER (WHERE user_id IS NULL) AS user_id,
           COUNT(*) FILTER (WHERE event_type IS NULL) AS event_type,
           COUNT(*) FILTER (WHERE value IS NULL) AS value,
           COUNT(*) FILTER (WHERE props IS NULL) AS props
    FROM (SELECT event_id, ts, user_id, event_type,
                 CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, props
          FROM events)
    """,
)
def null_counts(spark, sf):
    ev = table(spark, sf, "events")
    ev = ev.withColumn("value", F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")))
    return A.null_counts(ev)


@register(
    "distinct_count",
    "SELECT COUNT(*) AS n_distinct FROM (SELECT DISTINCT o_custkey FROM orders)",
)
def distinct_count(spark, sf):
    return table(spark, sf, "orders").select("o_custkey").distinct().agg(F.count(F.lit(1)).alias("n_distinct"))


@register(
    "take_top",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def take_top(spark, sf):
    """The first rows of an ordered frame: kept per task, then merged."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@register(
    "transform_chain",
    """SELECT o_orderkey, upper(o_orderpriority) AS o_orderpriority, year(o_orderdate) AS year, month(o_orderdate) AS month,
              day(o_orderdate) AS day, 'nightly' AS run
       FROM orders""",
)
def transform_chain(spark, sf):
    """Operators chained as functions of a frame."""
    return (
        table(spark, sf, "orders")
        .select("o_orderkey", "o_orderpriority", "o_orderdate")
        .transform(X.upper_column, "o_orderpriority")
        .transform(X.add_partition_columns, "o_orderdate")
        .transform(X.add_constant, "run", "nightly")
        .drop("o_orderdate")
    )
