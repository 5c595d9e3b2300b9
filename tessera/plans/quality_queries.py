"""Registered data-quality queries: each rule alone, the fused report, its
roll-up and fail-fast truncation.  The oracle restates every rule as plain
SQL over the same tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import quality as Q
from tessera.plans.registry import register, table

REPORT_COLS = ["ordinal", "rule", "rule_name", "column", "status", "severity", "failed_count", "total_count",
               "failure_rate", "frame_rows"]

# Derived events with missing values: NULL for error events, NaN for small views.
EVENTS_SQL = """(SELECT event_id, user_id, event_type, ts,
       CASE WHEN event_type = 'error' THEN NULL
            WHEN event_type = 'view' AND value < 10 THEN 'NaN'::DOUBLE
            ELSE value END AS value, props
  FROM events)"""


def events_with_gaps(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").withColumn(
        "value",
        F.when(F.col("event_type") == "error", F.lit(None))
        .when((F.col("event_type") == "view") & (v < 10), F.lit(float("nan")))
        .otherwise(v),
    )


def _row_sql(ordinal, rule, rule_name, column, severity, failed, total, passed, source, skipped=False):
    col = "NULL" if column is None else f"'{column}'"
    status = "'skipped'" if skipped else f"CASE WHEN {passed} THEN 'passed' ELSE 'failed' END"
    return f"""SELECT {ordinal} AS ordinal, '{rule}' AS rule, '{rule_name}' AS rule_name, {col} AS "column",
       {status} AS status, '{severity}' AS severity,
       CAST(failed AS BIGINT) AS failed_count, CAST(total AS BIGINT) AS total_count,
       CASE WHEN total = 0 THEN 0.0 ELSE CAST(failed AS DOUBLE) / total END AS failure_rate,
       CAST(frame_rows AS BIGINT) AS frame_rows
FROM (SELECT {failed} AS failed, {total} AS total, frame_rows FROM {source})"""


def _report(df, rules, fail_fast=False):
    return Q.report_frame(df, rules, fail_fast=fail_fast).select(*REPORT_COLS)


def _count_src(table_sql, cond):
    return f"(SELECT COUNT(*) FILTER (WHERE {cond}) AS c, COUNT(*) AS frame_rows FROM {table_sql})"


# ---- single rules -----------------------------------------------------------

@register(
    "dq_not_null",
    _row_sql(0, "not_null_value", "not_null", "value", "error", "c", "frame_rows", "failed <= 0",
             _count_src(EVENTS_SQL, "value IS NULL OR isnan(value)"))
    + "\nUNION ALL\n"
    + _row_sql(1, "not_null_value", "not_null", "value", "warning", "c", "frame_rows",
               "CAST(failed AS DOUBLE) / total <= 0.3", _count_src(EVENTS_SQL, "value IS NULL OR isnan(value)")),
)
def dq_not_null(spark, sf):
    ev = events_with_gaps(spark, sf)
    return _report(ev, [Q.not_null("value"), Q.not_null("value", severity=Q.WARNING, threshold=0.3)])


@register(
    "dq_unique",
    _row_sql(0, "unique_o_custkey", "unique", "o_custkey", "error", "frame_rows - d", "frame_rows", "failed = 0",
             "(SELECT COUNT(DISTINCT o_custkey) + MAX(CASE WHEN o_custkey IS NULL THEN 1 ELSE 0 END) AS d, "
             "COUNT(*) AS frame_rows FROM orders)")
    + "\nUNION ALL\n"
    + _row_sql(1, "unique_o_orderkey", "unique", "o_orderkey", "error", "frame_rows - d", "frame_rows", "failed = 0",
               "(SELECT COUNT(DISTINCT o_orderkey) AS d, COUNT(*) AS frame_rows FROM orders)"),
)
def dq_unique(spark, sf):
    return _report(table(spark, sf, "orders"), [Q.unique("o_custkey"), Q.unique("o_orderkey")])


@register(
    "dq_in_range",
    _row_sql(0, "in_range_c_acctbal", "in_range", "c_acctbal", "error", "c", "frame_rows", "failed = 0",
             _count_src("customer", "c_acctbal < 0 OR c_acctbal > 9000"))
    + "\nUNION ALL\n"
    + _row_sql(1, "in_range_c_acctbal", "in_range", "c_acctbal", "warning", "c", "frame_rows", "failed = 0",
               _count_src("customer", "c_acctbal < -1000"))
    + "\nUNION ALL\n"
    + _row_sql(2, "in_range_value", "in_range", "value", "error", "c", "frame_rows", "failed = 0",
               _count_src(EVENTS_SQL, "value > 50"))
    + "\nUNION ALL\n"
    + _row_sql(3, "in_range_c_acctbal", "in_range", "c_acctbal", "error", "0", "frame_rows", "TRUE",
               "(SELECT COUNT(*) AS frame_rows FROM customer)", skipped=True),
)
def dq_in_range(spark, sf):
    cust = table(spark, sf, "customer")
    ev = events_with_gaps(spark, sf)
    a = _report(cust, [Q.in_range("c_acctbal", 0, 9000), Q.in_range("c_acctbal", min_val=-1000, severity=Q.WARNING)])
    b = _report(ev, [Q.in_range("value", max_val=50)]).withColumn("ordinal", F.lit(2))
    c = _report(cust, [Q.in_range("c_acctbal")]).withColumn("ordinal", F.lit(3))
    return a.unionByName(b).unionByName(c)


@register(
    "dq_not_empty",
    _row_sql(0, "not_empty_text", "not_empty", "text", "error", "c", "frame_rows", "failed = 0",
             _count_src("documents", "text IS NULL OR length(text) = 0"))
    + "\nUNION ALL\n"
    + _row_sql(1, "not_empty_lang", "not_empty", "lang", "error", "c", "frame_rows", "failed = 0",
               _count_src("(SELECT CASE WHEN source = 'src0' THEN '' ELSE lang END AS lang FROM documents)",
                          "lang IS NULL OR length(lang) = 0")),
)
def dq_not_empty(spark, sf):
    docs = table(spark, sf, "documents").withColumn(
        "lang", F.when(F.col("source") == "src0", F.lit("")).otherwise(F.col("lang"))
    )
    return _report(docs, [Q.not_empty("text"), Q.not_empty("lang")])


URL_PATTERN = r"^https://[a-z]+\.example\.(com|org)/"


@register(
    "dq_pattern",
    _row_sql(0, "matches_pattern_url", "matches_pattern", "url", "error", "c", "frame_rows", "failed = 0",
             _count_src("pages", f"NOT coalesce(regexp_extract(url, '{URL_PATTERN}', 0) <> '', FALSE)")),
)
def dq_pattern(spark, sf):
    return _report(table(spark, sf, "pages"), [Q.matches_pattern("url", URL_PATTERN)])


@register(
    "dq_in_set",
    _row_sql(0, "in_set_role", "in_set", "role", "error", "c", "frame_rows", "failed = 0",
             _count_src("conversations", "NOT coalesce(role IN ('user', 'assistant'), FALSE)"))
    + "\nUNION ALL\n"
    + _row_sql(1, "in_set_o_orderstatus", "in_set", "o_orderstatus", "error", "c", "frame_rows", "failed = 0",
               _count_src("orders", "NOT coalesce(o_orderstatus IN ('O', 'F', 'P'), FALSE)")),
)
def dq_in_set(spark, sf):
    conv = _report(table(spark, sf, "conversations"), [Q.in_set("role", {"user", "assistant", None})])
    orders = _report(table(spark, sf, "orders"), [Q.in_set("o_orderstatus", ["O", "F", "P"])])
    return conv.unionByName(orders.withColumn("ordinal", F.lit(1)))


@register(
    "dq_row_count",
    _row_sql(0, "row_count", "row_count", None, "error", "CASE WHEN frame_rows >= 1 THEN 0 ELSE 1 END", "1",
             "failed = 0", "(SELECT COUNT(*) AS frame_rows FROM lineitem)")
    + "\nUNION ALL\n"
    + _row_sql(1, "row_count", "row_count", None, "error",
               "CASE WHEN frame_rows <= 1000 THEN 0 ELSE 1 END", "1", "failed = 0",
               "(SELECT COUNT(*) AS frame_rows FROM lineitem)")
    + "\nUNION ALL\n"
    + _row_sql(2, "row_count", "row_count", None, "error",
               "CASE WHEN frame_rows = (SELECT COUNT(*) FROM lineitem) THEN 0 ELSE 1 END", "1", "failed = 0",
               "(SELECT COUNT(*) AS frame_rows FROM lineitem)"),
)
def dq_row_count(spark, sf):
    li = table(spark, sf, "lineitem")
    exact = li.count()  # the expected size is a parameter of the rule, taken from the table
    return _report(li, [Q.row_count(min_count=1), Q.row_count(max_count=1000), Q.row_count(exact_count=exact)])


@register(
    "dq_columns",
    _row_sql(0, "column_exists", "column_exists", None, "error", "0", "3", "failed = 0",
             "(SELECT COUNT(*) AS frame_rows FROM part)")
    + "\nUNION ALL\n"
    + _row_sql(1, "column_exists", "column_exists", None, "warning", "2", "3", "failed = 0",
               "(SELECT COUNT(*) AS frame_rows FROM part)"),
)
def dq_columns(spark, sf):
    part = table(spark, sf, "part")
    return _report(part, [Q.column_exists(["p_partkey", "p_name", "p_size"]),
                          Q.column_exists(["p_partkey", "P_NAME", "p_color"], severity=Q.WARNING)])


@register(
    "dq_no_duplicates",
    _row_sql(0, "no_duplicates", "no_duplicates", "l_orderkey,l_linenumber", "error", "frame_rows - d",
             "frame_rows", "failed = 0",
             "(SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS d, "
             "COUNT(*) AS frame_rows FROM lineitem)")
    + "\nUNION ALL\n"
    + _row_sql(1, "no_duplicates", "no_duplicates", "conv_id,turn", "error", "frame_rows - d",
               "frame_rows", "failed = 0",
               "(SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT conv_id, turn FROM conversations)) AS d, "
               "COUNT(*) AS frame_rows FROM conversations)"),
)
def dq_no_duplicates(spark, sf):
    li = _report(table(spark, sf, "lineitem"), [Q.no_duplicates(["l_orderkey", "l_linenumber"])])
    conv = _report(table(spark, sf, "conversations"), [Q.no_duplicates(["conv_id", "turn"])])
    return li.unionByName(conv.withColumn("ordinal", F.lit(1)))


@register(
    "dq_custom",
    _row_sql(0, "positive_prices", "positive_prices", None, "error",
             "CASE WHEN ok THEN 0 ELSE 1 END", "1", "failed = 0",
             "(SELECT coalesce(MIN(p_retailprice) > 0, FALSE) AS ok, COUNT(*) AS frame_rows FROM part)")
    + "\nUNION ALL\n"
    + _row_sql(1, "small_parts_exist", "small_parts_exist", None, "warning",
               "CASE WHEN ok THEN 0 ELSE 1 END", "1", "failed = 0",
               "(SELECT coalesce(COUNT(*) FILTER (WHERE p_size > 60) > 0, FALSE) AS ok, "
               "COUNT(*) AS frame_rows FROM part)"),
)
def dq_custom(spark, sf):
    part = table(spark, sf, "part")
    return _report(part, [
        Q.custom("positive_prices", F.min("p_retailprice") > 0, "a part with no price, or one of zero or less"),
        Q.custom("small_parts_exist", F.count_if(F.col("p_size") > 60) > 0, "Some parts exceed size 60",
                 severity=Q.WARNING),
    ])


@register(
    "dq_referential",
    _row_sql(0, "referential_l_suppkey", "referential", "l_suppkey", "error", "c", "frame_rows", "failed = 0",
             "(SELECT COUNT(*) FILTER (WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN "
             "(SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL)) AS c, COUNT(*) AS frame_rows "
             "FROM lineitem)")
    + "\nUNION ALL\n"
    + _row_sql(1, "referential_doc_id", "referential", "doc_id", "error", "c", "frame_rows", "failed = 0",
               "(SELECT COUNT(*) FILTER (WHERE doc_id IS NOT NULL AND doc_id NOT IN "
               "(SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)) AS c, COUNT(*) AS frame_rows "
               "FROM documents)"),
)
def dq_referential(spark, sf):
    li = _report(table(spark, sf, "lineitem"),
                 [Q.referential("l_suppkey", table(spark, sf, "supplier"), "s_suppkey")])
    docs = _report(table(spark, sf, "documents"), [Q.referential("doc_id", table(spark, sf, "labels"), "doc_id")])
    return li.unionByName(docs.withColumn("ordinal", F.lit(1)))


# ---- the fused report over orders -----------------------------------------

ORDER_PATTERN = r"^[1-5]-[A-Z]"


def order_rules(spark, sf):
    return [
        Q.not_null("o_orderkey"),
        Q.unique("o_orderkey"),
        Q.in_range("o_totalprice", 1000, 400000),
        Q.in_set("o_orderstatus", {"O", "F"}),
        Q.matches_pattern("o_orderpriority", ORDER_PATTERN),
        Q.not_empty("o_orderpriority"),
        Q.row_count(min_count=1),
        Q.column_exists(["o_orderkey", "o_custkey", "o_comment"]),
        Q.no_duplicates(["o_custkey", "o_orderdate"], severity=Q.WARNING),
        Q.custom("positive_prices", F.min("o_totalprice") > 0, "a part with no price, or one of zero or less"),
        Q.not_null("o_custkey", severity=Q.WARNING, threshold=0.1),
        Q.referential("o_custkey", table(spark, sf, "customer"), "c_custkey"),
        Q.not_empty("o_totalprice", severity=Q.INFO),  # numeric column: a rule error, not a crash
    ]


def _orders_src(cond):
    return f"(SELECT COUNT(*) FILTER (WHERE {cond}) AS c, COUNT(*) AS frame_rows FROM orders)"


ORDERS_REPORT_SQL = "\nUNION ALL\n".join([
    _row_sql(0, "not_null_o_orderkey", "not_null", "o_orderkey", "error", "c", "frame_rows", "failed <= 0",
             _orders_src("o_orderkey IS NULL")),
    _row_sql(1, "unique_o_orderkey", "unique", "o_orderkey", "error", "frame_rows - d", "frame_rows", "failed = 0",
             "(SELECT COUNT(DISTINCT o_orderkey) + MAX(CASE WHEN o_orderkey IS NULL THEN 1 ELSE 0 END) AS d, "
             "COUNT(*) AS frame_rows FROM orders)"),
    _row_sql(2, "in_range_o_totalprice", "in_range", "o_totalprice", "error", "c", "frame_rows", "failed = 0",
             _orders_src("o_totalprice < 1000 OR o_totalprice > 400000")),
    _row_sql(3, "in_set_o_orderstatus", "in_set", "o_orderstatus", "error", "c", "frame_rows", "failed = 0",
             _orders_src("NOT coalesce(o_orderstatus IN ('O', 'F'), FALSE)")),
    _row_sql(4, "matches_pattern_o_orderpriority", "matches_pattern", "o_orderpriority", "error", "c", "frame_rows",
             "failed = 0", _orders_src(f"NOT coalesce(regexp_extract(o_orderpriority, '{ORDER_PATTERN}', 0) <> '', FALSE)")),
    _row_sql(5, "not_empty_o_orderpriority", "not_empty", "o_orderpriority", "error", "c", "frame_rows", "failed = 0",
             _orders_src("o_orderpriority IS NULL OR length(o_orderpriority) = 0")),
    _row_sql(6, "row_count", "row_count", None, "error", "CASE WHEN frame_rows >= 1 THEN 0 ELSE 1 END", "1",
             "failed = 0", "(SELECT COUNT(*) AS frame_rows FROM orders)"),
    _row_sql(7, "column_exists", "column_exists", None, "error", "1", "3", "failed = 0",
             "(SELECT COUNT(*) AS frame_rows FROM orders)"),
    _row_sql(8, "no_duplicates", "no_duplicates", "o_custkey,o_orderdate", "warning", "frame_rows - d", "frame_rows",
             "failed = 0",
             "(SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT o_custkey, o_orderdate FROM orders)) AS d, "
             "COUNT(*) AS frame_rows FROM orders)"),
    _row_sql(9, "positive_prices", "positive_prices", None, "error", "CASE WHEN ok THEN 0 ELSE 1 END", "1",
             "failed = 0", "(SELECT coalesce(MIN(o_totalprice) > 0, FALSE) AS ok, COUNT(*) AS frame_rows FROM orders)"),
    _row_sql(10, "not_null_o_custkey", "not_null", "o_custkey", "warning", "c", "frame_rows",
             "CASE WHEN total = 0 THEN 0.0 ELSE CAST(failed AS DOUBLE) / total END <= 0.1",
             _orders_src("o_custkey IS NULL")),
    _row_sql(11, "referential_o_custkey", "referential", "o_custkey", "error", "c", "frame_rows", "failed = 0",
             "(SELECT COUNT(*) FILTER (WHERE o_custkey IS NOT NULL AND o_custkey NOT IN "
             "(SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)) AS c, COUNT(*) AS frame_rows FROM orders)"),
    _row_sql(12, "not_empty_o_totalprice", "not_empty", "o_totalprice", "info", "0", "0", "FALSE",
             "(SELECT COUNT(*) AS frame_rows FROM orders)"),
])


@register("dq_report", ORDERS_REPORT_SQL)
def dq_report(spark, sf):
    return _report(table(spark, sf, "orders"), order_rules(spark, sf))


@register(
    "dq_summary",
    f"""
    SELECT COUNT(*) AS rule_count,
           COUNT(*) FILTER (WHERE status = 'passed') AS passed_count,
           COUNT(*) FILTER (WHERE status <> 'passed') AS failed_count,
           COUNT(*) FILTER (WHERE status <> 'passed' AND severity = 'error') AS error_count,
           COUNT(*) FILTER (WHERE status <> 'passed' AND severity = 'warning') AS warning_count,
           NOT coalesce(bool_or(status <> 'passed' AND severity = 'error'), FALSE) AS is_valid
    FROM ({ORDERS_REPORT_SQL})
    """,
)
def dq_summary(spark, sf):
    return Q.summary_frame(Q.report_frame(table(spark, sf, "orders"), order_rules(spark, sf)))


@register(
    "dq_fail_fast",
    f"""
    SELECT * FROM ({ORDERS_REPORT_SQL}) r
    WHERE ordinal <= (SELECT coalesce(MIN(ordinal), 1000000) FROM ({ORDERS_REPORT_SQL}) x
                      WHERE status = 'failed' AND severity = 'error' AND NOT (rule_name = 'not_empty' AND total_count = 0))
    """,
)
def dq_fail_fast(spark, sf):
    return _report(table(spark, sf, "orders"), order_rules(spark, sf), fail_fast=True)
