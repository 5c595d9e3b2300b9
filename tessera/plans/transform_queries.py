"""Registered transform and source/sink queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import transforms as X
from tessera.plans.quality_queries import EVENTS_SQL, events_with_gaps
from tessera.plans.registry import register, table
from tessera.session import scratch_path
from tessera.sources import io, quarantine

FIXED_NOW = "2024-01-31 00:00:00"


def _fixed_now():
    return F.lit(FIXED_NOW).cast("timestamp_ntz")


@register(
    "audit_columns",
    f"""SELECT c_custkey, c_name, TIMESTAMP '{FIXED_NOW}' AS created_at, TIMESTAMP '{FIXED_NOW}' AS updated_at
        FROM customer""",
)
def audit_columns(spark, sf):
    return X.add_audit_columns(table(spark, sf, "customer").select("c_custkey", "c_name"), now=_fixed_now())


@register(
    "partition_columns",
    """SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year,
              CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day
       FROM orders""",
)
def partition_columns(spark, sf):
    return X.add_partition_columns(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


@register(
    "standardize_names",
    "SELECT c_custkey AS cust_key, c_name AS customer_name, c_acctbal AS acct_bal, "
    "c_mktsegment AS mkt__segment FROM customer",
)
def standardize_names(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Cust Key"),
        F.col("c_name").alias("Customer-Name"),
        F.col("c_acctbal").alias("ACCT.Bal"),
        F.col("c_mktsegment").alias("MKT  Segment"),
    )
    return X.standardize_column_names(c)


@register(
    "lineage_columns",
    f"""SELECT o_orderkey, 'erp' AS source_system, 'orders' AS source_table,
               TIMESTAMP '{FIXED_NOW}' AS extraction_time, '1.0' AS pipeline_version,
               'nightly' AS pipeline_id
        FROM orders""",
)
def lineage_columns(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return X.add_constant(X.add_lineage_columns(o, "erp", "orders", "1.0", extracted_at=_fixed_now()),
                          "pipeline_id", "nightly")


def _orders_as_text(spark, sf):
    """Orders as they arrive from a text source: every field a string."""
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("customer"),
        F.col("o_totalprice").cast("string").alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("o_orderpriority").alias("priority"),
    )


@register(
    "cast_strict",
    """SELECT o_orderkey AS id, o_totalprice AS amount, CAST(o_orderdate AS DATE) AS order_date FROM orders""",
)
def cast_strict(spark, sf):
    t = _orders_as_text(spark, sf)
    return t.select(
        F.col("id").cast("long").alias("id"),
        F.col("amount").cast("double").alias("amount"),
        F.to_date("order_date").alias("order_date"),
    )


def _spoiled(spark, sf):
    t = _orders_as_text(spark, sf)
    return t.withColumn(
        "amount", F.when(F.col("priority") == "4-NOT SPECIFIED", F.lit("invalid")).otherwise(F.col("amount"))
    )


@register(
    "try_cast_split",
    """SELECT o_orderkey AS id,
              CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_totalprice END AS amount,
              o_orderpriority <> '4-NOT SPECIFIED' AS _cast_ok
       FROM orders""",
)
def try_cast_split(spark, sf):
    flagged = X.flag_castable(_spoiled(spark, sf), "amount", "double")
    return flagged.select(F.col("id").cast("long").alias("id"), "amount", "_cast_ok")


@register(
    "quarantine_rows",
    "SELECT o_orderkey AS id, 'invalid' AS amount FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'",
)
def quarantine_rows(spark, sf):
    _, bad = X.split_castable(_spoiled(spark, sf), "amount", "double")
    return bad.select(F.col("id").cast("long").alias("id"), "amount")


@register("remove_nulls", f"SELECT event_id, value FROM {EVENTS_SQL} WHERE value IS NOT NULL")
def remove_nulls(spark, sf):
    return X.remove_nulls(events_with_gaps(spark, sf), ["value"]).select("event_id", "value")


@register(
    "etl_clean",
    f"""SELECT event_id, value, DATE '2024-01-31' AS run_date FROM {EVENTS_SQL} WHERE value IS NOT NULL""",
)
def etl_clean(spark, sf):
    ev = events_with_gaps(spark, sf).where(F.col("value").isNotNull())
    return X.stamp_run_date(ev.select("event_id", "value"), "2024-01-31")


@register(
    "incremental_hwm",
    """SELECT event_id, user_id, event_type FROM events
       WHERE event_id > (SELECT MAX(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-15')""",
)
def incremental_hwm(spark, sf):
    ev = table(spark, sf, "events")
    # The previous run's mark: one scalar from the already-loaded part.
    mark = ev.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")).agg(F.max("event_id")).first()[0]
    return X.filter_above_mark(ev, "event_id", mark).select("event_id", "user_id", "event_type")


@register(
    "missing_default",
    "SELECT c_custkey, c_name, 0.0 AS c_acctbal, CAST(NULL AS VARCHAR) AS c_comment FROM customer",
)
def missing_default(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    return X.ensure_columns(c, {"c_acctbal": ("double", 0.0), "c_comment": ("string", None), "c_name": ("string", "")})


LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register(
    "dedup_latest",
    f"""SELECT {', '.join(LINE_COLS)} FROM (
          SELECT *, ROW_NUMBER() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC NULLS LAST,
                     {', '.join(c + ' ASC NULLS FIRST' for c in LINE_COLS if c not in ('l_orderkey', 'l_linenumber', 'l_shipdate'))}
          ) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedup_latest(spark, sf):
    return X.deduplicate(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], order_by="l_shipdate")


@register("dedup_any_keys", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_any_keys(spark, sf):
    return X.deduplicate(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber"
    )


@register("dedup_text", "SELECT COUNT(DISTINCT text) AS distinct_texts FROM documents")
def dedup_text(spark, sf):
    # a 256-bit digest stands for the text: the texts themselves are not shuffled
    digests = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    kept = X.deduplicate(digests, ["digest"], order_by="doc_id")
    return kept.agg(F.count(F.lit(1)).alias("distinct_texts"))


# ---- sources and sinks ------------------------------------------------------

def _lineitem_csv(spark, sf):
    path = scratch_path(spark, "csv")
    io.write_csv(table(spark, sf, "lineitem"), path, timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return path


@register("src_csv_roundtrip", "SELECT * FROM lineitem")
def src_csv_roundtrip(spark, sf):
    """All columns as text, then cast back: doubles and timestamps come back as they were."""
    text = io.read_csv(spark, _lineitem_csv(spark, sf))
    if any(t != "string" for _, t in text.dtypes):
        raise ValueError("a CSV read without a schema gives text")
    return text.select(*[F.col(f.name).cast(f.dataType) for f in table(spark, sf, "lineitem").schema])


@register("src_csv_infer", "SELECT * FROM lineitem")
def src_csv_infer(spark, sf):
    df = io.read_csv(spark, _lineitem_csv(spark, sf), infer=True, inferSchema="true", preferDate="false")
    # inference picks int or long by magnitude and a zoned timestamp; state the table's types
    return df.select(*[F.col(f.name).cast(f.dataType) for f in table(spark, sf, "lineitem").schema])


@register("src_json_roundtrip", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def src_json_roundtrip(spark, sf):
    ev = table(spark, sf, "events")
    path = scratch_path(spark, "json")
    io.write_json(ev, path)
    return io.read_json(spark, path, schema=ev.schema)


@register("src_any_format", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def src_any_format(spark, sf):
    s = table(spark, sf, "supplier")
    path = scratch_path(spark, "orc")
    io.write_files(s, path, format="orc")
    return io.read_any(spark, path, format="orc", schema=s.schema)


def _events_by_day(spark, sf, partition_by=("date",)):
    path = scratch_path(spark, "events_by_day")
    ev = table(spark, sf, "events").withColumn("date", F.to_date("ts"))
    io.write_parquet(ev, path, partition_by=list(partition_by))
    return path


EVENT_COLS = "event_id, ts, user_id, event_type, value, props"


@register(
    "scan_by_date",
    f"SELECT {EVENT_COLS}, CAST(ts AS DATE) AS date FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'",
)
def scan_by_date(spark, sf):
    return io.read_by_date(spark, _events_by_day(spark, sf), "2024-01-05")


@register(
    "partition_prune",
    f"""SELECT {EVENT_COLS}, CAST(ts AS DATE) AS date FROM events
        WHERE CAST(ts AS DATE) = DATE '2024-01-05' AND event_type = 'click'""",
)
def partition_prune(spark, sf):
    path = _events_by_day(spark, sf, partition_by=("date", "event_type"))
    return io.read_parquet(spark, path).where(
        (F.col("date") == F.lit("2024-01-05").cast("date")) & (F.col("event_type") == "click")
    )


@register("sink_partitioned", f"SELECT {EVENT_COLS}, CAST(ts AS DATE) AS date FROM events")
def sink_partitioned(spark, sf):
    path = _events_by_day(spark, sf)
    # re-running one day replaces only that day's partition
    ev = table(spark, sf, "events").withColumn("date", F.to_date("ts"))
    io.write_parquet(ev.where(F.col("date") == F.lit("2024-01-05").cast("date")), path, partition_by=["date"])
    return io.read_parquet(spark, path)


@register(
    "file_inventory",
    "SELECT CAST(ts AS DATE) AS date, TRUE AS has_bytes, COUNT(*) AS n_rows FROM events GROUP BY 1",
)
def file_inventory(spark, sf):
    """Files by day, with the rows that are in the files listed (names and sizes depend on the writer)."""
    path = _events_by_day(spark, sf)
    tail = r"(date=[^/]+/[^/]+)$"
    files = io.file_inventory(spark, path, glob="*.parquet").select(F.regexp_extract("path", tail, 1).alias("file"), "size")
    rows = spark.read.parquet(path).select(F.regexp_extract("_metadata.file_path", tail, 1).alias("file"))
    day = F.regexp_extract("file", r"date=([0-9-]+)", 1).cast(T.DateType()).alias("date")
    return files.join(rows.groupBy("file").agg(F.count(F.lit(1)).alias("n")), "file").groupBy(day).agg(
        (F.min("size") > 0).alias("has_bytes"), F.sum("n").alias("n_rows")
    )


@register("sink_table_modes", "SELECT o_orderpriority AS grp, COUNT(*) AS n, SUM(o_orderkey) AS keys FROM orders GROUP BY 1")
def sink_table_modes(spark, sf):
    """A catalog table through every mode; its columns come in another order than the table's."""
    name = f"tessera_{uuid.uuid4().hex[:12]}"
    io.create_database(spark, name, scratch_path(spark, "db"))
    t, o = f"{name}.orders", table(spark, sf, "orders")
    o = o.select(F.col("o_orderpriority").alias("grp"), F.col("o_orderkey").alias("key"), F.lit(0).alias("x"))
    io.write_table(o.where("grp = '5-LOW'"), t, "create", partition_by=["grp"])
    io.write_table(o.where("grp = '1-URGENT'").select("x", "grp", "key"), t, "append")
    io.write_table(spark.table(t).where("grp = '1-URGENT'").select("key", "x", "grp"), t, "overwrite")  # reads itself
    io.write_table(o.where("grp <> '1-URGENT'").select("x", "key", "grp"), t, "overwrite_partitions")
    io.write_table(spark.table(t).select("grp", "key"), t, "create_or_replace")
    return spark.table(t).groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum("key").alias("keys"))


# ---- rows that do not parse, first occurrences --------------------------------

ORDERS_DDL = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate date, o_orderpriority string"


def _damaged_csv(spark, sf):
    """Orders as CSV; by their key some have no number for a price, no date, a column too few or too many."""
    o, k = table(spark, sf, "orders"), F.col("o_orderkey")
    fields = [
        k.cast("string"), F.col("o_custkey").cast("string"), F.when(k % 7 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")),
        F.when(k % 11 == 0, "someday").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
        F.when(k % 13 != 0, F.concat(F.lit('"'), "o_orderpriority", F.lit(', quoted"'))), F.when(k % 17 == 0, "extra"),
    ]
    path = scratch_path(spark, "damaged")
    header = spark.createDataFrame([(", ".join(c.split()[0] for c in ORDERS_DDL.split(", ")).replace(", ", ","),)], "line string")
    o.select(F.concat_ws(",", *fields).alias("line")).write.text(path)
    header.write.mode("append").text(path)
    return path


REASON_SQL = """CASE WHEN (o_orderkey % 13 = 0) <> (o_orderkey % 17 = 0) THEN 'wrong number of columns'
        WHEN o_orderkey % 7 = 0 THEN 'column o_totalprice' WHEN o_orderkey % 11 = 0 THEN 'column o_orderdate' END"""


@register(
    "src_csv_quarantine",
    f"""SELECT o_orderkey, reason IS NULL AS good, reason, CASE WHEN reason IS NULL THEN o_custkey END AS o_custkey,
               CASE WHEN reason IS NULL THEN o_totalprice END AS o_totalprice, CASE WHEN reason IS NULL THEN CAST(o_orderdate AS DATE) END AS o_orderdate,
               CASE WHEN reason IS NULL THEN CASE WHEN o_orderkey % 13 = 0 THEN 'extra' ELSE o_orderpriority || ', quoted' END END AS o_orderpriority
        FROM (SELECT *, {REASON_SQL} AS reason FROM orders)""",
)
def src_csv_quarantine(spark, sf):
    """Good rows and quarantined lines together: all lines; a line with one column missing and one too many has as many as it should."""
    good, bad = quarantine.split_checked(quarantine.read_csv_checked(spark, _damaged_csv(spark, sf), ORDERS_DDL))
    key = F.regexp_extract("line", "^([0-9]+)", 1).cast("long").alias("o_orderkey")
    return good.withColumns({"good": F.lit(True), "reason": F.lit(None).cast("string")}).unionByName(
        bad.select(key, F.lit(False).alias("good"), "reason"), allowMissingColumns=True
    )


@register("dedup_first", "SELECT md5(text) AS digest, MIN(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, arg_min(source, doc_id) AS source FROM documents GROUP BY text")
def dedup_first(spark, sf):
    """The first document of each text by its place in the file, where documents stand in the order of their ids."""
    docs = table(spark, sf, "documents").select(F.md5("text").alias("digest"), "doc_id", "lang", "source")
    return quarantine.first_occurrence(docs, ["digest"])
