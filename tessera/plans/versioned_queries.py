"""Registered versioned-table queries.  Each builds a fresh table from
``orders`` in the shared folder, runs a sequence of commits and returns a
state, a history or a change view.  Changes are chosen by value predicates
on the data (status, priority, price, date)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators.versioned import VersionedTable
from tessera.plans.registry import register, table
from tessera.session import scratch_path

ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _new_table(spark, sf, name, partition_by=()):
    o = table(spark, sf, "orders")
    now = dt.datetime(2023, 12, 31) if name.startswith("vt_asof") else None
    t = VersionedTable(spark, scratch_path(spark, name)).create(o.schema, partition_by=partition_by, committed_at=now)
    return o, t


@register("vt_append", f"SELECT {ORDER_COLS} FROM orders")
def vt_append(spark, sf):
    o, t = _new_table(spark, sf, "vt_append")
    t.append(o.where("o_orderstatus = 'F'"))
    t.append(o.where("o_orderstatus <> 'F'"))
    return t.read()


@register("vt_overwrite", f"SELECT {ORDER_COLS} FROM orders WHERE o_orderstatus = 'P'")
def vt_overwrite(spark, sf):
    o, t = _new_table(spark, sf, "vt_overwrite")
    t.append(o)
    t.overwrite(o.where("o_orderstatus = 'P'"))
    return t.read()


@register(
    "vt_overwrite_partitions",
    """SELECT o_orderkey, o_custkey, o_orderstatus,
              CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1000.0 ELSE o_totalprice END AS o_totalprice,
              o_orderdate, o_orderpriority
       FROM orders""",
)
def vt_overwrite_partitions(spark, sf):
    o, t = _new_table(spark, sf, "vt_overwrite_parts", partition_by=["o_orderstatus"])
    t.append(o)
    t.overwrite(o.where("o_orderstatus = 'P'").withColumn("o_totalprice", F.col("o_totalprice") + 1000.0),
                partitions=True)
    return t.read()


UPDATE_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_totalprice > 300000 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
FROM orders"""


@register("vt_update", UPDATE_SQL)
def vt_update(spark, sf):
    o, t = _new_table(spark, sf, "vt_update")
    t.append(o)
    t.update("o_totalprice > 300000", {"o_orderpriority": F.lit("1-URGENT")})
    return t.read()


@register("vt_delete", f"SELECT {ORDER_COLS} FROM orders WHERE NOT coalesce(o_orderpriority = '5-LOW', FALSE)")
def vt_delete(spark, sf):
    o, t = _new_table(spark, sf, "vt_delete")
    t.append(o)
    t.delete(F.col("o_orderpriority") == "5-LOW")
    return t.read()


def merge_source(o):
    """2-HIGH orders with a raised price (matches) plus 3-MEDIUM orders under
    new keys above the current maximum (inserts)."""
    shift = o.agg(F.max("o_orderkey")).first()[0] + 1  # one scalar
    upd = o.where("o_orderpriority = '2-HIGH'").withColumn("o_totalprice", F.col("o_totalprice") + 1000.0)
    new = o.where("o_orderpriority = '3-MEDIUM'").withColumns(
        {"o_orderkey": F.col("o_orderkey") + F.lit(shift), "o_orderstatus": F.lit("N")}
    )
    return upd.unionByName(new)


MERGE_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice + 1000.0 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders
UNION ALL
SELECT o_orderkey + (SELECT MAX(o_orderkey) + 1 FROM orders), o_custkey, 'N', o_totalprice, o_orderdate,
       o_orderpriority
FROM orders WHERE o_orderpriority = '3-MEDIUM'"""


@register("vt_merge", MERGE_SQL)
def vt_merge(spark, sf):
    o, t = _new_table(spark, sf, "vt_merge")
    t.append(o)
    t.merge(merge_source(o), on=["o_orderkey"])
    return t.read()


def _three_versions(spark, sf, name):
    o, t = _new_table(spark, sf, name)
    t.append(o.where("o_orderstatus <> 'O'"), committed_at=dt.datetime(2024, 1, 1))
    t.append(o.where("o_orderstatus = 'O'"), committed_at=dt.datetime(2024, 1, 2))
    t.delete("o_orderpriority = '5-LOW'", committed_at=dt.datetime(2024, 1, 3))
    return o, t


@register("vt_as_of_version", f"SELECT {ORDER_COLS} FROM orders")
def vt_as_of_version(spark, sf):
    _, t = _three_versions(spark, sf, "vt_asof_v")
    return t.read(version=2)


@register("vt_as_of_ts", f"SELECT {ORDER_COLS} FROM orders WHERE o_orderstatus <> 'O'")
def vt_as_of_ts(spark, sf):
    _, t = _three_versions(spark, sf, "vt_asof_ts")
    return t.read_at("2024-01-01T12:00:00")


def _crud(spark, sf, name):
    """Insert all orders, update old orders' status, delete cheap orders, merge."""
    o, t = _new_table(spark, sf, name)
    t.append(o)                                                                        # v1
    t.update(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"),         # v2
             {"o_orderstatus": F.lit("X")})
    t.delete(F.col("o_totalprice") < 10000)                                            # v3
    t.merge(merge_source(o), on=["o_orderkey"])                                        # v4
    return o, t


CRUD_STATE_SQL = """
WITH base AS (
  SELECT o_orderkey, o_custkey,
         -- matched merge rows take every non-key column from the source (original status)
         CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderstatus
              WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE NOT coalesce(o_totalprice < 10000, FALSE)
)
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice + 1000.0 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM base
UNION ALL
SELECT o_orderkey + (SELECT MAX(o_orderkey) + 1 FROM orders), o_custkey, 'N', o_totalprice, o_orderdate,
       o_orderpriority
FROM orders WHERE o_orderpriority = '3-MEDIUM'
UNION ALL
-- merge source rows whose target row was deleted earlier no longer match: inserted
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1000.0, o_orderdate, o_orderpriority
FROM orders WHERE o_orderpriority = '2-HIGH' AND o_totalprice < 10000
"""


@register("vt_crud", CRUD_STATE_SQL)
def vt_crud(spark, sf):
    _, t = _crud(spark, sf, "vt_crud")
    return t.read()


@register(
    "vt_history",
    """
    SELECT CAST(0 AS BIGINT) AS version, 'create' AS operation, CAST(0 AS BIGINT) AS rows_inserted,
           CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted
    UNION ALL SELECT 1, 'append', COUNT(*), 0, 0 FROM orders
    UNION ALL SELECT 2, 'update', 0, COUNT(*) FILTER (WHERE o_orderdate < TIMESTAMP '1996-01-01'), 0 FROM orders
    UNION ALL SELECT 3, 'delete', 0, 0, COUNT(*) FILTER (WHERE o_totalprice < 10000) FROM orders
    UNION ALL SELECT 4, 'merge',
                     COUNT(*) FILTER (WHERE o_orderpriority = '3-MEDIUM'
                                      OR (o_orderpriority = '2-HIGH' AND o_totalprice < 10000)),
                     COUNT(*) FILTER (WHERE o_orderpriority = '2-HIGH' AND NOT o_totalprice < 10000), 0 FROM orders
    """,
)
def vt_history(spark, sf):
    _, t = _crud(spark, sf, "vt_history")
    return t.history().drop("committed_at")


@register("vt_rollback", f"SELECT {ORDER_COLS} FROM orders")
def vt_rollback(spark, sf):
    _, t = _crud(spark, sf, "vt_rollback")
    t.rollback(1)
    return t.read()


@register(
    "vt_changes",
    """
    SELECT o_orderkey, 'delete' AS change_type FROM orders WHERE o_totalprice < 10000
    UNION ALL
    SELECT o_orderkey, 'update' FROM orders
    WHERE NOT o_totalprice < 10000
      AND ((o_orderdate < TIMESTAMP '1996-01-01' AND o_orderstatus <> 'X') OR o_orderpriority = '2-HIGH')
    UNION ALL
    SELECT o_orderkey + (SELECT MAX(o_orderkey) + 1 FROM orders), 'insert' FROM orders
    WHERE o_orderpriority = '3-MEDIUM'
    UNION ALL
    SELECT o_orderkey, 'insert' FROM orders WHERE o_orderpriority = '2-HIGH' AND o_totalprice < 10000
    """,
)
def vt_changes(spark, sf):
    _, t = _crud(spark, sf, "vt_changes")
    return t.changes(1, 4).select("o_orderkey", "change_type")


@register("vt_expire", CRUD_STATE_SQL)
def vt_expire(spark, sf):
    _, t = _crud(spark, sf, "vt_expire")
    t.expire(keep_from_version=3)
    return t.read()


@register("vt_compact", CRUD_STATE_SQL)
def vt_compact(spark, sf):
    _, t = _crud(spark, sf, "vt_compact")
    t.compact()
    return t.read()


@register(
    "vt_orphans",
    """
    SELECT CAST(1 AS BIGINT) AS version, COUNT(*) AS n_rows FROM orders
    UNION ALL
    SELECT 2, COUNT(*) FILTER (WHERE o_orderdate < TIMESTAMP '1996-01-01') FROM orders
    UNION ALL
    SELECT 3, COUNT(*) FILTER (WHERE o_totalprice < 10000) FROM orders
    UNION ALL
    SELECT 4, COUNT(*) FILTER (WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM')) FROM orders
    """,
)
def vt_orphans(spark, sf):
    """Rows in files that no readable version needs once all but a rewritten version has expired."""
    _, t = _crud(spark, sf, "vt_orphans")
    t.compact()
    t.expire(keep_from_version=5)
    name = F.regexp_extract(F.col("path"), "(_version=.*)$", 1)
    idle = t.unreferenced().select(name.alias("file"))
    rows = spark.read.option("recursiveFileLookup", "true").parquet(t.data_path)
    rows = rows.select(F.regexp_extract("_metadata.file_path", "(_version=.*)$", 1).alias("file"))
    version = F.regexp_extract("file", r"^_version=(\d+)/", 1).cast("long").alias("version")
    return rows.join(idle, "file", "left_semi").groupBy(version).agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "vt_add_column",
    f"""
    SELECT {ORDER_COLS}, CAST(NULL AS VARCHAR) AS o_note FROM orders
    UNION ALL
    SELECT o_orderkey + (SELECT MAX(o_orderkey) + 1 FROM orders), o_custkey, o_orderstatus, o_totalprice,
           o_orderdate, o_orderpriority, 'late' AS o_note
    FROM orders WHERE o_orderpriority = '1-URGENT'
    """,
)
def vt_add_column(spark, sf):
    o, t = _new_table(spark, sf, "vt_add_column")
    t.append(o)
    t.add_column("o_note", "string")
    shift = o.agg(F.max("o_orderkey")).first()[0] + 1
    late = o.where("o_orderpriority = '1-URGENT'").withColumns(
        {"o_orderkey": F.col("o_orderkey") + F.lit(shift), "o_note": F.lit("late")}
    )
    t.append(late)
    return t.read()


@register(
    "vt_rename_column",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority AS priority
       FROM orders WHERE o_orderstatus <> 'P'""",
)
def vt_rename_column(spark, sf):
    o, t = _new_table(spark, sf, "vt_rename")
    t.append(o)
    t.rename_column("o_orderpriority", "priority")
    t.delete("o_orderstatus = 'P'")
    return t.read()
