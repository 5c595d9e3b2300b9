"""Registered queries over a clustered layout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import layout as L
from tessera.plans.registry import register, table
from tessera.session import scratch_path

FILES = 64
COLUMNS = ["l_shipdate", "l_partkey"]
DAYS = (dt.datetime(1998, 1, 1), dt.datetime(1998, 6, 30))


def _layouts(spark, sf):
    """lineitem as it comes and clustered, in as many files."""
    li = table(spark, sf, "lineitem")
    rows = -(-li.count() // FILES)
    plain, near = scratch_path(spark, "plain"), scratch_path(spark, "clustered")
    li.repartition(FILES).write.parquet(plain)
    L.rewrite(li, near, COLUMNS, file_rows=rows)
    return spark.read.parquet(plain), spark.read.parquet(near)


@register("layout_zorder", "SELECT * FROM lineitem")
def layout_zorder(spark, sf):
    return _layouts(spark, sf)[1]


BOX_SQL = f"""l_shipdate BETWEEN TIMESTAMP '{DAYS[0]}' AND TIMESTAMP '{DAYS[1]}'
        AND l_partkey <= (SELECT max(l_partkey) // 8 FROM lineitem)"""


@register("layout_zorder_files", f"SELECT COUNT(*) AS box_rows, TRUE AS few_files FROM lineitem WHERE {BOX_SQL}")
def layout_zorder_files(spark, sf):
    """Rows in a box of two columns, and whether it touches at most a quarter of the files that it does in the plain layout."""
    plain, near = _layouts(spark, sf)
    top = table(spark, sf, "lineitem").agg(F.max("l_partkey")).first()[0] // 8
    box = {"l_shipdate": DAYS, "l_partkey": (0, top)}
    touched = [L.files_touched(x, box).select("touched", F.lit(1).alias("one")) for x in (plain, near)]
    few = touched[0].withColumnRenamed("touched", "plain").join(touched[1], "one").select("one", (F.col("touched") * 4 <= F.col("plain")).alias("few_files"))
    rows = near.where(F.col("l_shipdate").between(*DAYS) & F.col("l_partkey").between(0, top)).agg(F.count(F.lit(1)).alias("box_rows"))
    return rows.withColumn("one", F.lit(1)).join(few, "one").drop("one")
