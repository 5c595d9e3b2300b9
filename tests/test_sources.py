import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tessera import plans
from tessera.session import scratch_path
from tessera.sources import io


@pytest.fixture
def database(spark):
    name = f"tessera_{uuid.uuid4().hex[:12]}"
    io.create_database(spark, name, scratch_path(spark, "db"))
    io.create_database(spark, name)  # again: nothing happens
    yield name
    io.drop_database(spark, name, cascade=True)
    io.drop_database(spark, name)
    assert not spark.catalog.databaseExists(name)


def test_table_sink_modes(spark, database):
    t = f"{database}.t"
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id long, name string, amount double")
    with pytest.raises(ValueError):
        io.write_table(df, t, "overwrite_partitions")
    io.write_table(df, t, "create")
    io.write_table(df.limit(1), t, "append")
    assert spark.table(t).count() == 3
    io.write_table(df, t, "overwrite")
    assert spark.table(t).count() == 2
    io.write_table(df.limit(1), t, "create_or_replace")
    assert spark.table(t).count() == 1
    with pytest.raises(ValueError):
        io.write_table(df, t, "upsert")
    with pytest.raises(AnalysisException):
        io.write_table(df, t, "create")
    with pytest.raises(Exception):
        io.drop_database(spark, database)  # it has a table


def test_table_columns_go_by_name(spark, database):
    t = f"{database}.named"
    io.write_table(spark.createDataFrame([(1, 10, "x")], "a int, b int, p string"), t, "create", partition_by=["p"])
    io.write_table(spark.createDataFrame([("x", 20, 2)], "p string, b int, a int"), t, "append")
    io.write_table(spark.createDataFrame([(30, "y", 3)], "b int, p string, a int"), t, "overwrite_partitions")
    assert sorted(map(tuple, spark.table(t).select("a", "b", "p").collect())) == [(1, 10, "x"), (2, 20, "x"), (3, 30, "y")]
    for odd in ("a int, b int", "a int, b int, p string, q int"):
        with pytest.raises(ValueError):
            io.write_table(spark.createDataFrame([], odd), t, "append")


def test_a_table_replaced_from_itself(spark, database):
    t = f"{database}.own"
    io.write_table(spark.range(10), t, "create")
    io.write_table(spark.table(t).where("id > 3"), t, "overwrite")
    io.write_table(spark.table(t).select((F.col("id") * 2).alias("twice")), t, "create_or_replace")
    assert sorted(r[0] for r in spark.table(t).collect()) == [8, 10, 12, 14, 16, 18]
    failing = spark.table(t).select(F.raise_error(F.lit("boom")).cast("long").alias("twice"))
    for mode in ("create_or_replace", "overwrite"):
        with pytest.raises(Exception, match="boom"):
            io.write_table(failing, t, mode)
    assert spark.table(t).count() == 6  # untouched


def test_a_day_is_read_from_its_folder(spark):
    path = scratch_path(spark, "days")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("date", F.to_date("ts"))
    io.write_parquet(ev, path, partition_by=["date"])
    day = io.read_by_date(spark, path, "2024-01-05")
    assert len(day.inputFiles()) and all("date=2024-01-05" in f for f in day.inputFiles())
    assert day.count() == ev.where("date = '2024-01-05'").count() == day.where("date = DATE '2024-01-05'").count()
    assert io.read_by_date(spark, path, "1999-01-01", schema=ev.schema).count() == 0
    with pytest.raises(ValueError):
        io.read_by_date(spark, path, "1999-01-01")


def test_csv_without_inference_is_text(spark):
    path = scratch_path(spark, "csv_t")
    io.write_csv(spark.createDataFrame([(1, 2.5)], "a long, b double"), path)
    assert {t for _, t in io.read_csv(spark, path).dtypes} == {"string"}
    assert dict(io.read_csv(spark, path, infer=True).dtypes)["b"] == "double"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark):
    p = _plan(plans.QUERIES["q_hourly_recent"](spark, "/root/testdata/sf0.001"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    p = _plan(plans.QUERIES["partition_prune"](spark, "/root/testdata/sf0.001"))
    assert "PartitionFilters: [isnotnull(date" in p and "event_type" in p.split("PartitionFilters")[1][:400]


def test_projection_is_pruned(spark):
    p = _plan(plans.QUERIES["scan_parquet"](spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<>" in p


def test_inventory_lists_without_content(spark):
    path = scratch_path(spark, "inv")
    spark.range(10).repartition(2).write.parquet(path)
    inv = io.file_inventory(spark, path, glob="*.parquet")
    assert inv.count() == 2 and "content" not in inv.columns


def test_show_and_describe(spark, database):
    rows = spark.createDataFrame([("Ada", 30, "x"), ("Bo", 25, "y"), ("Cy", 41, "x")], ["name", "age", "dept"])  # literal rows
    io.write_table(rows, f"{database}.people", "create", partition_by=["dept"])
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == ["people"]
    assert [(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(f"{database}.people")] == [
        ("name", "string", False), ("age", "bigint", False), ("dept", "string", True),
    ]
    assert spark.table(f"{database}.people").orderBy(F.desc("age")).first()["name"] == "Cy"
