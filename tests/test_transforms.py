import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import transforms as X


def test_dedup_latest_keeps_newest(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    out = X.deduplicate(orders, ["o_custkey"], order_by="o_orderdate")
    newest = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("o_orderdate"))
    assert out.count() == newest.count() == out.join(newest, ["o_custkey", "o_orderdate"]).count()


def test_dedup_keeps_input_row_num_column(spark):
    df = spark.createDataFrame([(1, 7), (1, 8)], ["k", "row_num"])
    out = X.deduplicate(df, ["k"], order_by="row_num")
    assert out.columns == ["k", "row_num"] and out.first()["row_num"] == 8


def test_dedup_nulls_last_and_ties(spark):
    df = spark.createDataFrame([(1, None, "b"), (1, 5, "z"), (1, 5, "a")], "k int, o int, v string")
    assert X.deduplicate(df, ["k"], "o").first()["v"] == "a"


def test_dedup_plan_limits_before_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = X.deduplicate(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_standardize_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Column Name", "Another-Column", "UPPERCASE"])
    assert X.standardize_column_names(df).columns == ["column_name", "another_column", "uppercase"]
    clash = spark.createDataFrame([(1, 2)], ["a b", "a-b"])
    with pytest.raises(ValueError):
        X.standardize_column_names(clash)


def test_audit_and_partition_columns(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 3, 9, 10))], ["id", "created_at"])
    out = X.add_partition_columns(X.add_audit_columns(df.drop("created_at")).withColumn(
        "created_at", F.lit("2024-03-09").cast("date")))
    r = out.first()
    assert (r["year"], r["month"], r["day"]) == (2024, 3, 9) and r["updated_at"] is not None


def test_try_cast_split_and_defaults(spark):
    df = spark.createDataFrame([("1", "10.5"), ("2", "invalid"), ("3", None)], ["id", "amount"])
    good, bad = X.split_castable(df, "amount", "double")
    assert good.count() == 2 and bad.count() == 1
    out = X.ensure_columns(df.select("id"), {"amount": ("double", 0.0)})
    assert out.first()["amount"] == 0.0


def test_remove_nulls_keeps_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert X.remove_nulls(df, ["v"]).count() == 2


def test_empty_input_keeps_schema(spark):
    df = spark.createDataFrame([], "id string, name string, amount double")
    out = X.add_lineage_columns(X.add_audit_columns(df), "s", "t", "1")
    assert out.count() == 0 and "source_system" in out.columns
