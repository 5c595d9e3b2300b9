import decimal

from pyspark.sql import functions as F

from tessera.operators.profile import profile, profile_frame


def test_profile_of_known_columns(spark):
    rows = [(9007199254740993, "ab", 1.5, decimal.Decimal("12345678901234567890.125")), (2, None, float("-2"), None), (None, "", None, None), (4, "abcd", 0.5, decimal.Decimal("-1"))]
    df = spark.createDataFrame(rows, "big long, word string, amount double, price decimal(30,3)")
    p = profile(df)
    assert (p["total_rows"], p["total_columns"]) == (4, 4)
    cols = p["columns"]
    assert {c: cols[c]["null_count"] for c in cols} == {"big": 1, "word": 1, "amount": 1, "price": 2}
    assert cols["price"]["null_percentage"] == 50.0 and cols["amount"]["data_type"] == "DoubleType()"
    assert (cols["big"]["min"], cols["big"]["max"]) == (2, 9007199254740993)  # beyond what a double holds
    assert (cols["price"]["min"], cols["price"]["max"]) == (decimal.Decimal("-1.000"), decimal.Decimal("12345678901234567890.125"))
    assert (cols["amount"]["min"], cols["amount"]["max"], cols["amount"]["avg"]) == (-2.0, 1.5, 0.0)
    assert (cols["word"]["min_length"], cols["word"]["max_length"], cols["word"]["empty_count"]) == (0, 4, 1)


def test_profile_nested_and_single_pass(spark):
    df = spark.range(50).select(F.col("id"), F.array(F.col("id").cast("float")).alias("vec"),
                                F.create_map(F.lit("k"), F.col("id")).alias("m"))
    pf = profile_frame(df)
    assert pf.count() == 3
    plan = pf._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


def test_wide_profile_is_chunked(spark):
    df = spark.range(10).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(120)])
    assert profile_frame(df, chunk=50).count() == 120


def test_approx_distinct_within_error_bound(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    got = {r["column_name"]: r["approx_distinct_count"] for r in profile_frame(orders).collect()}
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in orders.columns]).first().asDict()
    for c, n in exact.items():
        # HLL++ default relative standard deviation is 0.05; allow three deviations
        assert abs(got[c] - n) <= max(2, 3 * 0.05 * n), (c, got[c], n)
