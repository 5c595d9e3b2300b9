import pytest
from pyspark.sql import functions as F

from tessera.operators.versioned import VersionedTable, VersionedTableError
from tessera.session import scratch_path


def new(spark, schema="id long, name string, value double"):
    return VersionedTable(spark, scratch_path(spark, "t")).create(schema)


def _key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_key)


def test_write_modes_and_time_travel(spark):
    t = new(spark, "id long, value string")
    t.append(spark.createDataFrame([(1, "a"), (2, "b")], "id long, value string"))
    t.append(spark.createDataFrame([(3, "c"), (4, "d")], "id long, value string"))
    assert t.read().count() == 4 and t.read(1).count() == 2
    assert rows(t.read(), "id") == rows(t.read(t.current_version), "id")
    t.overwrite(spark.createDataFrame([(9, "z")], "id long, value string"))
    assert rows(t.read(), "id") == [(9,)] and t.read(2).count() == 4


def test_update_delete(spark):
    t = new(spark, "id long, name string, status string")
    t.append(spark.createDataFrame([(1, "a", "active"), (2, "b", "inactive"), (3, "c", "active"),
                                    (4, "d", None)], "id long, name string, status string"))
    t.delete("status = 'inactive'")        # NULL status row is kept
    t.update(F.col("id") == 1, {"name": F.lit("A")})
    assert t.read().count() == 3 and t.read().where("id = 1").first()["name"] == "A"
    h = rows(t.history(), "version", "operation")
    assert h == [(0, "create"), (1, "append"), (2, "delete"), (3, "update")]


def test_merge_semantics(spark):
    t = new(spark)
    t.append(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)], "id long, name string, value double"))
    src = spark.createDataFrame([(2, "B", 20.0), (3, "c", 3.0), (None, "m", 9.0)], "id long, name string, value double")
    t.merge(src, ["id"])
    out = rows(t.read(), "id", "name")
    assert out == sorted([(1, "a"), (2, "B"), (3, "c"), (None, "n"), (None, "m")], key=_key)
    dup = spark.createDataFrame([(1, "x", 0.0), (1, "y", 0.0)], "id long, name string, value double")
    v = t.current_version
    with pytest.raises(VersionedTableError):
        t.merge(dup, ["id"])
    assert t.current_version == v  # nothing committed


def test_schema_evolution(spark):
    t = new(spark, "id long, name string")
    t.append(spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string"))
    t.add_column("email", "string")
    t.append(spark.createDataFrame([(3, "c", "c@x")], "id long, name string, email string"))
    out = rows(t.read(), "id", "email")
    assert out == [(1, None), (2, None), (3, "c@x")]
    t.rename_column("name", "full_name")
    assert "full_name" in t.read().columns and t.read().count() == 3


def test_rollback_compact_expire(spark):
    t = new(spark, "id long, v long")
    t.append(spark.range(100).select("id", (F.col("id") * 2).alias("v")))
    t.update("id < 10", {"v": F.lit(-1)})
    t.delete("id >= 90")
    before = rows(t.read(), "id", "v")
    v = t.compact()
    assert rows(t.read(), "id", "v") == before and t.current_version == v == 4
    t.rollback(1)
    assert rows(t.read(), "id", "v") == rows(t.read(1), "id", "v") == [(i, 2 * i) for i in range(100)]
    assert t.unreferenced().count() == 0
    assert t.expire(keep_from_version=4) == 4
    assert rows(t.read(4), "id", "v") == before
    with pytest.raises(VersionedTableError):
        t.read(1)
    assert {r["version"] for r in t.unreferenced().select("version").distinct().collect()} == {1, 2, 3}
    assert new(spark).expire() == 0  # a young table keeps all


def test_rollback_revives_deleted_rows(spark):
    t = new(spark, "id long")
    t.append(spark.range(5).select("id"))
    t.delete("id < 3")
    t.rollback(1)
    t.delete("id = 4")
    assert rows(t.read(), "id") == [(0,), (1,), (2,), (3,)]
    got = {(r["id"], r["change_type"]) for r in t.changes(1).collect()}
    assert got == {(4, "delete")}


def test_append_only_reads_have_no_exchange(spark):
    t = new(spark, "id long")
    for k in range(3):
        t.append(spark.range(k, k + 2).select("id"))
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and t.read().count() == 6


def test_a_write_that_dies_leaves_nothing(spark):
    t = VersionedTable(spark, scratch_path(spark, "dies")).create("id long, d string", partition_by=["d"])
    t._attempt(t._fresh(t._physical(spark.range(20).select("id", F.lit("x").alias("d")))))  # no commit follows
    t.append(spark.createDataFrame([(1, "x")], "id long, d string"))
    assert rows(t.read(), "id") == [(1,)] and t.history().where("version = 1").first()["rows_inserted"] == 1
    assert t.unreferenced().count() >= 1


def test_second_writer_fails(spark):
    t = new(spark, "id long")
    other = VersionedTable(spark, t.path)
    other.commits()
    t.append(spark.range(3).select("id"))
    with pytest.raises(VersionedTableError):
        other.append(spark.range(9).select("id"))
    assert t.read().count() == 3
    other.append(spark.range(1).select("id"))  # it has seen the other's commit now
    assert VersionedTable(spark, t.path).read().count() == 4


def test_overwrite_replaces_null_partitions(spark):
    t = VersionedTable(spark, scratch_path(spark, "nulls")).create("id long, d string", partition_by=["d"])
    t.append(spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id long, d string"))
    t.overwrite(spark.createDataFrame([(9, None)], "id long, d string"), partitions=True)
    assert rows(t.read(), "id") == [(1,), (3,), (9,)]
    t.overwrite(spark.createDataFrame([], "id long, d string"), partitions=True)
    assert t.read().count() == 3


def test_versions_keep_their_columns(spark):
    t = new(spark, "id long, name string")
    t.append(spark.createDataFrame([(1, "a")], "id long, name string"))
    t.add_column("email", "string")
    t.rename_column("name", "full_name")
    assert t.read(1).columns == ["id", "name"] and t.read(2).columns == ["id", "name", "email"]
    assert t.read().columns == ["id", "full_name", "email"] == t.logical_schema().names
    t.rollback(1)
    assert t.read().columns == ["id", "name"] and t.properties() == {}


def test_drop(spark):
    t = new(spark)
    t.append(spark.createDataFrame([(1, "a", 1.0)], "id long, name string, value double"))
    t.drop()
    t.drop()
    assert not t.exists() and not VersionedTable(spark, t.path).exists()
    with pytest.raises(VersionedTableError):
        t.read()


def test_merge_variants(spark):
    schema = "id long, name string, value double"
    t = VersionedTable(spark, scratch_path(spark, "m")).create(schema, properties={"owner": "us"})
    t.append(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], schema))
    src = spark.createDataFrame([(2, "B", 20.0), (3, "c", 3.0)], schema)
    t.merge(src, ["id"], update_columns=["value"], insert=False)
    assert rows(t.read(), "id", "name", "value") == [(1, "a", 1.0), (2, "b", 20.0)]
    t.merge(src.select("id", "name"), ["id"], stream=("q1", 4))
    assert rows(t.read(), "id", "name", "value") == [(1, "a", 1.0), (2, "B", 20.0), (3, "c", None)]
    v = t.current_version
    again = spark.createDataFrame([(None, "n", 0.0)], schema)
    assert t.merge(again, ["id"], stream=("q1", 4)) == v and t.merge(again, ["id"], stream=("q1", 3)) == v
    t.merge(again, ["id"], stream=("q2", 0))
    t.merge(again, ["id"], stream=("q1", 5))
    assert t.read().where("id IS NULL").count() == 2 and t.properties() == {"owner": "us"}
    with pytest.raises(VersionedTableError):
        t.merge(src.withColumn("odd", F.lit(1)), ["id"])


def test_partitioned_table_prunes(spark):
    t = VersionedTable(spark, scratch_path(spark, "p")).create("id long, d string", partition_by=["d"])
    t.append(spark.createDataFrame([(1, "x"), (2, "y")], "id long, d string"))
    plan = t.read().where("d = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "d#" in plan.split("PartitionFilters")[1][:300]


def test_changes_of_no_rows(spark):
    t = new(spark, "id long, s string")
    empty = spark.createDataFrame([], "id long, s string")
    t.append(empty)
    t.append(spark.range(3).select("id", F.lit("x").alias("s")))
    t.delete("false")
    t.update("id > 100", {"s": F.lit("y")})
    t.merge(empty, ["id"])
    assert t.read().count() == 3 and "Exchange" not in t.read()._jdf.queryExecution().executedPlan().toString()
    t.overwrite(empty)
    t.compact()
    assert t.read().count() == 0 and t.history().count() == 8


def test_merge_evaluates_its_source_once(spark):
    t = new(spark, "id long, s string")
    t.append(spark.range(50).select("id", F.lit("old").alias("s")))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    source = spark.range(40, 60, 1, 2).select("id", F.lit("new").alias("s")).mapInArrow(count, "id long, s string")
    t.merge(source, ["id"])
    assert seen.value == 20 and t.read().where("s = 'new'").count() == 20
