"""Lines that do not parse, and first occurrences, on files of several parts."""

import random
from collections import Counter

import pytest

from tessera.session import scratch_path
from tessera.sources.quarantine import first_occurrence, read_csv_checked, split_checked, write_checked

DDL = "id int, `a b` double, d date, s string"
LINES = {
    "1,1.5,2024-01-01,x": None, "2,,,": None, '3,2e3,2024-02-29,"a, ""quoted"" one"': None, "4,abc,2024-01-01,x": "column a b",
    "5,1.0,2024-02-30,x": "column d", "99999999999,1.0,,": "column id", "x,y,z,w": "column id", "6,1.0,2024-01-01": "wrong number of columns",
    "7,1.0,2024-01-01,x,y": "wrong number of columns", "é,1,2024-01-01,ü": "column id", "8,NaN,2024-01-01, padded ": None,
}


def write_lines(tmp_path, parts):
    for k, lines in enumerate(parts):
        (tmp_path / f"part-{k}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(tmp_path)


def test_good_and_bad_are_all_lines(spark, tmp_path):
    head, lines = "id,a b,d,s", list(LINES)
    path = write_lines(tmp_path, [[head, *lines[:6], "", "   "], [head, *lines[6:]], [head]])
    rows = read_csv_checked(spark, path, DDL, escape='"')
    good, bad = split_checked(rows)
    assert {r["line"]: r["reason"] for r in bad.collect()} == {x: r for x, r in LINES.items() if r}
    assert {r["line"]: r["file"][-10:] for r in bad.collect()} == {x: f"part-{int(k >= 6)}.csv" for k, x in enumerate(lines) if LINES[x]}
    mine = {r["id"]: r for r in good.collect()}
    assert set(mine) == {1, 2, 3, 8} and mine[3]["s"] == 'a, "quoted" one' and mine[2]["a b"] is None and str(mine[3]["d"]) == "2024-02-29"
    out = write_checked(rows, scratch_path(spark, "good"), scratch_path(spark, "bad"))
    assert out == {"good": 4, "bad": 7} and sum(out.values()) == len(LINES)


def test_a_query_of_few_columns_finds_the_same_bad_lines(spark, tmp_path):
    path = write_lines(tmp_path, [list(LINES)])
    good, bad = split_checked(read_csv_checked(spark, path, DDL, header=False))
    assert good.select("id").count() == 4 == good.count() and bad.select("reason").count() == 7
    assert Counter(r["reason"] for r in bad.groupBy("reason").count().collect()) == Counter({r for r in LINES.values() if r})


def test_options_and_empty_files(spark, tmp_path):
    path = write_lines(tmp_path, [["1;1,5;01.02.2024;x", "2;1;2024-01-01;x"], []])
    good, bad = split_checked(read_csv_checked(spark, path, "id int, a string, d date, s string", header=False, sep=";", dateFormat="dd.MM.yyyy"))
    assert [tuple(map(str, r)) for r in good.collect()] == [("1", "1,5", "2024-02-01", "x")]
    assert [r["reason"] for r in bad.collect()] == ["column d"]


@pytest.mark.parametrize("kind", ["parquet", "json"])
def test_first_occurrence_by_file_and_place(spark, kind):
    rng = random.Random(2)
    path, want = scratch_path(spark, "parts"), {}
    for k in range(4):
        rows = [(rng.choice(["hot", "hot", "b", None, str(rng.randrange(30))]), rng.randrange(10**6), None) for _ in range(200)]
        part = f"{path}/part={k}"
        spark.createDataFrame(rows, "`k.y` string, v int, w string").coalesce(1).sortWithinPartitions("v").write.format(kind).save(part)
        for row in sorted(rows, key=lambda r: r[1]):
            want.setdefault(row[0], row[1])
    files = spark.read.schema("`k.y` string, v int, w string, part int").format(kind).load(path)
    got = first_occurrence(files, ["k.y"])
    assert got.columns == files.columns and {r["k.y"]: r["v"] for r in got.collect()} == want
    assert {r["k.y"] for r in first_occurrence(files.where("v < 0"), ["k.y"]).collect()} == set()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min_by") == 1 or "min_by" in plan
