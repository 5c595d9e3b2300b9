import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import metrics as M
from tessera.session import scratch_path


def test_merge_labels_own_wins(spark):
    df = spark.range(1).select(M.merge_labels({"a": "1", "b": "2"}, F.create_map(F.lit("b"), F.lit("x"))).alias("m"))
    assert df.first()["m"] == {"a": "1", "b": "x"}


def test_exposition_escapes_and_histogram(spark):
    run = M.PipelineRun("p", run_id="r")
    run.record("g", 1.5, description="first\nsecond", q='a"b\\c\nd')
    run.record("h", [0.004, 0.3, 20.0], M.HISTOGRAM)
    run.record("t", 0, M.TIMER)
    out = M.exposition(run.samples(spark)).orderBy("name", "section", "line").collect()
    lines = [r["line"] for r in out]
    assert lines[:2] == ["# HELP g first\\nsecond", "# TYPE g gauge"]
    assert "# TYPE h histogram" in lines and "# TYPE t gauge" in lines and not any(x.startswith("# HELP h") for x in lines)
    g = [x for x in lines if x.startswith("g{")][0]
    assert 'q="a\\"b\\\\c\\nd"' in g
    assert any(x.startswith('h_bucket{le="0.005",') and x.endswith(" 1") for x in lines)
    assert any(x.startswith('h_bucket{le="+Inf",') and x.endswith(" 3") for x in lines)
    assert any(x.startswith("h_count") and x.endswith(" 3") for x in lines)


def test_run_stages_and_timers(spark):
    run = M.PipelineRun("p")
    with run.stage("load", spark.range(10)) as observed:
        observed.write.format("noop").mode("overwrite").save()
    with pytest.raises(RuntimeError), run.stage("break", spark.range(3)):
        raise RuntimeError("boom")
    with pytest.raises(KeyError), run.timed("lookup", table="t"):
        raise KeyError("x")
    stages = {r["stage"]: r for r in run.stages(spark).collect()}
    assert (stages["load"]["input_rows"], stages["load"]["output_rows"], stages["load"]["status"]) == (10, 10, "success")
    assert (stages["break"]["status"], stages["break"]["error"]) == ("failed", "boom")
    assert [r["balanced"] for r in M.stage_balance(run.stages(spark)).orderBy("stage").collect()] == [False, True]
    names = [r["name"] for r in run.samples(spark).collect()]
    assert names.count("pipeline_stage_duration_seconds") == 2 and "lookup" in names
    assert M.run_rollup(run.stages(spark)).first()["status"] == "failed"
    run.finish("success")
    assert M.run_rollup(run.stages(spark), run.runs(spark)).first()["status"] == "success"


def test_run_status_comes_from_rows(spark):
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 5)
    rows = [("p", "open", "a", t0, t1, 1, 1, "success", None, {}), ("p", "open", "b", t1, None, 1, 0, "running", None, {}),
            ("p", "bad", "a", t0, t1, 1, 1, "failed", "e", {}), ("p", "good", "a", t0, t1, 1, 1, "success", None, {}),
            ("p", "said", "a", t0, t1, 1, 1, "success", None, {})]
    stages = spark.createDataFrame(rows, M.STAGE_SCHEMA)
    runs = spark.createDataFrame([("p", "said", "failed", t1 + dt.timedelta(seconds=1))], M.RUN_SCHEMA)
    got = {r["run_id"]: (r["status"], r["duration_seconds"]) for r in M.run_rollup(stages, runs).collect()}
    assert got == {"open": ("running", None), "bad": ("failed", 300.0), "good": ("success", 300.0), "said": ("failed", 301.0)}
    report = {r["run_id"]: r for r in M.run_report(stages, runs).collect()}
    assert len(report["open"]["stage_list"]) == 2 and '"status":"running"' in report["open"]["report_json"]


def test_reports_are_saved(spark):
    df = spark.createDataFrame([("a 1",), ("b 2",)], "line string")
    for kind, read in (("json", spark.read.json), ("text", spark.read.text)):
        path = scratch_path(spark, "report")
        M.save_report(df, path, kind)
        assert read(path).count() == 2
    with pytest.raises(ValueError):
        M.save_report(df, scratch_path(spark, "report"), "html")


@pytest.mark.parametrize("bins", [2, 7, 200])
def test_exact_quantiles(spark, bins):
    rng = random.Random(bins)
    rows = [("hot", float(rng.choice([0, 1, 1, 2, rng.random()]))) for _ in range(700)] + [(None, 3.0), ("one", 5.0), ("nulls", None), ("one", None)]
    qs = (0.0, 0.25, 0.5, 0.99, 1.0)
    got = M.summary(spark.createDataFrame(rows, "g string, v double"), "v", ["g"], qs, bins=bins).collect()
    for name in ("hot", None, "one"):
        values = [v for g, v in rows if g == name and v is not None]
        want = [float(x) for x in np.quantile(values, qs)]
        mine = {r["quantile"]: r for r in got if r["g"] == name}
        assert [mine[q]["value"] for q in qs] == pytest.approx(want) and mine[0.5]["count"] == len(values)
    assert not any(r["g"] == "nulls" for r in got)
    whole = M.summary(spark.createDataFrame(rows, "g string, v double"), "v", (), (0.5,), bins=bins).first()
    assert whole["value"] == pytest.approx(float(np.quantile([v for _, v in rows if v is not None], 0.5)))


def test_histogram_cumulative(spark):
    df = spark.createDataFrame([(0.001,), (0.2,), (3.0,), (50.0,)], "v double")
    h = {r["le"]: r["bucket_count"] for r in M.histogram(df, "v").collect()}
    assert h["0.005"] == 1 and h["0.25"] == 2 and h["5"] == 3 and h["+Inf"] == 4
