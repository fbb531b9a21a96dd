"""Evaluation: hand-computed metrics, bands, groups and summaries."""
import math

import pytest
from pyspark.sql import functions as F

from tabulae.operators import evaluate as E


def test_metrics(spark):
    d = spark.createDataFrame([(100.0, 200.0), (200.0, 200.0), (300.0, 200.0), (None, 1.0)], "y double, p double")
    r = E.metrics(d, "y", "p").first()
    assert r.n == 3 and r.skipped == 1
    assert r.mae == pytest.approx(200 / 3) and r.rmse == pytest.approx(math.sqrt(20000 / 3)) and r.r2 == pytest.approx(0.0)


def test_metrics_match_regression_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    d = spark.range(200).select((F.col("id") * 1.5).alias("y"), (F.col("id") * 1.4 + 3).alias("p"))
    r = E.metrics(d, "y", "p").first()
    for m in ("mae", "rmse", "r2"):
        ev = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=m).evaluate(d)
        assert getattr(r, m) == pytest.approx(ev, rel=1e-12)


def test_bands(spark):
    d = spark.createDataFrame([(float(v), 350.0) for v in (100, 200, 300, 400, 500, 600)], "y double, p double")
    t = E.error_by_band(d, "y", "p", [250.0, 450.0]).orderBy("band").collect()
    assert [r.n for r in t] == [2, 2, 2]
    assert [r.error_mean for r in t] == [-200.0, 0.0, 200.0] and [r.mae for r in t] == [200.0, 50.0, 200.0]
    assert [r.range for r in t] == ["<= Q250", "Q250 - Q450", "> Q450"]


def test_band_null_actual_and_tied_cuts(spark):
    d = spark.createDataFrame([(None, 1.0), (5.0, 1.0), (10.0, 1.0)], "y double, p double")
    t = {r.band: r.n for r in E.error_by_band(d, "y", "p", [5.0, 5.0]).collect()}
    assert t == {None: 1, 0: 1, 2: 1}  # (5, 5] is empty and absent


def test_error_by_group(spark):
    d = spark.createDataFrame([("0", 100.0, 200.0), ("0", 300.0, 200.0), ("5", 500.0, 200.0)], "lvl string, y double, p double")
    t = {r.code: r for r in E.error_by_group(d, "lvl", "y", {"m": "p"}, {"0": "none"}).collect()}
    assert t["0"].mae_m == 100.0 and t["0"].error_mean_m == 0.0 and t["0"].category == "none"
    assert t["5"].mae_m == 300.0 and t["5"].error_mean_m == 300.0 and t["5"].category == "5"


def test_error_summary(spark):
    d = spark.createDataFrame([(100.0, 150.0), (200.0, 190.0), (300.0, 300.0), (1000.0, 400.0)], "y double, p double")
    r = E.error_summary(d, "y", {"m": "p"}, high=500, tail=500, tolerance=0.2).first()
    assert r.pct_within_tolerance == 50.0 and r.pct_under == 50.0 and r.pct_under_high == 100.0
    assert r.pct_sq_error_tail == pytest.approx(100 * 360000 / 362600)
    assert r.median_abs_error == 10.0  # element median of |e| = 50, 10, 0, 600


def test_prediction_groups(spark):
    d = spark.range(1, 21).select((F.col("id") * 10.0).alias("y"), (F.col("id") * 10.0).alias("p"))
    t = E.error_by_prediction_decile(d, "y", "p", 4).collect()
    assert len(t) == 4 and sum(r.n for r in t) == 20 and all(r.error_mean == 0 for r in t)


def test_all_equal_predictions_single_group(spark):
    d = spark.range(10).select(F.col("id").cast("double").alias("y"), F.lit(3.0).alias("p"))
    t = E.error_by_prediction_decile(d, "y", "p", 10).collect()
    assert len(t) == 1 and t[0].n == 10


def test_metrics_table_and_compare(spark):
    d = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, 2.0, 2.0), (3.0, 3.5, 2.0)], "y double, a double, b double")
    t = E.metrics_table(d, "y", {"a": "a", "b": "b"})
    assert {r.model for r in t.collect()} == {"a", "b"}
    imp = {r.model: r.mae_improvement_pct for r in E.improvement(t, "b").collect()}
    assert imp["b"] == 0.0 and imp["a"] > 0
    c = E.compare_splits(t, t).collect()
    assert all(r.mae_change_pct == 0.0 for r in c)


def test_prediction_range(spark):
    d = spark.createDataFrame([(float(v), float(v) - 5) for v in range(1, 101)], "y double, p double")
    t = {r.series: r for r in E.prediction_range(d, {"actual": "y", "m": "p"}).collect()}
    assert t["actual"].p1 == 1.0 and t["actual"].p99 == 99.0 and t["m"].negatives == 4


def test_band_gain(spark):
    d = spark.createDataFrame([(float(v), float(v) + 1, 350.0) for v in (100, 200, 300, 400)], "y double, a double, b double")
    g = E.band_gain(E.error_by_band_models(d, "y", {"a": "a", "b": "b"}, [250.0]), "a", "b").collect()
    assert all(r.winner == "a" for r in g)


def test_decile_nan_and_null_predictions_get_null_bucket(spark):
    rows = [(float(i), float(i)) for i in range(1, 21)] + [(5.0, float("nan")), (6.0, None)]
    d = spark.createDataFrame(rows, "y double, p double")
    t = {r.decile: r.n for r in E.error_by_prediction_decile(d, "y", "p", 4).collect()}
    assert t[None] == 2 and sum(v for k, v in t.items() if k is not None) == 20


def test_empty_inputs(spark):
    d = spark.createDataFrame([], "y double, p double")
    r = E.metrics(d, "y", "p").first()
    assert (r.n, r.mae, r.rmse, r.skipped) == (0, None, None, 0)
    assert E.error_by_band(d, "y", "p", [1.0]).count() == 0
