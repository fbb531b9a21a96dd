"""Evaluation and error analysis of scored tables.

A *scored table* holds the actual value (``label``) and one prediction column
per model; ``predictions`` maps a model name to its column.  Residual =
actual - predicted (positive = under-estimate).  Every multi-model table is one
aggregate with per-model expressions whose single row (or one row per group)
is then unpivoted -- the input is never replicated per model.
"""
from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulae.functions import band_label, code_order, label_of
from tabulae.operators.quantiles import EXACT, grouped_quantiles, quantile_table


def _ok(label: str, prediction: str) -> Column:
    return F.col(label).isNotNull() & F.col(prediction).isNotNull()


def _metric_exprs(label: str, prediction: str, tag: str) -> list[Column]:
    ok = _ok(label, prediction)
    e = F.when(ok, F.col(label) - F.col(prediction))
    return [F.count(e).alias(f"n_{tag}"), F.avg(F.abs(e)).alias(f"mae_{tag}"),
            F.sum(e * e).alias(f"sse_{tag}"), F.var_pop(F.when(ok, F.col(label))).alias(f"vy_{tag}"),
            F.coalesce(F.sum((~ok).cast("long")), F.lit(0)).alias(f"skipped_{tag}")]


def _metric_struct(name: str, tag: str) -> Column:
    n = F.col(f"n_{tag}")
    return F.struct(F.lit(name).alias("model"), n.alias("n"), F.col(f"mae_{tag}").alias("mae"),
                    F.sqrt(F.try_divide(F.col(f"sse_{tag}"), n)).alias("rmse"),
                    (F.lit(1.0) - F.try_divide(F.col(f"sse_{tag}"), F.col(f"vy_{tag}") * n)).alias("r2"),
                    F.col(f"skipped_{tag}").alias("skipped"))


def metrics(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    """n, MAE, RMSE and R^2 (about the evaluated set's mean) in one aggregate.

    Rows with a NULL actual or prediction are skipped and counted.
    """
    return metrics_table(pred, label, {prediction: prediction}).drop("model")


def metrics_table(pred: DataFrame, label: str, predictions: Mapping[str, str]) -> DataFrame:
    """One row of metrics per model."""
    exprs, rows = [], []
    for i, (name, col) in enumerate(predictions.items()):
        exprs += _metric_exprs(label, col, str(i))
        rows.append(_metric_struct(name, str(i)))
    return pred.agg(*exprs).select(F.inline(F.array(*rows)))


def improvement(table: DataFrame, baseline: str, metrics_cols: Sequence[str] = ("mae", "rmse")) -> DataFrame:
    """% improvement of each model over the baseline row for each metric.

    ``table`` has one row per model; the baseline value reaches every row through a
    window over that small table, so the (possibly expensive) metrics are computed once.
    """
    everyone = Window.partitionBy()
    out = table
    for m in metrics_cols:
        base = F.max(F.when(F.col("model") == baseline, F.col(m))).over(everyone)
        out = out.withColumn(f"{m}_improvement_pct", F.try_divide(100.0 * (base - F.col(m)), base))
    return out


def generalisation_gap(grid: DataFrame, metrics_cols: Sequence[str] = ("mae", "rmse", "r2")) -> DataFrame:
    """Validation minus training value of each metric of a grid table."""
    out = grid
    for m in metrics_cols:
        out = out.withColumn(f"{m}_gap", F.col(f"{m}_valid") - F.col(f"{m}_train"))
    return out


def metric_range(grid: DataFrame, metric: str = "rmse_valid") -> DataFrame:
    """Spread of a metric across configurations."""
    return grid.agg(F.min(metric).alias("min"), F.max(metric).alias("max"),
                    (F.max(metric) - F.min(metric)).alias("range"))


def compare_splits(first: DataFrame, second: DataFrame, metrics_cols: Sequence[str] = ("mae", "rmse", "r2"),
                   names: tuple[str, str] = ("valid", "test")) -> DataFrame:
    """Metrics of two evaluations side by side per model with % change."""
    a, b = names
    left = first.select("model", *[F.col(m).alias(f"{m}_{a}") for m in metrics_cols])
    right = second.select("model", *[F.col(m).alias(f"{m}_{b}") for m in metrics_cols])
    out = left.join(right, "model", "left")
    for m in metrics_cols:
        out = out.withColumn(f"{m}_change_pct",
                             F.try_divide(100.0 * (F.col(f"{m}_{b}") - F.col(f"{m}_{a}")), F.abs(F.col(f"{m}_{a}"))))
    return out


def error_by_group(pred: DataFrame, column: str, label: str, predictions: Mapping[str, str],
                   labels: Mapping[str, str] | None = None) -> DataFrame:
    """Per category: n, mean actual and, per model, mean prediction, MAE, mean error."""
    exprs = [F.count(F.lit(1)).alias("n"), F.avg(label).alias("actual_mean")]
    for name, col in predictions.items():
        e = F.col(label) - F.col(col)
        exprs += [F.avg(col).alias(f"pred_mean_{name}"), F.avg(F.abs(e)).alias(f"mae_{name}"),
                  F.avg(e).alias(f"error_mean_{name}")]
    agg = pred.groupBy(F.col(column).cast("string").alias("code")).agg(*exprs)
    return (agg.select(F.lit(column).alias("variable"), "code", label_of("code", labels or {}).alias("category"),
                       *[c for c in agg.columns if c != "code"])
               .orderBy(*code_order("code")))


def subset_summary(pred: DataFrame, column: str, codes: Sequence[str], predictions: Mapping[str, str],
                   ps: Sequence[float] = (0.1, 0.9), method: str = EXACT, accuracy: int = 10000) -> DataFrame:
    """Rows whose ``column`` is in ``codes``: n and, per model, mean prediction and element
    percentiles of the prediction (F6)."""
    sub = pred.filter(F.col(column).isin(list(codes)))
    exprs, rows = [F.count(F.lit(1)).alias("n")], []
    exprs += [F.avg(col).alias(f"m{i}") for i, col in enumerate(predictions.values())]
    one = grouped_quantiles(sub, [], exprs, {f"q{i}": col for i, col in enumerate(predictions.values())}, list(ps), False,
                            method, accuracy)
    for i, name in enumerate(predictions):
        rows.append(F.struct(F.lit(name).alias("model"), F.col("n").alias("n"), F.col(f"m{i}").alias("pred_mean"),
                             *[F.col(f"q{i}")[k].cast("double").alias(f"p{round(100 * p)}") for k, p in enumerate(ps)]))
    return one.select(F.inline(F.array(*rows)))


def relative_error_by_group(table: DataFrame, model_a: str, model_b: str, min_n: int = 100) -> DataFrame:
    """Groups with n >= min_n: MAE relative to the mean actual for two models, and who wins."""
    t = table.filter(F.col("n") >= min_n)
    return (t.withColumn(f"rel_mae_{model_a}", F.try_divide(F.col(f"mae_{model_a}"), F.col("actual_mean")))
             .withColumn(f"rel_mae_{model_b}", F.try_divide(F.col(f"mae_{model_b}"), F.col("actual_mean")))
             .withColumn("better", F.when(F.col(f"mae_{model_a}") < F.col(f"mae_{model_b}"), F.lit(model_a))
                                    .when(F.col(f"mae_{model_b}") < F.col(f"mae_{model_a}"), F.lit(model_b))
                                    .otherwise(F.lit("tie"))))


def wins(table: DataFrame) -> DataFrame:
    """How many groups each model wins."""
    return table.groupBy("better").agg(F.count(F.lit(1)).alias("groups"))


def band_cuts(df: DataFrame, column: str, percentiles: Sequence[float], method: str = EXACT,
              accuracy: int = 10000) -> DataFrame:
    """Band cut points = element-valued quantiles of ``column`` as one array row."""
    return quantile_table(df, column, list(percentiles), (), False, method, accuracy, "cuts")


def collect_cuts(cuts: DataFrame) -> list[float]:
    """The (bounded) cut list on the driver."""
    return [float(x) for x in cuts.first()["cuts"]]


def _band(col: Column, cuts: Sequence[float]) -> Column:
    """Index of the ``(a, b]`` band: the number of cuts below the value; NULL and NaN have none."""
    passed = sum((F.when(col > F.lit(float(c)), 1).otherwise(0) for c in cuts), F.lit(0))
    return F.when(col.isNotNull() & ~F.isnan(col), passed)


def error_by_band(pred: DataFrame, label: str, prediction: str, cuts: Sequence[float]) -> DataFrame:
    """Error by band of the actual value, ``(a, b]`` with open first / last band.

    Tied cuts are not merged: a band ``(a, a]`` is empty and absent.  A NULL
    actual goes to a NULL band (not into the last one).
    """
    return error_by_band_models(pred, label, {"model": prediction}, cuts).drop("model")


def error_by_band_models(pred: DataFrame, label: str, predictions: Mapping[str, str],
                         cuts: Sequence[float]) -> DataFrame:
    """E9 for several models at once, stacked by model."""
    cuts = [float(c) for c in cuts]
    exprs = [F.count(F.lit(1)).alias("n"), F.avg(label).alias("actual_mean")]
    for i, col in enumerate(predictions.values()):
        e = F.col(label) - F.col(col)
        exprs += [F.avg(col).alias(f"pm{i}"), F.avg(F.abs(e)).alias(f"mae{i}"), F.avg(e).alias(f"me{i}")]
    agg = pred.groupBy(_band(F.col(label), cuts).alias("band")).agg(*exprs)
    bounds = F.array(*[F.lit(c) for c in cuts])
    lo = F.when(F.col("band") > 0, F.element_at(bounds, F.col("band")))
    hi = F.when(F.col("band") < len(cuts), F.element_at(bounds, F.col("band") + 1))
    rows = [F.struct(F.lit(name).alias("model"), F.col(f"pm{i}").alias("pred_mean"),
                     F.col(f"mae{i}").alias("mae"), F.col(f"me{i}").alias("error_mean"))
            for i, name in enumerate(predictions)]
    return (agg.select("band", band_label(lo, hi).alias("range"), "n", "actual_mean", F.inline(F.array(*rows)))
               .select("model", "band", "range", "n", "actual_mean", "pred_mean", "mae", "error_mean"))


def band_gain(bands: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """Per band: MAE of ``model_a`` minus MAE of ``model_b`` (positive = b better)."""
    wide = bands.groupBy("band", "range").pivot("model", [model_a, model_b]).agg(F.first("mae"))
    return (wide.withColumn("gain", F.col(model_a) - F.col(model_b))
                .withColumn("winner", F.when(F.col("gain") > 0, F.lit(model_b))
                                       .when(F.col("gain") < 0, F.lit(model_a)).otherwise(F.lit("tie")))
                .withColumnRenamed(model_a, f"mae_{model_a}").withColumnRenamed(model_b, f"mae_{model_b}"))


def decile_cuts(pred: DataFrame, prediction: str, groups: int = 10, method: str = EXACT,
                accuracy: int = 10000) -> list[float]:
    """Sorted distinct element quantiles i/groups of the prediction (at most groups-1 numbers)."""
    ps = [i / groups for i in range(1, groups)]
    q = quantile_table(pred, prediction, ps, (), False, method, accuracy, "c")
    row = q.select(F.array_distinct(F.array_sort("c")).alias("c")).first()
    return [float(x) for x in (row["c"] or []) if x is not None]


def error_by_prediction_decile(pred: DataFrame, label: str, prediction: str, groups: int = 10,
                               method: str = EXACT, accuracy: int = 10000) -> DataFrame:
    """Calibration by quantile group of the prediction, ``[a, b)`` buckets, tied cuts merged.

    The cuts are the sorted distinct element quantiles i/groups (a bounded list
    of at most groups-1 numbers); a row's bucket is the number of cuts <= its
    prediction, exactly a Bucketizer over ``[-inf] + cuts + [inf]``, written as
    a sum of literal comparisons so it stays inside whole-stage codegen.
    NULL / NaN predictions get a NULL bucket.
    """
    cuts = decile_cuts(pred, prediction, groups, method, accuracy)
    p = F.col(prediction)
    count = F.lit(0)
    for c in cuts:
        count = count + (p >= F.lit(c)).cast("int")
    bucket = F.when(p.isNotNull() & ~F.isnan(p), count.cast("double"))
    e = F.col(label) - p
    return (pred.groupBy(bucket.alias("decile"))
                .agg(F.count(F.lit(1)).alias("n"), F.avg(prediction).alias("pred_mean"),
                     F.avg(label).alias("actual_mean"), F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("error_mean"))
                .orderBy("decile"))


def prediction_range(pred: DataFrame, columns: Mapping[str, str], method: str = EXACT,
                     accuracy: int = 10000) -> DataFrame:
    """min, P1, P99, max and count of negatives per column, one aggregate."""
    exprs, rows = [], []
    for i, (name, col) in enumerate(columns.items()):
        exprs += [F.min(col).cast("double").alias(f"mn{i}"), F.max(col).cast("double").alias(f"mx{i}"),
                  F.sum((F.col(col) < 0).cast("long")).alias(f"neg{i}")]
        rows.append(F.struct(F.lit(name).alias("series"), F.col(f"mn{i}").alias("min"),
                             F.col(f"q{i}")[0].cast("double").alias("p1"), F.col(f"q{i}")[1].cast("double").alias("p99"),
                             F.col(f"mx{i}").alias("max"), F.coalesce(F.col(f"neg{i}"), F.lit(0)).alias("negatives")))
    one = grouped_quantiles(pred, [], exprs, {f"q{i}": col for i, col in enumerate(columns.values())}, [0.01, 0.99], False,
                            method, accuracy)
    return one.select(F.inline(F.array(*rows)))


def error_summary(pred: DataFrame, label: str, predictions: Mapping[str, str], high: float, tail: float,
                  tolerance: float = 0.2, method: str = EXACT, accuracy: int = 10000) -> DataFrame:
    """Size and sign of the errors per model.

    median absolute error; % of rows with |error| <= tolerance * actual; %
    under-estimated overall and among actual > ``high``; share (%) of the
    squared error coming from actual > ``tail``.
    """
    y = F.col(label)
    exprs, rows = [], []
    for i, (name, col) in enumerate(predictions.items()):
        e = y - F.col(col)
        exprs += [F.avg((F.abs(e) <= tolerance * y).cast("double")).alias(f"in{i}"),
                  F.avg((e > 0).cast("double")).alias(f"un{i}"),
                  F.avg(F.when(y > high, (e > 0).cast("double"))).alias(f"uh{i}"),
                  F.sum(e * e).alias(f"sse{i}"), F.sum(F.when(y > tail, e * e)).alias(f"sst{i}")]
        rows.append(F.struct(F.lit(name).alias("model"), F.col(f"med{i}")[0].cast("double").alias("median_abs_error"),
                             (100.0 * F.col(f"in{i}")).alias("pct_within_tolerance"),
                             (100.0 * F.col(f"un{i}")).alias("pct_under"),
                             (100.0 * F.col(f"uh{i}")).alias("pct_under_high"),
                             F.try_divide(100.0 * F.coalesce(F.col(f"sst{i}"), F.lit(0.0)), F.col(f"sse{i}")).alias("pct_sq_error_tail")))
    base = pred.select("*", *[F.abs(y - F.col(c)).alias(f"_ae{i}") for i, c in enumerate(predictions.values())])
    one = grouped_quantiles(base, [], exprs, {f"med{i}": f"_ae{i}" for i in range(len(predictions))}, [0.5], False,
                            method, accuracy)
    return one.select(F.inline(F.array(*rows)))
