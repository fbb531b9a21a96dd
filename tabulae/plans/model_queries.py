"""Models and error analysis bound to the driver's tables.

Out-of-time design on ``records``: train = 1995-1999, validation = 2000,
test = 2001, development = 1995-2000.  Value-checked queries score with
SQL-expressible models -- the training mean (reference model), one-variable
ordinary least squares and a single unbootstrapped depth-1 tree on a binary
code -- whose DuckDB forms are ``avg``, ``regr_intercept / regr_slope`` and
group means.  Grids, forests and importances are randomised / iterative and
get the rows-only check plus invariant tests.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from tabulae.operators import evaluate as E
from tabulae.operators import features as FE
from tabulae.operators import gram as GR
from tabulae.operators import models as M
from tabulae.plans.explore_queries import RECORDS_SQL
from tabulae.plans.quality_queries import PRIORITIES_OK
from tabulae.plans.registry import query, round_doubles, rsql
from tabulae.plans.tables import records
from tabulae.sources import io as IO
from tabulae.sources.shared import shared_folder, written

LABEL = "l_extendedprice"
NUMERICS = ["l_quantity", "l_discount", "l_tax"]
CATEGORICALS = ["o_orderpriority", "l_returnflag"]
LINE = ["l_orderkey", "l_linenumber"]
TRAIN_YEARS = [1995, 1996, 1997, 1998, 1999]
VALID_YEARS = [2000]
TEST_YEARS = [2001]
DEV_PERIODS = [f"{y}Q{q}" for y in TRAIN_YEARS + VALID_YEARS for q in (1, 2, 3, 4)]
BAND_PS = [0.2, 0.4, 0.6, 0.8]
# Fixed values of the binding: labels of the order-priority codes.
PRIORITY_LABELS = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "not specified"}


def _splits(spark, sf_dir, columns=None):
    """Training, validation and test records; with ``columns`` those of all three years are joined once and kept."""
    # ranges of the order date, which the scan can skip row groups by
    r, at = records(spark, sf_dir), F.col("o_orderdate")

    def years(wanted):
        first, after = (F.lit(f"{y}-01-01 00:00:00").cast("timestamp") for y in (min(wanted), max(wanted) + 1))
        return r.filter((at >= first) & (at < after))

    if columns is not None:
        r = written(years(TRAIN_YEARS + VALID_YEARS + TEST_YEARS).select(*columns, "o_orderdate"))
    return years(TRAIN_YEARS), years(VALID_YEARS), years(TEST_YEARS)


def _ols(train):
    return M.linear_pipeline(["l_quantity"], [], LABEL, solver="normal").fit(train)


def scored(spark, sf_dir, split: str = "test", keep=()):
    """Scored table: baseline (training mean) and one-variable OLS, fitted on train; ``keep`` are further columns.

    The records are joined once: fit, mean and every pass over the scores read the kept ones.
    """
    train, valid, test = _splits(spark, sf_dir, [LABEL, "l_quantity", *keep])
    target = test if split == "test" else valid
    return M.score({"ols": _ols(train)}, target, LABEL, baseline_value=M.baseline(train, LABEL))


PRED = {"baseline": "pred_baseline", "ols": "pred_ols"}

SCORED_SQL = RECORDS_SQL + """
, tr AS (SELECT avg(l_extendedprice) AS mu, regr_intercept(l_extendedprice, l_quantity) AS a,
                regr_slope(l_extendedprice, l_quantity) AS b FROM r WHERE year BETWEEN 1995 AND 1999)
, pall AS (SELECT r.*, tr.mu AS pred_baseline, tr.a + tr.b * r.l_quantity AS pred_ols,
                  r.l_extendedprice - tr.mu AS residual_baseline,
                  r.l_extendedprice - (tr.a + tr.b * r.l_quantity) AS residual_ols FROM r, tr)
, p AS (SELECT * FROM pall WHERE year = 2001)
, pv AS (SELECT * FROM pall WHERE year = 2000)
"""


@query("score", SCORED_SQL + f"""
  SELECT l_orderkey, l_linenumber, {rsql('l_extendedprice', 2)} AS l_extendedprice,
         {rsql('pred_baseline', 2)} AS pred_baseline, {rsql('pred_ols', 2)} AS pred_ols,
         {rsql('residual_baseline', 2)} AS residual_baseline, {rsql('residual_ols', 2)} AS residual_ols FROM p""")
def q_score(spark, sf_dir):
    """Baseline and OLS predictions with residuals on the same 2001 rows."""
    p = scored(spark, sf_dir, keep=LINE).select("l_orderkey", "l_linenumber", LABEL, "pred_baseline", "pred_ols",
                                     "residual_baseline", "residual_ols")
    return round_doubles(p, 2)


@query("score_audit", SCORED_SQL + """
  SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
         CAST(sum(CASE WHEN pred_baseline IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_pred_baseline,
         CAST(sum(CASE WHEN pred_ols IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_pred_ols,
         CAST(sum(CASE WHEN coalesce(o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM','5-LOW'), false) THEN 0 ELSE 1 END) AS BIGINT)
           AS unseen_o_orderpriority FROM p""")
def q_score_audit(spark, sf_dir):
    """Rows, NULL predictions, distinct keys and rows with codes outside the dictionary."""
    return M.score_audit(scored(spark, sf_dir, keep=[*LINE, "o_orderpriority"]), ["l_orderkey", "l_linenumber"], ["pred_baseline", "pred_ols"],
                         {"o_orderpriority": PRIORITIES_OK})


def _metrics_sql(src: str, name: str, col: str) -> str:
    e = f"(l_extendedprice - {col})"
    return (f"SELECT '{name}' AS model, count(*) AS n, {rsql(f'avg(abs({e}))', 4)} AS mae, "
            f"{rsql(f'sqrt(sum({e} * {e}) / count(*))', 4)} AS rmse, "
            f"{rsql(f'1 - sum({e} * {e}) / (var_pop(l_extendedprice) * count(*))', 8)} AS r2, "
            f"CAST(0 AS BIGINT) AS skipped FROM {src}")


def _round_metrics(df):
    return df.select(*[c for c in df.columns if c not in ("mae", "rmse", "r2")],
                     (F.round(F.col("mae") * 1e4, 0) / 1e4).alias("mae"),
                     (F.round(F.col("rmse") * 1e4, 0) / 1e4).alias("rmse"),
                     (F.round(F.col("r2") * 1e8, 0) / 1e8).alias("r2"))


@query("metrics", SCORED_SQL + _metrics_sql("p", "x", "pred_ols").replace("'x' AS model, ", ""))
def q_metrics(spark, sf_dir):
    """N, MAE, RMSE, R^2 of the OLS model on 2001."""
    return _round_metrics(E.metrics(scored(spark, sf_dir), LABEL, "pred_ols"))


@query("metrics_table", SCORED_SQL + _metrics_sql("p", "baseline", "pred_baseline") + " UNION ALL "
       + _metrics_sql("p", "ols", "pred_ols"))
def q_metrics_table(spark, sf_dir):
    """Metrics table, one row per model."""
    return _round_metrics(E.metrics_table(scored(spark, sf_dir), LABEL, PRED))


@query("improvement", SCORED_SQL + """
  , m AS (""" + _metrics_sql("p", "baseline", "pred_baseline") + " UNION ALL " + _metrics_sql("p", "ols", "pred_ols") + """)
  , mr AS (SELECT model, n, skipped, mae, rmse, r2 FROM m)
  , raw AS (SELECT '1' AS k, avg(abs(l_extendedprice - pred_baseline)) AS bmae,
                   sqrt(avg(power(l_extendedprice - pred_baseline, 2))) AS brmse FROM p)
  , rm AS (SELECT 'baseline' AS model, avg(abs(residual_baseline)) AS mae0, sqrt(avg(power(residual_baseline, 2))) AS rmse0 FROM p
           UNION ALL SELECT 'ols', avg(abs(residual_ols)), sqrt(avg(power(residual_ols, 2))) FROM p)
  SELECT mr.model, mr.n, mr.skipped, mr.mae, mr.rmse, mr.r2,
         """ + rsql("100.0 * (raw.bmae - rm.mae0) / raw.bmae", 6) + """ AS mae_improvement_pct,
         """ + rsql("100.0 * (raw.brmse - rm.rmse0) / raw.brmse", 6) + """ AS rmse_improvement_pct
  FROM mr JOIN rm USING (model), raw""")
def q_improvement(spark, sf_dir):
    """% improvement of each model over the baseline."""
    t = E.improvement(E.metrics_table(scored(spark, sf_dir), LABEL, PRED), "baseline")
    t = t.withColumn("mae_improvement_pct", F.round(F.col("mae_improvement_pct") * 1e6, 0) / 1e6) \
         .withColumn("rmse_improvement_pct", F.round(F.col("rmse_improvement_pct") * 1e6, 0) / 1e6)
    return _round_metrics(t)


def _cmp_sql() -> str:
    def raw(src, name, col):
        e = f"(l_extendedprice - {col})"
        return (f"SELECT '{name}' AS model, avg(abs({e})) AS mae, sqrt(sum({e}*{e})/count(*)) AS rmse, "
                f"1 - sum({e}*{e}) / (var_pop(l_extendedprice) * count(*)) AS r2 FROM {src}")
    v = raw("pv", "baseline", "pred_baseline") + " UNION ALL " + raw("pv", "ols", "pred_ols")
    t = raw("p", "baseline", "pred_baseline") + " UNION ALL " + raw("p", "ols", "pred_ols")
    cols = []
    for m, d in (("mae", 4), ("rmse", 4), ("r2", 8)):
        cols += [f"{rsql(f'v.{m}', d)} AS {m}_valid", f"{rsql(f't.{m}', d)} AS {m}_test",
                 f"{rsql(f'100.0 * (t.{m} - v.{m}) / abs(v.{m})', 4)} AS {m}_change_pct"]
    return SCORED_SQL + f", v AS ({v}), t AS ({t}) SELECT model, {', '.join(cols)} FROM v LEFT JOIN t USING (model)"


@query("compare_splits", _cmp_sql())
def q_compare_splits(spark, sf_dir):
    """Validation (2000) vs test (2001) metrics per model with % change."""
    v = E.metrics_table(scored(spark, sf_dir, "valid"), LABEL, PRED)
    t = E.metrics_table(scored(spark, sf_dir, "test"), LABEL, PRED)
    out = E.compare_splits(v, t)
    digits = {"mae_valid": 4, "mae_test": 4, "rmse_valid": 4, "rmse_test": 4, "r2_valid": 8, "r2_test": 8}
    return out.select("model", *[(F.round(F.col(c) * 10.0 ** digits.get(c, 4), 0) / 10.0 ** digits.get(c, 4)).alias(c)
                                 for c in out.columns if c != "model"])


_LABEL_CASE = "CASE code " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_LABELS.items()) + " ELSE code END"


@query("error_by_group", SCORED_SQL + f"""
  , g AS (SELECT o_orderpriority AS code, count(*) AS n, avg(l_extendedprice) AS actual_mean,
                 avg(pred_baseline) AS pred_mean_baseline, avg(abs(residual_baseline)) AS mae_baseline,
                 avg(residual_baseline) AS error_mean_baseline, avg(pred_ols) AS pred_mean_ols,
                 avg(abs(residual_ols)) AS mae_ols, avg(residual_ols) AS error_mean_ols FROM p GROUP BY 1)
  SELECT 'o_orderpriority' AS variable, code, {_LABEL_CASE} AS category, n,
         {rsql('actual_mean', 2)} AS actual_mean, {rsql('pred_mean_baseline', 2)} AS pred_mean_baseline,
         {rsql('mae_baseline', 2)} AS mae_baseline, {rsql('error_mean_baseline', 2)} AS error_mean_baseline,
         {rsql('pred_mean_ols', 2)} AS pred_mean_ols, {rsql('mae_ols', 2)} AS mae_ols,
         {rsql('error_mean_ols', 2)} AS error_mean_ols FROM g""")
def q_error_by_group(spark, sf_dir):
    """Error by order priority, labelled, in code order."""
    return round_doubles(E.error_by_group(scored(spark, sf_dir, keep=["o_orderpriority"]), "o_orderpriority", LABEL, PRED, PRIORITY_LABELS), 2)


_GROUP_SQL = SCORED_SQL + """
  , g AS (SELECT l_returnflag AS code, count(*) AS n, avg(l_extendedprice) AS actual_mean,
                 avg(abs(residual_baseline)) AS mae_baseline, avg(abs(residual_ols)) AS mae_ols FROM p GROUP BY 1)
  , w AS (SELECT *, CASE WHEN mae_baseline < mae_ols THEN 'baseline' WHEN mae_ols < mae_baseline THEN 'ols'
                         ELSE 'tie' END AS better FROM g WHERE n >= 100)
"""


@query("relative_error", _GROUP_SQL + f"""
  SELECT code, n, {rsql('mae_baseline / actual_mean', 8)} AS rel_mae_baseline,
         {rsql('mae_ols / actual_mean', 8)} AS rel_mae_ols, better FROM w""")
def q_relative_error(spark, sf_dir):
    """Relative MAE per return flag (groups with n >= 100) and the better model."""
    t = E.error_by_group(scored(spark, sf_dir, keep=["l_returnflag"]), "l_returnflag", LABEL, PRED)
    r = E.relative_error_by_group(t, "baseline", "ols", 100)
    return round_doubles(r.select("code", "n", "rel_mae_baseline", "rel_mae_ols", "better"), 8)


@query("group_wins", _GROUP_SQL + "SELECT better, count(*) AS groups FROM w GROUP BY better")
def q_group_wins(spark, sf_dir):
    """Number of groups each model wins."""
    t = E.error_by_group(scored(spark, sf_dir, keep=["l_returnflag"]), "l_returnflag", LABEL, PRED)
    return E.wins(E.relative_error_by_group(t, "baseline", "ols", 100))


_CUTS_SQL = f", c AS (SELECT quantile_disc(l_extendedprice, {BAND_PS}) AS cuts FROM p)\n"


@query("band_cuts", SCORED_SQL + _CUTS_SQL + f"""
  SELECT CAST(i AS INTEGER) AS i, {rsql('cuts[i]', 2)} AS cut FROM c, range(1, {len(BAND_PS) + 1}) t(i)""")
def q_band_cuts(spark, sf_dir):
    """Band cut points = element quantiles of the 2001 actual value."""
    cuts = E.band_cuts(scored(spark, sf_dir), LABEL, BAND_PS)
    return cuts.select(F.posexplode("cuts").alias("i", "cut")).select(
        (F.col("i") + 1).cast("int").alias("i"), (F.round(F.col("cut") * 100.0, 0) / 100.0).alias("cut"))


def _band_sql() -> str:
    k = len(BAND_PS)
    ladder = " ".join(f"WHEN l_extendedprice <= cuts[{i + 1}] THEN {i}" for i in range(k))
    fmt = "format('{:,.0f}', %s)"
    rng = (f"CASE WHEN band = 0 THEN '<= Q' || {fmt % 'cuts[1]'} WHEN band = {k} THEN '> Q' || {fmt % f'cuts[{k}]'} "
           f"ELSE 'Q' || {fmt % 'cuts[band]'} || ' - Q' || {fmt % 'cuts[band + 1]'} END")
    return SCORED_SQL + _CUTS_SQL + f"""
  , b AS (SELECT p.*, c.cuts, CASE WHEN l_extendedprice IS NULL THEN NULL {ladder} ELSE {k} END AS band FROM p, c)
  , g AS (SELECT band, any_value(cuts) AS cuts, count(*) AS n, avg(l_extendedprice) AS actual_mean,
                 avg(pred_baseline) AS pm_b, avg(abs(residual_baseline)) AS mae_b, avg(residual_baseline) AS me_b,
                 avg(pred_ols) AS pm_o, avg(abs(residual_ols)) AS mae_o, avg(residual_ols) AS me_o FROM b GROUP BY band)
  , s AS (SELECT 'baseline' AS model, CAST(band AS INTEGER) AS band, {rng} AS range, n, actual_mean,
                 pm_b AS pred_mean, mae_b AS mae, me_b AS error_mean FROM g
          UNION ALL SELECT 'ols', CAST(band AS INTEGER), {rng}, n, actual_mean, pm_o, mae_o, me_o FROM g)
"""


@query("error_by_band", _band_sql() + f"""
  SELECT band, range, n, {rsql('actual_mean', 2)} AS actual_mean, {rsql('pred_mean', 2)} AS pred_mean,
         {rsql('mae', 2)} AS mae, {rsql('error_mean', 2)} AS error_mean FROM s WHERE model = 'ols'""")
def q_error_by_band(spark, sf_dir):
    """OLS error by band (a, b] of the actual value, labelled ranges."""
    p = scored(spark, sf_dir)
    cuts = E.collect_cuts(E.band_cuts(p, LABEL, BAND_PS))
    return round_doubles(E.error_by_band(p, LABEL, "pred_ols", cuts), 2)


@query("error_by_band_models", _band_sql() + f"""
  SELECT model, band, range, n, {rsql('actual_mean', 2)} AS actual_mean, {rsql('pred_mean', 2)} AS pred_mean,
         {rsql('mae', 2)} AS mae, {rsql('error_mean', 2)} AS error_mean FROM s""")
def q_error_by_band_models(spark, sf_dir):
    """Error by band for every model, stacked."""
    p = scored(spark, sf_dir)
    cuts = E.collect_cuts(E.band_cuts(p, LABEL, BAND_PS))
    return round_doubles(E.error_by_band_models(p, LABEL, PRED, cuts), 2)


@query("band_gain", _band_sql() + f"""
  , wd AS (SELECT band, range, max(CASE WHEN model = 'baseline' THEN mae END) AS mb,
                  max(CASE WHEN model = 'ols' THEN mae END) AS mo FROM s GROUP BY band, range)
  SELECT band, range, {rsql('mb', 2)} AS mae_baseline, {rsql('mo', 2)} AS mae_ols, {rsql('mb - mo', 2)} AS gain,
         CASE WHEN mb - mo > 0 THEN 'ols' WHEN mb - mo < 0 THEN 'baseline' ELSE 'tie' END AS winner FROM wd""")
def q_band_gain(spark, sf_dir):
    """MAE gain per band of OLS over the baseline, and the winner."""
    p = scored(spark, sf_dir)
    cuts = E.collect_cuts(E.band_cuts(p, LABEL, BAND_PS))
    return round_doubles(E.band_gain(E.error_by_band_models(p, LABEL, PRED, cuts), "baseline", "ols"), 2)


@query("error_by_decile", SCORED_SQL + f"""
  , c AS (SELECT list_distinct(list_sort(quantile_disc(pred_ols, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]))) AS cuts FROM p)
  , b AS (SELECT p.*, CASE WHEN pred_ols IS NOT NULL AND NOT isnan(pred_ols)
                      THEN CAST(len(list_filter(c.cuts, lambda x: x <= pred_ols)) AS DOUBLE) END AS decile FROM p, c)
  SELECT decile, count(*) AS n, {rsql('avg(pred_ols)', 2)} AS pred_mean, {rsql('avg(l_extendedprice)', 2)} AS actual_mean,
         {rsql('avg(abs(residual_ols))', 2)} AS mae, {rsql('avg(residual_ols)', 2)} AS error_mean FROM b GROUP BY decile""")
def q_error_by_decile(spark, sf_dir):
    """Calibration of OLS by prediction decile, [a, b) buckets, tied cuts merged."""
    return round_doubles(E.error_by_prediction_decile(scored(spark, sf_dir), LABEL, "pred_ols", 10), 2)


def _range_sql() -> str:
    parts = []
    for name, col in (("actual", "l_extendedprice"), ("baseline", "pred_baseline"), ("ols", "pred_ols")):
        parts.append(f"SELECT '{name}' AS series, {rsql(f'min({col})', 2)} AS min, {rsql(f'quantile_disc({col}, 0.01)', 2)} AS p1, "
                     f"{rsql(f'quantile_disc({col}, 0.99)', 2)} AS p99, {rsql(f'max({col})', 2)} AS max, "
                     f"CAST(sum(CASE WHEN {col} < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negatives FROM p")
    return SCORED_SQL + " UNION ALL ".join(parts)


@query("prediction_range", _range_sql())
def q_prediction_range(spark, sf_dir):
    """Min, P1, P99, max and negatives of the actual value and each model's predictions."""
    p = scored(spark, sf_dir)
    return round_doubles(E.prediction_range(p, {"actual": LABEL, "baseline": "pred_baseline", "ols": "pred_ols"}), 2)


def _summary_sql() -> str:
    parts = []
    for name in ("baseline", "ols"):
        e = f"residual_{name}"
        parts.append(
            f"SELECT '{name}' AS model, {rsql(f'quantile_disc(abs({e}), 0.5)', 2)} AS median_abs_error, "
            f"{rsql(f'100.0 * avg(CASE WHEN abs({e}) <= 0.2 * l_extendedprice THEN 1.0 ELSE 0.0 END)', 6)} AS pct_within_tolerance, "
            f"{rsql(f'100.0 * avg(CASE WHEN {e} > 0 THEN 1.0 ELSE 0.0 END)', 6)} AS pct_under, "
            f"{rsql(f'100.0 * avg(CASE WHEN l_extendedprice > hi THEN (CASE WHEN {e} > 0 THEN 1.0 ELSE 0.0 END) END)', 6)} AS pct_under_high, "
            f"{rsql(f'100.0 * coalesce(sum(CASE WHEN l_extendedprice > tl THEN {e} * {e} END), 0.0) / sum({e} * {e})', 6)} AS pct_sq_error_tail "
            f"FROM p, th")
    return SCORED_SQL + """
  , th AS (SELECT quantile_disc(l_extendedprice, 0.9) AS hi, quantile_disc(l_extendedprice, 0.95) AS tl FROM p)
  """ + " UNION ALL ".join(parts)


@query("error_summary", _summary_sql())
def q_error_summary(spark, sf_dir):
    """Median |error|, % within 20 %, % under-estimated (all / above P90), tail share of squared error (> P95)."""
    p = scored(spark, sf_dir)
    hi, tail = E.collect_cuts(E.band_cuts(p, LABEL, [0.9, 0.95]))
    out = E.error_summary(p, LABEL, PRED, high=hi, tail=tail, tolerance=0.2)
    out = round_doubles(out, 6, skip=("median_abs_error",))
    return out.withColumn("median_abs_error", F.round(F.col("median_abs_error") * 100.0, 0) / 100.0)


@query("baseline_median", RECORDS_SQL + f"""
  SELECT {rsql('quantile_disc(l_extendedprice, 0.5)', 2)} AS median, {rsql('avg(l_extendedprice)', 4)} AS mean
  FROM r WHERE year BETWEEN 1995 AND 1999""")
def q_baseline_median(spark, sf_dir):
    """M5: reference model values (training median and mean)."""
    train, _, _ = _splits(spark, sf_dir)
    med = M.baseline(train, LABEL, "median")
    mean = M.baseline(train, LABEL, "mean")
    return train.sparkSession.range(1).select((F.round(med * 100.0, 0) / 100.0).alias("median"),
                                              (F.round(mean * 1e4, 0) / 1e4).alias("mean"))


@query("coefficients", RECORDS_SQL + f"""
  , t AS (SELECT regr_intercept(l_extendedprice, l_quantity) AS a, regr_slope(l_extendedprice, l_quantity) AS b
          FROM r WHERE year BETWEEN 1995 AND 1999)
  SELECT '(intercept)' AS variable, {rsql('a', 4)} AS coefficient FROM t
  UNION ALL SELECT 'l_quantity', {rsql('b', 6)} FROM t""")
def q_coefficients(spark, sf_dir):
    """Coefficient table of the one-variable OLS (intercept first)."""
    train, _, _ = _splits(spark, sf_dir)
    c = M.coefficients(_ols(train), ["l_quantity"])
    return c.select("variable", F.when(F.col("variable") == "(intercept)", F.round(F.col("coefficient") * 1e4, 0) / 1e4)
                    .otherwise(F.round(F.col("coefficient") * 1e6, 0) / 1e6).alias("coefficient"))


@query("tree_depth1_score", RECORDS_SQL + f"""
  , m AS (SELECT l_linestatus, avg(l_extendedprice) AS mu FROM r WHERE year BETWEEN 1995 AND 1999 GROUP BY 1)
  SELECT l_orderkey, l_linenumber, {rsql('m.mu', 2)} AS prediction FROM r JOIN m USING (l_linestatus) WHERE year = 2001""")
def q_tree_depth1_score(spark, sf_dir):
    """M7 (exact form): one unbootstrapped depth-1 tree on a two-level code predicts the group means."""
    train, _, test = _splits(spark, sf_dir)
    model = M.forest_pipeline([], ["l_linestatus"], LABEL, num_trees=1, max_depth=1, subset="all",
                              bootstrap=False).fit(train)
    return round_doubles(model.transform(test).select("l_orderkey", "l_linenumber", "prediction"), 2)


@query("level_index", RECORDS_SQL + """
  , c AS (SELECT 'o_orderpriority' AS variable, o_orderpriority AS level, count(*) AS n FROM r WHERE year BETWEEN 1995 AND 1999 GROUP BY 2
          UNION ALL SELECT 'l_returnflag', l_returnflag, count(*) FROM r WHERE year BETWEEN 1995 AND 1999 GROUP BY 2)
  SELECT variable, CAST(row_number() OVER (PARTITION BY variable ORDER BY n DESC, level) - 1 AS INTEGER) AS idx, level FROM c""")
def q_level_index(spark, sf_dir):
    """M1: index of each categorical level (frequency desc, then alphabetical), unseen -> extra index."""
    train, _, _ = _splits(spark, sf_dir)
    from pyspark.ml import Pipeline
    model = Pipeline(stages=FE.preprocessing_stages(NUMERICS, CATEGORICALS)).fit(train)
    return FE.level_index(model)


@query("standardise", RECORDS_SQL + """
  , s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_discount) AS md, stddev_samp(l_discount) AS sd,
                 avg(l_tax) AS mt, stddev_samp(l_tax) AS st FROM r)
  SELECT l_orderkey, l_linenumber, """ + rsql("(l_quantity - mq) / sq", 6) + " AS l_quantity_z, "
       + rsql("(l_discount - md) / sd", 6) + " AS l_discount_z, " + rsql("(l_tax - mt) / st", 6) + " AS l_tax_z FROM r, s")
def q_standardise(spark, sf_dir):
    """M3: z-scores (mean 0, sample sd 1) through StandardScaler."""
    z = FE.standardise(records(spark, sf_dir), NUMERICS, keep=["l_orderkey", "l_linenumber"])
    return round_doubles(z, 6)


# --------------------------------------------------------------------------- randomised / iterative (rows-only)

LINEAR_GRID = {"ols": {"reg_param": 0.0, "elastic_net": 0.0}, "ridge_0.1": {"reg_param": 0.1, "elastic_net": 0.0},
               "ridge_1": {"reg_param": 1.0, "elastic_net": 0.0}, "lasso_0.1": {"reg_param": 0.1, "elastic_net": 1.0},
               "elastic_0.1": {"reg_param": 0.1, "elastic_net": 0.5}}
FOREST_GRID = {"trees_10_depth_3": {"num_trees": 10, "max_depth": 3}, "trees_10_depth_6": {"num_trees": 10, "max_depth": 6},
               "trees_20_depth_6": {"num_trees": 20, "max_depth": 6}}


def _grid(spark, sf_dir, kind: str, splits=None):
    """(table, fits by name): linear models from one set of cross products, forests by the fit loop."""
    train, valid, _ = splits or _splits(spark, sf_dir, [LABEL, *NUMERICS, *CATEGORICALS])
    if kind == "linear":
        return GR.linear_grid(train, valid, NUMERICS, CATEGORICALS, LABEL, LINEAR_GRID)
    return M.grid_search(train, valid, NUMERICS, CATEGORICALS, LABEL, FOREST_GRID, M.forest_regressor)


@query("linear_grid")
def q_linear_grid(spark, sf_dir):
    """Linear grid (5 penalties) fitted on train, metrics on train and validation."""
    return E.generalisation_gap(_grid(spark, sf_dir, "linear")[0])


@query("forest_grid")
def q_forest_grid(spark, sf_dir):
    """Random-forest grid (3 configurations)."""
    return E.generalisation_gap(_grid(spark, sf_dir, "forest")[0])


@query("choose_best")
def q_choose_best(spark, sf_dir):
    """Configuration with the least validation RMSE of the forest grid, and the RMSE range."""
    table = _grid(spark, sf_dir, "forest")[0]
    spread_ = E.metric_range(table).select(F.struct("min", "max", "range").alias("s")).select("s").scalar()
    return M.choose_best(table).select("config", "rmse_valid", spread_["min"].alias("min"), spread_["max"].alias("max"),
                                       spread_["range"].alias("range"))


@query("importances")
def q_importances(spark, sf_dir):
    """Forest feature importances by feature name (sum 1)."""
    table, models = _grid(spark, sf_dir, "forest")
    return M.importances(models["trees_20_depth_6"], NUMERICS)


@query("importance_by_predictor")
def q_importance_by_predictor(spark, sf_dir):
    """Importances summed per source predictor, and numeric vs categorical share."""
    table, models = _grid(spark, sf_dir, "forest")
    imp = M.importances(models["trees_20_depth_6"], NUMERICS)
    return M.importance_by_predictor(imp)


@query("coefficient_ranges")
def q_coefficient_ranges(spark, sf_dir):
    """Coefficients of the full-design linear model and their range per categorical."""
    table, models = _grid(spark, sf_dir, "linear")
    return M.coefficient_ranges(GR.coefficient_table(models["ridge_1"], table))


def _stored_choice(spark, table) -> dict:
    """Parameters of the best configuration, as read back from the stored grid."""
    path = shared_folder(spark)
    IO.write_results(table, path, ("selected", "config", M.choose_best(table).first()["config"]))
    return IO.chosen_parameters(spark, path, GR.GRID_SCHEMA + ", selected boolean")


@query("final_scoring")
def q_final_scoring(spark, sf_dir):
    """The chosen configuration of each grid, refitted on 1995-2000 behind the leakage guard, scores 2001."""
    splits = train, valid, test = _splits(spark, sf_dir, ["period", LABEL, *NUMERICS, *CATEGORICALS])
    dev = train.unionByName(valid)
    linear, forest = (_stored_choice(spark, _grid(spark, sf_dir, kind, splits)[0]) for kind in ("linear", "forest"))
    models = M.fit_final(dev, "period", DEV_PERIODS, {
        "linear": M.linear_pipeline(NUMERICS, CATEGORICALS, LABEL, linear["reg_param"], linear["elastic_net"]),
        "forest": M.forest_pipeline(NUMERICS, CATEGORICALS, LABEL, int(forest["num_trees"]), int(forest["max_depth"]))})
    pred = M.score(models, test, LABEL, baseline_value=M.baseline(dev, LABEL))
    return E.metrics_table(pred, LABEL, {"baseline": "pred_baseline", "linear": "pred_linear", "forest": "pred_forest"})


@query("band_cuts_distributed", SCORED_SQL + _CUTS_SQL + f"""
  SELECT CAST(i AS INTEGER) AS i, {rsql('cuts[i]', 2)} AS cut FROM c, range(1, {len(BAND_PS) + 1}) t(i)""")
def q_band_cuts_distributed(spark, sf_dir):
    """E8 with distributed exact element quantiles."""
    cuts = E.band_cuts(scored(spark, sf_dir), LABEL, BAND_PS, method="distributed")
    return cuts.select(F.posexplode("cuts").alias("i", "cut")).select(
        (F.col("i") + 1).cast("int").alias("i"), (F.round(F.col("cut") * 100.0, 0) / 100.0).alias("cut"))


@query("error_summary_distributed", _summary_sql())
def q_error_summary_distributed(spark, sf_dir):
    """E13 with the median absolute error and thresholds from distributed exact quantiles."""
    p = scored(spark, sf_dir)
    hi, tail = E.collect_cuts(E.band_cuts(p, LABEL, [0.9, 0.95], method="distributed"))
    out = E.error_summary(p, LABEL, PRED, high=hi, tail=tail, tolerance=0.2, method="distributed")
    out = round_doubles(out, 6, skip=("median_abs_error",))
    return out.withColumn("median_abs_error", F.round(F.col("median_abs_error") * 100.0, 0) / 100.0)


@query("subset_summary", SCORED_SQL + " UNION ALL ".join(
    f"""SELECT '{m}' AS model, count(*) AS n, {rsql(f'avg(pred_{m})', 2)} AS pred_mean,
        {rsql(f'quantile_disc(pred_{m}, 0.1)', 2)} AS p10, {rsql(f'quantile_disc(pred_{m}, 0.9)', 2)} AS p90
        FROM p WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""" for m in ("baseline", "ols")))
def q_subset_summary(spark, sf_dir):
    """urgent / high-priority subset: n, mean prediction, P10 and P90 per model."""
    return round_doubles(E.subset_summary(scored(spark, sf_dir, keep=["o_orderpriority"]), "o_orderpriority", ["1-URGENT", "2-HIGH"], PRED), 2)


@query("common_sample", SCORED_SQL + f"""
  SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderpriority, l_returnflag, {rsql('pred_baseline', 4)} AS pred_baseline,
         {rsql('pred_ols', 4)} AS pred_ols, {rsql('residual_baseline', 4)} AS residual_baseline, {rsql('residual_ols', 4)} AS residual_ols
  FROM p ORDER BY md5(concat_ws('|', '42', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR))),
                  l_orderkey, l_linenumber, l_partkey LIMIT 5000""")
def q_common_sample(spark, sf_dir):
    """One common sample of 5,000 scored rows with every model's prediction and residual."""
    from tabulae.operators.explore import hash_sample
    p = scored(spark, sf_dir, keep=[*LINE, "l_partkey", *CATEGORICALS]).select("l_orderkey", "l_linenumber", "l_partkey", LABEL, *CATEGORICALS, "pred_baseline", "pred_ols",
                                     "residual_baseline", "residual_ols")
    return round_doubles(hash_sample(p, 5000, ["l_orderkey", "l_linenumber", "l_partkey"], 42).drop("l_partkey"), 4, skip=(LABEL,))


@query("importance_shares")
def q_importance_shares(spark, sf_dir):
    """Share of forest importance held by numeric vs categorical predictors."""
    table, models = _grid(spark, sf_dir, "forest")
    return M.importance_shares(M.importances(models["trees_20_depth_6"], NUMERICS), NUMERICS)
