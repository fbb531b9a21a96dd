"""Exploration operators bound to the driver's tables.

``records`` (lineitem x orders) plays the survey table: target
``l_extendedprice``, numerics ``l_quantity, l_discount, l_tax``, categoricals
``o_orderpriority`` / ``l_returnflag``, quarterly period.  ``events.value`` is
the skewed measure for skewness and the log histogram.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from tabulae.operators import explore as X
from tabulae.plans.registry import query, round_doubles, rsql, sround
from tabulae.plans.tables import kept_records, load, records

TARGET = "l_extendedprice"
NUMERICS = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]

RECORDS_SQL = """WITH r AS (
  SELECT l.*, o.o_orderdate, o.o_orderpriority, o.o_orderstatus,
         CAST(year(o.o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o.o_orderdate) AS VARCHAR) AS period,
         CAST(year(o.o_orderdate) AS INTEGER) AS year
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
"""


def _describe_sql() -> str:
    parts = []
    for i, c in enumerate(NUMERICS):
        parts.append(f"""SELECT '{c}' AS variable, {i} AS position, count({c}) AS n, {rsql(f'avg({c})')} AS mean,
          {rsql(f'quantile_cont({c}, 0.5)')} AS median, {rsql(f'stddev_samp({c})')} AS sd,
          {rsql(f'CAST(min({c}) AS DOUBLE)')} AS min, {rsql(f'CAST(max({c}) AS DOUBLE)')} AS max,
          {rsql(f'quantile_cont({c}, 0.25)')} AS p25, {rsql(f'quantile_cont({c}, 0.75)')} AS p75,
          {rsql(f'quantile_cont({c}, 0.95)')} AS p95 FROM r""")
    return RECORDS_SQL + "SELECT variable, CAST(position AS INTEGER) AS position, n, mean, median, sd, min, max, p25, p75, p95 FROM (" + " UNION ALL ".join(parts) + ")"


@query("describe", _describe_sql(), headline=True)
def q_describe(spark, sf_dir):
    """A1: descriptives of the record measures (exact interpolated percentiles)."""
    return round_doubles(X.describe(records(spark, sf_dir), NUMERICS), 4)


@query("summary", RECORDS_SQL + "SELECT variable, CAST(position AS INTEGER) AS position, n, mean, sd, min, max FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {i} AS position, count({c}) AS n, {rsql(f'avg({c})')} AS mean, {rsql(f'stddev_samp({c})')} AS sd, "
    f"{rsql(f'CAST(min({c}) AS DOUBLE)')} AS min, {rsql(f'CAST(max({c}) AS DOUBLE)')} AS max FROM r"
    for i, c in enumerate(NUMERICS)) + ")")
def q_summary(spark, sf_dir):
    """Basic summary transposed (one row per variable)."""
    return round_doubles(X.summary(records(spark, sf_dir), NUMERICS), 4)


@query("skewness", f"""
  WITH s AS (SELECT avg(value) AS mu FROM events),
  k AS (SELECT count(value) AS n, {rsql('avg(value)')} AS mean, {rsql('quantile_cont(value, 0.5)')} AS median,
               avg(power(value - mu, 3)) / power(avg(power(value - mu, 2)), 1.5) AS g1 FROM events, s)
  SELECT n, mean, median, {rsql('g1', 6)} AS skewness,
         CASE WHEN g1 > 0.5 THEN 'right-skewed' WHEN g1 < -0.5 THEN 'left-skewed' ELSE 'roughly symmetric' END AS verdict
  FROM k""")
def q_skewness(spark, sf_dir):
    """Mean, median and population skewness of the skewed event value, with a verdict."""
    from tabulae.functions import skew_verdict
    out = X.skewness(load(spark, sf_dir, "events"), "value").withColumn("verdict", skew_verdict("skewness"))
    return round_doubles(out, 4, skip=("skewness",)).withColumn("skewness", F.round(F.col("skewness") * 1e6, 0) / 1e6)


@query("category_counts", RECORDS_SQL + f"""
  SELECT o_orderpriority AS category, count(*) AS rows, {sround('100.0 * count(*) / sum(count(*)) OVER ()', 2)} AS pct
  FROM r GROUP BY o_orderpriority""")
def q_category_counts(spark, sf_dir):
    """A3: records and % per order priority."""
    return X.category_counts(records(spark, sf_dir), "o_orderpriority")


@query("target_by_group", RECORDS_SQL + f"""
  SELECT l_returnflag AS category, count(*) AS rows, {rsql('avg(l_extendedprice)')} AS mean,
         {rsql('quantile_cont(l_extendedprice, 0.5)')} AS median FROM r GROUP BY l_returnflag""")
def q_target_by_group(spark, sf_dir):
    """A4: target n / mean / median per return flag."""
    return round_doubles(X.target_by_group(records(spark, sf_dir), "l_returnflag", TARGET), 4)


@query("by_period", RECORDS_SQL + f"""
  SELECT period, count(*) AS rows, {rsql('quantile_cont(l_extendedprice, 0.5)')} AS median,
         {rsql('avg(l_extendedprice)')} AS mean FROM r GROUP BY period""")
def q_by_period(spark, sf_dir):
    """A5: n, median and mean of the target per quarter."""
    return round_doubles(X.by_period(records(spark, sf_dir), "period", TARGET), 4)


def _hist_sql(expr: str, bins: int) -> str:
    return f"""
  WITH b AS (SELECT {expr} AS v FROM events),
  c AS (SELECT v FROM b WHERE v IS NOT NULL AND NOT isnan(v)),
  s AS (SELECT min(v) AS lo, max(v) AS hi, coalesce(nullif((max(v) - min(v)) / {bins}.0, 0.0), 1.0) AS w FROM c),
  k AS (SELECT CAST(least(floor((v - lo) / w), {bins - 1}) AS INTEGER) AS bin, count(*) AS rows FROM c, s GROUP BY 1),
  sp AS (SELECT CAST(range AS INTEGER) AS bin FROM range({bins}))
  SELECT sp.bin, {rsql('lo + sp.bin * w', 6)} AS lower, {rsql('lo + sp.bin * w + w', 6)} AS upper,
         coalesce(k.rows, 0) AS rows FROM sp CROSS JOIN s LEFT JOIN k ON sp.bin = k.bin"""


@query("histogram", _hist_sql("value", 20))
def q_histogram(spark, sf_dir):
    """20-bin equal-width histogram of the event value."""
    return round_doubles(X.histogram(load(spark, sf_dir, "events"), "value", 20), 6)


@query("histogram_log", _hist_sql("CASE WHEN value > 0 THEN log10(value) END", 20))
def q_histogram_log(spark, sf_dir):
    """20-bin histogram of log10(event value)."""
    return round_doubles(X.histogram(load(spark, sf_dir, "events"), "value", 20, log10=True), 6)


@query("extremes", RECORDS_SQL + f"""
  , g AS (SELECT o_orderpriority AS category, quantile_cont(l_extendedprice, 0.5) AS median FROM r GROUP BY 1)
  SELECT arg_max(category, median) AS highest_group, {rsql('max(median)')} AS highest,
         arg_min(category, median) AS lowest_group, {rsql('min(median)')} AS lowest,
         {rsql('max(median) / min(median)', 6)} AS ratio FROM g""")
def q_extremes(spark, sf_dir):
    """Highest vs lowest median price per priority and their ratio."""
    t = X.target_by_group(records(spark, sf_dir), "o_orderpriority", TARGET)
    out = X.extremes(t, "category", "median")
    return round_doubles(out, 4, skip=("ratio",)).withColumn("ratio", F.round(F.col("ratio") * 1e6, 0) / 1e6)


_CORR_COLS = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]


def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(_CORR_COLS):
        for j, b in enumerate(_CORR_COLS):
            r = "1.0 + 0 * count(*)" if i == j else f"corr({a}, {b})"
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {rsql(r, 6)} AS r FROM c")
    cond = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in _CORR_COLS)
    return RECORDS_SQL + f", c AS (SELECT * FROM r WHERE {cond}) " + " UNION ALL ".join(parts)


@query("correlation", _corr_sql())
def q_correlation(spark, sf_dir):
    """Pearson correlation matrix (long), listwise deletion."""
    return round_doubles(X.correlation(records(spark, sf_dir), _CORR_COLS), 6)


@query("correlation_ranking", (
    RECORDS_SQL + ", c AS (SELECT * FROM r), p AS (" + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM c"
        for i, a in enumerate(_CORR_COLS) for j, b in enumerate(_CORR_COLS) if a < b) + f""")
  SELECT a, b, {rsql('r', 6)} AS r,
         CASE WHEN abs(r) < 0.1 THEN 'negligible' WHEN abs(r) < 0.3 THEN 'weak'
              WHEN abs(r) < 0.5 THEN 'moderate' ELSE 'strong' END AS strength FROM p"""))
def q_correlation_ranking(spark, sf_dir):
    """Correlation pairs ranked by |r| with a strength class."""
    ranked = X.correlation_ranking(X.correlation(records(spark, sf_dir), _CORR_COLS))
    return ranked.withColumn("r", F.round(F.col("r") * 1e6, 0) / 1e6)


_PROFILE_PS = [0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]


@query("percentile_profile", RECORDS_SQL + f"""
  , m AS (SELECT year, avg(l_extendedprice) AS mu FROM r GROUP BY year)
  SELECT r.year, count(*) AS n, {rsql('avg(l_extendedprice)')} AS mean, {rsql('stddev_samp(l_extendedprice)')} AS sd,
         {rsql('max(l_extendedprice)')} AS max,
         {rsql('avg(power(l_extendedprice - mu, 3)) / power(avg(power(l_extendedprice - mu, 2)), 1.5)', 6)} AS skewness,
         """ + ", ".join(f"{rsql(f'quantile_disc(l_extendedprice, {p})')} AS p{round(100 * p)}" for p in _PROFILE_PS) + """
  FROM r JOIN m USING (year) GROUP BY r.year""")
def q_percentile_profile(spark, sf_dir):
    """Target percentile profile (element-valued) per year cohort."""
    out = X.percentile_profile(records(spark, sf_dir), TARGET, "year", _PROFILE_PS)
    return round_doubles(out, 4, skip=("skewness",)).withColumn("skewness", F.round(F.col("skewness") * 1e6, 0) / 1e6)


@query("quantile_curve", RECORDS_SQL + f"""
  , q AS (SELECT l_returnflag, quantile_disc(l_extendedprice, [{', '.join(repr(k / 100) for k in range(1, 100))}]) AS qs
          FROM r GROUP BY l_returnflag)
  SELECT l_returnflag, CAST(i AS INTEGER) AS q, {rsql('qs[i]')} AS value FROM q, range(1, 100) t(i)""")
def q_quantile_curve(spark, sf_dir):
    """99-point element quantile curve per return flag."""
    return round_doubles(X.quantile_curve(records(spark, sf_dir), TARGET, "l_returnflag", 99), 4)


@query("median_ratio", RECORDS_SQL + f"""
  , o AS (SELECT quantile_disc(l_extendedprice, 0.5) AS om FROM r)
  SELECT o_orderpriority, count(*) AS rows, {rsql('quantile_disc(l_extendedprice, 0.5)')} AS median,
         {rsql('any_value(om)')} AS overall_median, {rsql('quantile_disc(l_extendedprice, 0.5) / any_value(om)', 6)} AS ratio
  FROM r, o GROUP BY o_orderpriority""")
def q_median_ratio(spark, sf_dir):
    """Element median per priority relative to the overall element median."""
    out = X.median_ratio(records(spark, sf_dir), "o_orderpriority", TARGET)
    return round_doubles(out, 4, skip=("ratio",)).withColumn("ratio", F.round(F.col("ratio") * 1e6, 0) / 1e6)


@query("top_k", RECORDS_SQL + """
  SELECT l_orderkey, l_linenumber, l_extendedprice FROM r
  ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 12""")
def q_top_k(spark, sf_dir):
    """The 12 highest-priced lines (a top-k report; the limit is the feature)."""
    r = records(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_extendedprice")
    return X.top_k(r, [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")], 12)


@query("sample_rows")
def q_sample_rows(spark, sf_dir):
    """Seeded random sample of up to 5,000 records (sampling is the feature)."""
    return X.sample_rows(records(spark, sf_dir).select("l_orderkey", "l_linenumber", TARGET), 5000, 42)


@query("hash_sample", RECORDS_SQL + """
  SELECT l_orderkey, l_linenumber, l_extendedprice FROM r
  ORDER BY md5(concat_ws('|', '42', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR))),
           l_orderkey, l_linenumber, l_partkey LIMIT 5000""")
def q_hash_sample(spark, sf_dir):
    """Layout-independent sample of 5,000 records by seeded key hash (sampling is the feature)."""
    r = records(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", TARGET)
    return X.hash_sample(r, 5000, ["l_orderkey", "l_linenumber", "l_partkey"], 42).drop("l_partkey")


# --------------------------------------------------------------------------- distributed exact quantiles
# Same results as the built-in exact aggregates (same oracle SQL), computed with
# bounded per-task work: the at-scale path for continuous measures in hot groups.

@query("describe_distributed", _describe_sql())
def q_describe_distributed(spark, sf_dir):
    """A1 with distributed exact percentiles."""
    return round_doubles(X.describe(records(spark, sf_dir), NUMERICS, method="distributed"), 4)


@query("by_period_distributed", RECORDS_SQL + f"""
  SELECT period, count(*) AS rows, {rsql('quantile_cont(l_extendedprice, 0.5)')} AS median,
         {rsql('avg(l_extendedprice)')} AS mean FROM r GROUP BY period""")
def q_by_period_distributed(spark, sf_dir):
    """A5 with distributed exact medians per quarter."""
    return round_doubles(X.by_period(records(spark, sf_dir), "period", TARGET, method="distributed"), 4)


@query("percentile_profile_distributed", RECORDS_SQL + f"""
  , m AS (SELECT year, avg(l_extendedprice) AS mu FROM r GROUP BY year)
  SELECT r.year, count(*) AS n, {rsql('avg(l_extendedprice)')} AS mean, {rsql('stddev_samp(l_extendedprice)')} AS sd,
         {rsql('max(l_extendedprice)')} AS max,
         {rsql('avg(power(l_extendedprice - mu, 3)) / power(avg(power(l_extendedprice - mu, 2)), 1.5)', 6)} AS skewness,
         """ + ", ".join(f"{rsql(f'quantile_disc(l_extendedprice, {p})')} AS p{round(100 * p)}" for p in _PROFILE_PS) + """
  FROM r JOIN m USING (year) GROUP BY r.year""")
def q_percentile_profile_distributed(spark, sf_dir):
    """A18 with distributed exact element percentiles per year."""
    out = X.percentile_profile(records(spark, sf_dir), TARGET, "year", _PROFILE_PS, method="distributed")
    return round_doubles(out, 4, skip=("skewness",)).withColumn("skewness", F.round(F.col("skewness") * 1e6, 0) / 1e6)


@query("quantile_curve_distributed", RECORDS_SQL + f"""
  , q AS (SELECT l_returnflag, quantile_disc(l_extendedprice, [{', '.join(repr(k / 100) for k in range(1, 100))}]) AS qs
          FROM r GROUP BY l_returnflag)
  SELECT l_returnflag, CAST(i AS INTEGER) AS q, {rsql('qs[i]')} AS value FROM q, range(1, 100) t(i)""")
def q_quantile_curve_distributed(spark, sf_dir):
    """A19 with distributed exact element quantiles."""
    return round_doubles(X.quantile_curve(records(spark, sf_dir), TARGET, "l_returnflag", 99, method="distributed"), 4)


@query("period_variation", RECORDS_SQL + f"""
  , g AS (SELECT period, quantile_cont(l_extendedprice, 0.5) AS median FROM r GROUP BY period)
  , e AS (SELECT arg_max(period, median) AS highest_group, max(median) AS highest,
                 arg_min(period, median) AS lowest_group, min(median) AS lowest FROM g)
  , t AS (SELECT max(l_extendedprice) AS mx, quantile_cont(l_extendedprice, 0.5) AS md FROM r)
  SELECT highest_group, {rsql('highest')} AS highest, lowest_group, {rsql('lowest')} AS lowest,
         {rsql('highest / lowest', 6)} AS ratio, {rsql('mx / md', 6)} AS max_over_median FROM e, t""")
def q_period_variation(spark, sf_dir):
    """Quarters with the highest / lowest median, their ratio, and the target's max / median."""
    r = kept_records(spark, sf_dir, ["period", TARGET])
    per = X.by_period(r, "period", TARGET)
    out = X.extremes(per, "period", "median")
    d = X.describe(r, [TARGET], percentiles=()).select((F.col("max") / F.col("median")).alias("max_over_median"))
    out = out.withColumn("max_over_median", d.select("max_over_median").scalar())
    out = round_doubles(out, 4, skip=("ratio", "max_over_median"))
    return (out.withColumn("ratio", F.round(F.col("ratio") * 1e6, 0) / 1e6)
               .withColumn("max_over_median", F.round(F.col("max_over_median") * 1e6, 0) / 1e6))
