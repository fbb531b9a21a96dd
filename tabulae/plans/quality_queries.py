"""Quality-audit operators bound to the driver's tables (funnel, missingness,
codes, duplicates)."""
from __future__ import annotations

from pyspark.sql import functions as F

from tabulae.functions import compound_duration, is_finite
from tabulae.functions.rules import valid_duration
from tabulae.operators import quality as Q
from tabulae.plans.registry import query, rnd, rsql, sround
from tabulae.plans.tables import customers, labelled_documents, load
from tabulae.spec import TableSpec

# Fixed values of the bindings (chosen for the test tables, not from the reference).
SEGMENTS_OK = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PRIORITIES_OK = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
QUALITY_OK = ["0", "1"]
NATION_MAX = 20

RET = sround("100.0 * max_by(remaining, step_no) / min_by(remaining, step_no)", 2)
PCT = sround("100.0 * m / n", 2)
PCTA = sround("100.0 * a.m / a.n", 2)
PCTB = sround("100.0 * b.m / b.n", 2)


def customer_spec() -> TableSpec:
    bal = F.col("c_acctbal")
    return TableSpec(
        period="r_name", key=("c_custkey",), target="c_acctbal",
        steps=(
            ("balance finite", is_finite(bal)),
            ("balance > 0", bal > 0),
            ("segment recognised", F.col("c_mktsegment").isin(SEGMENTS_OK)),
            (f"nation key 0-{NATION_MAX}", F.col("c_nationkey").between(0, NATION_MAX)),
        ),
        codes={"c_mktsegment": SEGMENTS_OK},
    )


_FUNNEL_BASE = f"""
  WITH b AS (
    SELECT CAST(r_name AS VARCHAR) AS grp,
      coalesce(c_acctbal IS NOT NULL AND NOT isnan(c_acctbal) AND isfinite(c_acctbal), false) AS p1,
      coalesce(c_acctbal > 0, false) AS p2,
      coalesce(c_mktsegment IN ('BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'), false) AS p3,
      coalesce(c_nationkey BETWEEN 0 AND {NATION_MAX}, false) AS p4
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
  g AS (
    SELECT grp, count(*) AS s0,
      sum(CASE WHEN p1 THEN 1 ELSE 0 END) AS s1,
      sum(CASE WHEN p1 AND p2 THEN 1 ELSE 0 END) AS s2,
      sum(CASE WHEN p1 AND p2 AND p3 THEN 1 ELSE 0 END) AS s3,
      sum(CASE WHEN p1 AND p2 AND p3 AND p4 THEN 1 ELSE 0 END) AS s4
    FROM b GROUP BY grp),
  w AS (SELECT * FROM g UNION ALL
        SELECT 'TOTAL', sum(s0), sum(s1), sum(s2), sum(s3), sum(s4) FROM g),
  f AS (
    SELECT grp AS r_name, 0 AS step_no, 'original records' AS step, s0 AS remaining, 0 AS excluded FROM w
    UNION ALL SELECT grp, 1, 'balance finite', s1, s0 - s1 FROM w
    UNION ALL SELECT grp, 2, 'balance > 0', s2, s1 - s2 FROM w
    UNION ALL SELECT grp, 3, 'segment recognised', s3, s2 - s3 FROM w
    UNION ALL SELECT grp, 4, 'nation key 0-{NATION_MAX}', s4, s3 - s4 FROM w)
"""


@query("funnel", _FUNNEL_BASE + """
  SELECT r_name, CAST(step_no AS INTEGER) AS step_no, step, CAST(remaining AS BIGINT) AS remaining,
         CAST(excluded AS BIGINT) AS excluded FROM f""", headline=True)
def q_funnel(spark, sf_dir):
    """Ordered population funnel of customers per region plus TOTAL."""
    return Q.funnel(customers(spark, sf_dir), customer_spec(), "r_name")


@query("retention", _FUNNEL_BASE + f"""
  SELECT r_name, CAST(max_by(remaining, step_no) AS BIGINT) AS after,
         CAST(min_by(remaining, step_no) AS BIGINT) AS before,
         {RET} AS retained_pct
  FROM f GROUP BY r_name""")
def q_retention(spark, sf_dir):
    """Before / after / % retained per region."""
    return Q.retention(Q.funnel(customers(spark, sf_dir), customer_spec(), "r_name"), "r_name")


@query("largest_exclusion", _FUNNEL_BASE + f"""
  , s AS (SELECT * FROM f WHERE step_no > 0)
  , x AS (SELECT r_name, arg_max(step, excluded * 100 - step_no) AS worst_step,
                 CAST(max(excluded) AS BIGINT) AS worst_excluded, CAST(sum(excluded) AS BIGINT) AS total_excluded
          FROM s GROUP BY r_name)
  , t AS (SELECT r_name, CAST(max_by(remaining, step_no) AS BIGINT) AS after,
                 CAST(min_by(remaining, step_no) AS BIGINT) AS before,
                 {RET} AS retained_pct
          FROM f GROUP BY r_name)
  SELECT x.*, t.before, t.after, t.retained_pct FROM x JOIN t USING (r_name)""")
def q_largest_exclusion(spark, sf_dir):
    """A10: step with the largest exclusion and overall retention per region."""
    return Q.largest_exclusion(Q.funnel(customers(spark, sf_dir), customer_spec(), "r_name"), "r_name")


@query("prepare", f"""
  SELECT c_custkey, r_name, c_acctbal, c_nationkey,
         CASE WHEN c_mktsegment IN ('BUILDING','FURNITURE','HOUSEHOLD','MACHINERY') THEN c_mktsegment
              ELSE 'UNKNOWN' END AS c_mktsegment
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
                  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE isfinite(c_acctbal) AND NOT isnan(c_acctbal) AND c_acctbal > 0
    AND c_mktsegment IN ('BUILDING','FURNITURE','HOUSEHOLD','MACHINERY')
    AND c_nationkey BETWEEN 0 AND {NATION_MAX}""")
def q_prepare(spark, sf_dir):
    """Analytic population: steps in order, codes validated, fixed projection."""
    return Q.prepare(customers(spark, sf_dir), customer_spec(),
                     ["c_custkey", "r_name", "c_acctbal", "c_nationkey", "c_mktsegment"])


_DOC_COLS = ["text", "lang", "source", "n_chars", "quality", "toxic"]
_MISSING_SQL_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {i} AS position, sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS m, count(*) AS n FROM dl"
    for i, c in enumerate(_DOC_COLS))
_DL = "WITH dl AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


@query("missing", _DL + f"""
  , m AS ({_MISSING_SQL_ROWS})
  SELECT variable, CAST(position AS INTEGER) AS position, CAST(m AS BIGINT) AS missing,
         CASE WHEN n > 0 THEN {PCT} ELSE 0.0 END AS pct, CAST(n AS BIGINT) AS rows FROM m""")
def q_missing(spark, sf_dir):
    """Missing count and % per variable of documents with their (optional) labels."""
    return Q.missing(labelled_documents(spark, sf_dir), _DOC_COLS)


_MISSING_BY_ROWS = " UNION ALL ".join(
    f"SELECT lang, '{c}' AS variable, {i} AS position, sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS m, count(*) AS n FROM dl GROUP BY lang"
    for i, c in enumerate(_DOC_COLS))


@query("missing_by_group", _DL + f"""
  , m AS ({_MISSING_BY_ROWS})
  SELECT lang, variable, CAST(position AS INTEGER) AS position, CAST(m AS BIGINT) AS missing,
         CASE WHEN n > 0 THEN {PCT} ELSE 0.0 END AS pct, CAST(n AS BIGINT) AS rows FROM m""")
def q_missing_by_group(spark, sf_dir):
    """Missingness per variable x language (long form)."""
    return Q.missing(labelled_documents(spark, sf_dir), _DOC_COLS, by="lang")


@query("missing_pivot", _DL + f"""
  , m AS ({_MISSING_BY_ROWS})
  , p AS (SELECT lang, variable, position, CASE WHEN n > 0 THEN {PCT} ELSE 0.0 END AS pct FROM m)
  SELECT variable, max(CASE WHEN lang = 'de' THEN pct END) AS de, max(CASE WHEN lang = 'en' THEN pct END) AS en,
         max(CASE WHEN lang = 'es' THEN pct END) AS es, max(CASE WHEN lang = 'fr' THEN pct END) AS fr
  FROM p GROUP BY variable""")
def q_missing_pivot(spark, sf_dir):
    """Missing % per variable with one column per language."""
    return Q.missing_by_group_wide(labelled_documents(spark, sf_dir), _DOC_COLS, "lang", ["de", "en", "es", "fr"])


def _side(cond):
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {i} AS position, sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS m, count(*) AS n FROM dl WHERE {cond}"
        for i, c in enumerate(_DOC_COLS))
    return rows


@query("missing_side_by_side", _DL + f"""
  , a AS ({_side("lang = 'en'")}), b AS ({_side("lang <> 'en'")})
  SELECT a.variable, CAST(a.m AS BIGINT) AS missing_en, CASE WHEN a.n > 0 THEN {PCTA} ELSE 0.0 END AS pct_en,
         CAST(a.n AS BIGINT) AS rows_en, CAST(b.m AS BIGINT) AS missing_other,
         CASE WHEN b.n > 0 THEN {PCTB} ELSE 0.0 END AS pct_other, CAST(b.n AS BIGINT) AS rows_other
  FROM a JOIN b USING (variable)""")
def q_missing_side_by_side(spark, sf_dir):
    """Missingness of English vs other documents side by side."""
    dl = labelled_documents(spark, sf_dir)
    return Q.missing_side_by_side(dl.filter(F.col("lang") == "en"), dl.filter(F.col("lang") != "en"),
                                  _DOC_COLS, ("en", "other"))


@query("observed_codes", """
  SELECT coalesce(o_orderpriority, '<ABSENT>') AS code, count(*) AS rows,
         coalesce(o_orderpriority, '<ABSENT>') IN ('1-URGENT','2-HIGH','3-MEDIUM','5-LOW') AS recognised
  FROM orders GROUP BY 1""")
def q_observed_codes(spark, sf_dir):
    """Observed order-priority codes, recognised flag against a 4-code dictionary."""
    return Q.observed_codes(load(spark, sf_dir, "orders"), "o_orderpriority", PRIORITIES_OK)


@query("observed_codes_absent", """
  SELECT coalesce(CAST(l.quality AS VARCHAR), '<ABSENT>') AS code, count(*) AS rows,
         coalesce(CAST(l.quality AS VARCHAR), '<ABSENT>') IN ('0','1') AS recognised
  FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def q_observed_codes_absent(spark, sf_dir):
    """Label codes of documents, unlabelled ones shown as <ABSENT>."""
    return Q.observed_codes(labelled_documents(spark, sf_dir), "quality", QUALITY_OK)


@query("unrecognised_total", """
  SELECT CAST(sum(CASE WHEN coalesce(o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM','5-LOW'), false)
                  THEN 0 ELSE 1 END) AS BIGINT) AS unrecognised, count(*) AS rows FROM orders""")
def q_unrecognised_total(spark, sf_dir):
    """Total unrecognised codes."""
    return Q.unrecognised_total(load(spark, sf_dir, "orders"), "o_orderpriority", PRIORITIES_OK)


@query("validate_codes", """
  SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM','5-LOW') THEN o_orderpriority
                          ELSE 'UNKNOWN' END AS o_orderpriority,
         CASE WHEN o_orderstatus IN ('F','O') THEN o_orderstatus ELSE 'UNKNOWN' END AS o_orderstatus
  FROM orders""")
def q_validate_codes(spark, sf_dir):
    """Codes checked against their dictionaries, others -> UNKNOWN."""
    spec = TableSpec(codes={"o_orderpriority": PRIORITIES_OK, "o_orderstatus": ["F", "O"]})
    return Q.validate_codes(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus"), spec)


@query("unknown_counts", """
  WITH v AS (SELECT year(o_orderdate) AS year,
               CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH','3-MEDIUM','5-LOW') THEN o_orderpriority ELSE 'UNKNOWN' END AS o_orderpriority,
               CASE WHEN o_orderstatus IN ('F','O') THEN o_orderstatus ELSE 'UNKNOWN' END AS o_orderstatus FROM orders)
  SELECT year, 'o_orderpriority' AS variable, CAST(sum(CASE WHEN o_orderpriority = 'UNKNOWN' THEN 1 ELSE 0 END) AS BIGINT) AS unknown FROM v GROUP BY year
  UNION ALL
  SELECT year, 'o_orderstatus', CAST(sum(CASE WHEN o_orderstatus = 'UNKNOWN' THEN 1 ELSE 0 END) AS BIGINT) FROM v GROUP BY year""")
def q_unknown_counts(spark, sf_dir):
    """Count of the unknown token per categorical per year, one pass."""
    spec = TableSpec(codes={"o_orderpriority": PRIORITIES_OK, "o_orderstatus": ["F", "O"]})
    o = load(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return Q.unknown_counts(Q.validate_codes(o, spec), ["o_orderpriority", "o_orderstatus"], "year")


@query("frequency_audit", """
  SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, o_orderstatus, count(*) AS rows
  FROM orders GROUP BY ALL""")
def q_frequency_audit(spark, sf_dir):
    """Three-key frequency audit (year x quarter x status)."""
    o = load(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"),
                                             F.quarter("o_orderdate").alias("quarter"), "o_orderstatus")
    return Q.frequency_audit(o, ["year", "quarter", "o_orderstatus"])


@query("key_uniqueness", """
  WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
  SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys,
         CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicated_keys,
         CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS rows_in_duplicated FROM k""")
def q_key_uniqueness(spark, sf_dir):
    """Uniqueness of (l_orderkey, l_linenumber)."""
    return Q.key_uniqueness(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_LI_PAYLOAD = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
               "l_linestatus", "l_shipdate"]


@query("conflict_columns", "WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n, " + ", ".join(
    f"coalesce(min({c}) <> max({c}) OR (count({c}) > 0 AND count({c}) < count(*)), false) AS d{i}"
    for i, c in enumerate(_LI_PAYLOAD)) + " FROM lineitem GROUP BY ALL HAVING count(*) > 1) " + " UNION ALL ".join(
    f"SELECT '{c}' AS column, {i} AS position, CAST(sum(CASE WHEN d{i} THEN 1 ELSE 0 END) AS BIGINT) AS keys_with_difference FROM k"
    for i, c in enumerate(_LI_PAYLOAD)))
def q_conflict_columns(spark, sf_dir):
    """In how many duplicated line keys each payload column differs."""
    return Q.conflict_columns(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], _LI_PAYLOAD)


@query("worst_keys", """
  SELECT l_orderkey, l_linenumber, count(*) AS rows,
         count(DISTINCT (l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                         l_linestatus, l_shipdate)) AS versions,
         CASE WHEN count(DISTINCT (l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                         l_linestatus, l_shipdate)) = 1 THEN 'exact repeat' ELSE 'conflict' END AS kind
  FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
  ORDER BY rows DESC, versions DESC, l_orderkey, l_linenumber LIMIT 10""")
def q_worst_keys(spark, sf_dir):
    """Top-10 duplicated line keys."""
    key = ["l_orderkey", "l_linenumber"]
    return Q.worst_keys(Q.duplicate_detail(load(spark, sf_dir, "lineitem"), key, _LI_PAYLOAD), key, 10)


@query("duplicate_detail", """
  SELECT lang, n_chars, count(*) AS rows, count(DISTINCT text) AS versions,
         CASE WHEN count(DISTINCT text) = 1 THEN 'exact repeat' ELSE 'conflict' END AS kind
  FROM documents GROUP BY lang, n_chars HAVING count(*) > 1""")
def q_duplicate_detail(spark, sf_dir):
    """Duplicated (lang, n_chars) document keys: exact repeats vs conflicts."""
    return Q.duplicate_detail(load(spark, sf_dir, "documents"), ["lang", "n_chars"], ["text"])


@query("duplicate_classes", """
  WITH d AS (SELECT lang, n_chars, count(*) AS rows,
               CASE WHEN count(DISTINCT text) = 1 THEN 'exact repeat' ELSE 'conflict' END AS kind
             FROM documents GROUP BY lang, n_chars HAVING count(*) > 1)
  SELECT lang, kind, count(*) AS keys, CAST(sum(rows) AS BIGINT) AS rows FROM d GROUP BY lang, kind""")
def q_duplicate_classes(spark, sf_dir):
    """U4: duplicate class totals per language cohort."""
    detail = Q.duplicate_detail(load(spark, sf_dir, "documents"), ["lang", "n_chars"], ["text"])
    return Q.duplicate_classes(detail, "lang")


@query("duration_rules", """
  WITH d AS (SELECT year(o_orderdate) AS year, l_linenumber AS most,
                    (year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) AS m
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  p AS (SELECT year, most, CAST(trunc(m / 12.0) AS INTEGER) AS years, m - 12 * CAST(trunc(m / 12.0) AS INTEGER) AS months FROM d),
  v AS (SELECT *, years + months / 12.0 AS duration,
               years >= 0 AND months BETWEEN 0 AND 11 AND years * 12 + months <= 12 * most AS ok FROM p)
  SELECT CAST(year AS INTEGER) AS year, count(*) AS rows, count(*) FILTER (ok) AS valid,
         """ + rsql("avg(duration) FILTER (ok)", 6) + " AS mean_duration FROM v GROUP BY year")
def q_duration_rules(spark, sf_dir):
    """Order-to-ship time in years plus months: validity of the two parts against a bound, mean of the valid ones."""
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber")
    m = (F.year("l_shipdate") - F.year("o_orderdate")) * 12 + F.month("l_shipdate") - F.month("o_orderdate")
    parts = li.join(o, "l_orderkey").select(F.year("o_orderdate").alias("year"), F.col("l_linenumber").alias("most"), m.alias("m"))
    years = F.when(F.col("m") < 0, F.ceil(F.col("m") / 12)).otherwise(F.floor(F.col("m") / 12))
    parts = parts.withColumn("years", years.cast("int")).withColumn("months", F.col("m") - 12 * F.col("years"))
    ok = valid_duration("years", "months", "most")
    return parts.groupBy("year").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(ok.cast("long")).alias("valid"),
        rnd(F.avg(F.when(ok, compound_duration("years", "months"))), 6).alias("mean_duration"))

