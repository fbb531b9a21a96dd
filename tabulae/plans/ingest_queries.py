"""Harmonisation and set operators bound to the driver's tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from tabulae.functions import canonical_code
from tabulae.operators import harmonise as H
from tabulae.operators import sets as S
from tabulae.plans.registry import query
from tabulae.plans.tables import load, records
from tabulae.sources import load_delivery, shared_folder


def canon_sql(x: str) -> str:
    """DuckDB form of ``canonical_code``: plain numbers by text alone, exponent forms as numbers."""
    t = f"trim(CAST(({x}) AS VARCHAR))"
    bare = f"ltrim(ltrim(regexp_replace({t}, '\\.0*$', ''), '+-'), '0')"
    n = f"try_cast({t} AS DOUBLE)"
    return (f"CASE WHEN {t} IS NULL OR {t} = '' THEN NULL "
            f"WHEN regexp_full_match({t}, '[+-]?[0-9]+(\\.0*)?') THEN "
            f"CASE WHEN {bare} = '' THEN '0' WHEN starts_with({t}, '-') THEN '-' || {bare} ELSE {bare} END "
            f"WHEN regexp_full_match({t}, '[+-]?[0-9.]+[eE][+-]?[0-9]+') AND {n} = floor({n}) AND abs({n}) <= 9007199254740992 "
            f"THEN CAST(CAST({n} AS BIGINT) AS VARCHAR) ELSE {t} END")


_K = "json_extract_string(props, '$.k')"


@query("canonical_code", f"""
  SELECT event_id, {canon_sql(_K)} AS code_k, {canon_sql(_K + " || '.0'")} AS code_decimal,
         {canon_sql("'  ' || " + _K + " || ' '")} AS code_padded,
         {canon_sql("regexp_replace(" + _K + ", '[0-9]', '', 'g')")} AS code_blank,
         {canon_sql("event_type")} AS code_text, {canon_sql("CAST(value AS VARCHAR)")} AS code_value,
         {canon_sql("'-0900719925' || lpad(CAST(event_id AS VARCHAR), 9, '0') || '.00'")} AS code_long
  FROM events""")
def q_canonical_code(spark, sf_dir):
    """Canonical spelling of codes from raw event text in several decorations."""
    e = load(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", canonical_code(k).alias("code_k"),
                    canonical_code(F.concat(k, F.lit(".0"))).alias("code_decimal"),
                    canonical_code(F.concat(F.lit("  "), k, F.lit(" "))).alias("code_padded"),
                    canonical_code(F.regexp_replace(k, "[0-9]", "")).alias("code_blank"),
                    canonical_code("event_type").alias("code_text"),
                    canonical_code(F.col("value").cast("string")).alias("code_value"),
                    canonical_code(F.concat(F.lit("-0900719925"), F.lpad(F.col("event_id").cast("string"), 9, "0"), F.lit(".00")))
                    .alias("code_long"))


_REQUIRED = ["C_CUSTKEY", "C_NAME", "C_NATIONKEY", "C_ACCTBAL", "C_MKTSEGMENT"]
_RENAMES = {"C_CUSTKEY": "customer_id", "C_NAME": "name", "C_NATIONKEY": "nation", "C_ACCTBAL": "balance",
            "C_MKTSEGMENT": "segment"}


@query("harmonise_types", f"""
  SELECT {canon_sql('c_custkey')} AS customer_id, {canon_sql('c_name')} AS name,
         CAST(trunc(try_cast(trim(CAST(c_nationkey AS VARCHAR)) AS DOUBLE)) AS INTEGER) AS nation,
         try_cast(trim(CAST(c_acctbal AS VARCHAR)) AS DOUBLE) AS balance, {canon_sql('c_mktsegment')} AS segment,
         'D1' AS period, 'customer.parquet' AS source, 2024 AS year, 1 AS quarter
  FROM customer""")
def q_harmonise_types(spark, sf_dir):
    """Text scan of a delivery, required columns by normalised name, typed, with provenance."""
    return load_delivery(spark, f"{sf_dir}/customer.parquet", "D1", _REQUIRED, _RENAMES,
                         doubles=["balance"], ints=["nation"], codes=["customer_id", "name", "segment"],
                         year=2024, quarter=1, fmt="parquet")


@query("moved_headers", f"""
  SELECT {canon_sql('o_orderkey')} AS order_id, {canon_sql('o_orderpriority')} AS priority, o_totalprice AS price,
         CAST(o_custkey AS INTEGER) AS customer,
         'd' || CAST(o_orderkey % 2 AS VARCHAR) AS period, 'd' || CAST(o_orderkey % 2 AS VARCHAR) AS source FROM orders""")
def q_moved_headers(spark, sf_dir):
    """Text deliveries whose columns stand in another order, with another spelling and one more column,
    read by name, typed and stacked."""
    folder = shared_folder(spark)
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    parts = []
    for i in (0, 1):
        d = o.filter(F.col("o_orderkey") % 2 == i).select(*[F.col(c).cast("string").alias(c.upper() if i else f" {c} ")
                                                            for c in (reversed(o.columns) if i else o.columns)])
        d = d.withColumn("EXTRA", F.lit("x")) if i else d
        d.write.option("header", "true").csv(f"{folder}/d{i}")
        parts.append(load_delivery(spark, f"{folder}/d{i}", f"d{i}", ["O_ORDERKEY", "O_CUSTKEY", "O_TOTALPRICE", "O_ORDERPRIORITY"],
                                   {"O_ORDERKEY": "order_id", "O_CUSTKEY": "customer", "O_TOTALPRICE": "price", "O_ORDERPRIORITY": "priority"},
                                   doubles=["price"], ints=["customer"], codes=["order_id", "priority"]))
    return H.stack_by_name(parts)


@query("stack_by_name", """
  SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem""")
def q_stack_by_name(spark, sf_dir):
    """O1: deliveries with different column orders stacked by name."""
    li = load(spark, sf_dir, "lineitem")
    a = li.filter(F.col("l_returnflag") == "A").select("l_orderkey", "l_linenumber", "l_returnflag")
    n = li.filter(F.col("l_returnflag") == "N").select("l_returnflag", "l_linenumber", "l_orderkey")
    r = li.filter(~F.col("l_returnflag").isin("A", "N") | F.col("l_returnflag").isNull()) \
          .select("l_linenumber", "l_returnflag", "l_orderkey")
    return H.stack_by_name([a, n, r])


_R = """WITH r AS (
  SELECT l.*, o.o_orderdate, o.o_orderpriority,
         CAST(year(o.o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o.o_orderdate) AS VARCHAR) AS period,
         CAST(year(o.o_orderdate) AS INTEGER) AS year
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
"""
DEV_YEARS = [1995, 1996, 1997, 1998, 1999, 2000]
ALLOWED = [f"{y}Q{q}" for y in DEV_YEARS for q in (1, 2, 3, 4)]


@query("periods_outside", _R + f"""
  SELECT DISTINCT period FROM r WHERE NOT coalesce(period IN ({", ".join(repr(p) for p in ALLOWED)}), false)""")
def q_periods_outside(spark, sf_dir):
    """Periods present outside the development set (what the leakage guard refuses)."""
    return S.periods_outside(records(spark, sf_dir), "period", ALLOWED)


@query("unseen_categories", """
  WITH c AS (SELECT 'o_custkey' AS variable, CAST(o_custkey AS VARCHAR) AS code, year(o_orderdate) AS year FROM orders
             UNION ALL SELECT 'o_orderpriority', o_orderpriority, year(o_orderdate) FROM orders)
  SELECT DISTINCT variable, code FROM c WHERE year = 2001
  EXCEPT SELECT DISTINCT variable, code FROM c WHERE year < 2001""")
def q_unseen_categories(spark, sf_dir):
    """O3: codes of the 2001 test year never seen in 1995-2000 training, per categorical."""
    o = load(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    return S.unseen_categories(o.filter(F.col("year") < 2001), o.filter(F.col("year") == 2001),
                               ["o_custkey", "o_orderpriority"])


@query("unseen_summary", """
  WITH c AS (SELECT 'p_brand' AS variable, p_brand AS code, p_size FROM part
             UNION ALL SELECT 'p_type', p_type, p_size FROM part),
  u AS (SELECT DISTINCT variable, code FROM c WHERE p_size > 1 EXCEPT SELECT DISTINCT variable, code FROM c WHERE p_size = 1)
  SELECT variable, list_sort(list(code)) AS codes, count(*) AS n_unseen FROM u GROUP BY variable""")
def q_unseen_summary(spark, sf_dir):
    """O3: unseen codes collected per dictionary-coded categorical (keys stay in the long form)."""
    part = load(spark, sf_dir, "part")
    return S.unseen_summary(S.unseen_categories(part.filter("p_size = 1"), part.filter("p_size > 1"), ["p_brand", "p_type"]))


@query("periods_per_split", _R + """
  , s AS (SELECT CASE WHEN year <= 1999 THEN 'train' WHEN year = 2000 THEN 'valid' ELSE 'test' END AS split, period FROM r)
  SELECT split, list_sort(list(DISTINCT period)) AS periods, count(DISTINCT period) AS n_periods FROM s GROUP BY split""")
def q_periods_per_split(spark, sf_dir):
    """Distinct sorted periods of the train / valid / test splits."""
    r = records(spark, sf_dir)
    train, valid = S.split_periods(r, "year", DEV_YEARS[:-1], DEV_YEARS[-1:])
    test = r.filter(F.col("year") == 2001)
    return S.periods_per_split({"train": train, "valid": valid, "test": test}, "period")
