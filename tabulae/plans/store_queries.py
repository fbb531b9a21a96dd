"""Stored tables bound to the driver's tables: versions of periods, buckets of the order key, sketches kept per period."""
from __future__ import annotations

from pyspark.sql import functions as F

from tabulae.operators import sketches as SK
from tabulae.plans.explore_queries import RECORDS_SQL
from tabulae.plans.registry import query, rnd, rsql
from tabulae.plans.tables import load, period_of, records
from tabulae.sources import shared_folder
from tabulae.sources import store as ST

#: The year that comes later, or anew, and what is added to a price in the delivery that corrects it.
LATE_YEAR, CORRECTION = 2001, 100.0
QUANTILES = [0.1, 0.5, 0.9]
MEASURES = ["l_extendedprice", "l_quantity"]


@query("committed_periods", f"""
  WITH o AS (SELECT CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS period,
                    year(o_orderdate) = {LATE_YEAR} AS late, o_totalprice FROM orders)
  SELECT period, CAST(CASE WHEN late THEN 2 ELSE 1 END AS INTEGER) AS version, count(*) AS rows,
         {rsql(f'sum(o_totalprice + CASE WHEN late THEN {CORRECTION} ELSE 0 END)', 2)} AS total FROM o GROUP BY period, late""")
def q_committed_periods(spark, sf_dir):
    """Quarters of orders, all written in one job; a conversion of the last year that broke off before it was
    published; the corrected year; the table as read from the latest version."""
    orders = load(spark, sf_dir, "orders").withColumn("period", period_of(F.col("o_orderdate")))
    target = shared_folder(spark)
    ST.commit(orders, target)
    late = orders.filter(F.year("o_orderdate") == LATE_YEAR)
    ST.stage(late.withColumn("o_totalprice", F.lit(0.0)), target)
    ST.commit(late.withColumn("o_totalprice", F.col("o_totalprice") + CORRECTION), target)
    came = {p: v["version"] for p, v in ST.manifest(spark, target)["periods"].items()}  # one entry per period
    version = F.element_at(F.create_map(*[F.lit(x) for item in came.items() for x in item]), F.col("period"))
    found = ST.read_version(spark, target).groupBy("period").agg(F.count("*").alias("rows"), F.sum("o_totalprice").alias("total"))
    return found.select("period", version.cast("int").alias("version"), "rows", rnd("total", 2).alias("total"))


def stored_records(spark, sf_dir):
    """``lineitem`` and ``orders`` from stored buckets of the order key, joined where they lie."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    found = ST.bucketed({"lines": lines, "orders": orders}, ["l_orderkey"])
    return found["lines"].join(found["orders"].hint("merge"), "l_orderkey")


@query("stored_records", f"""
  WITH s AS (SELECT l_orderkey, any_value(o_orderpriority) AS o_orderpriority, count(*) AS lines, sum(l_quantity) AS quantity,
                    max(l_extendedprice) AS dearest FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey)
  SELECT o_orderpriority, lines, count(*) AS orders, {rsql('sum(quantity)', 2)} AS quantity, {rsql('max(dearest)', 2)} AS dearest
  FROM s GROUP BY o_orderpriority, lines""")
def q_stored_records(spark, sf_dir):
    """Orders by priority and number of lines; the join and the sums per order read stored buckets and don't shuffle."""
    per_order = stored_records(spark, sf_dir).groupBy("l_orderkey").agg(
        F.first("o_orderpriority").alias("o_orderpriority"), F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"),
        F.max("l_extendedprice").alias("dearest"))
    return per_order.groupBy("o_orderpriority", "lines").agg(
        F.count("*").alias("orders"), rnd(F.sum("quantity"), 2).alias("quantity"), rnd(F.max("dearest"), 2).alias("dearest"))


@query("stored_quantiles", RECORDS_SQL + " UNION ALL ".join(
    f"SELECT l_returnflag, '{c}' AS variable, CAST({p} AS DOUBLE) AS p, {rsql(f'quantile_cont({c}, {p})')} AS value FROM r GROUP BY l_returnflag"
    for c in MEASURES for p in QUANTILES))
def q_stored_quantiles(spark, sf_dir):
    """Exact quantiles by flag over all periods, bracketed by sketches that were stored period by period; the
    last year comes later and only its own records are sketched."""
    rows, kept = shared_folder(spark), shared_folder(spark)
    whole = records(spark, sf_dir).select("period", "year", "l_returnflag", *MEASURES)
    for delivery in (whole.filter(F.col("year") < LATE_YEAR), whole.filter(F.col("year") >= LATE_YEAR)):
        version = ST.commit(delivery.drop("year"), rows)
        new = [p for p, v in ST.manifest(spark, rows)["periods"].items() if v["version"] == version]
        ST.commit(SK.period_sketches(ST.read_version(spark, rows, new), MEASURES, ["l_returnflag"]), kept)
    found = SK.stored_quantiles(ST.read_version(spark, rows), ST.read_version(spark, kept), MEASURES, QUANTILES, ["l_returnflag"], interpolate=True)
    return found.withColumn("value", rnd("value"))
