"""Loading of the driver's test tables and the derived frames the bindings use."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulae.sources.shared import written

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def period_of(ts) -> F.Column:
    """``YYYYQn`` label of a timestamp."""
    return F.concat(F.year(ts).cast("string"), F.lit("Q"), F.quarter(ts).cast("string"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` joined to ``orders`` on the order key, with a quarterly period.

    Both sides are large at scale, so this is a shuffle (sort-merge) join on the
    key; only the columns the bindings use are read.
    """
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")
    od = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority", "o_orderstatus")
    return (li.join(od, "l_orderkey", "inner")
              .withColumn("period", period_of(F.col("o_orderdate")))
              .withColumn("year", F.year("o_orderdate")))


def kept_records(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    """Some columns of ``records``, joined once: queries of several passes read them again without the join's shuffle."""
    return written(records(spark, sf_dir).select(*columns))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` with its region name (two dimension lookups, auto-broadcast by size)."""
    c = load(spark, sf_dir, "customer")
    n = load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    r = load(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return c.join(n, "c_nationkey", "left").join(r, "n_regionkey", "left").drop("n_regionkey")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` left-joined to ``labels``: unlabelled documents carry structural NULLs."""
    d = load(spark, sf_dir, "documents")
    lab = load(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left")
