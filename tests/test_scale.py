"""Queries of several passes join their records once; fits keep few, small partitions."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulae.operators import models as M
from tabulae.operators import quality as Q
from tabulae.operators import segment as G
from tabulae.plans import QUERIES, model_queries, tables
from tabulae.plans import segment_queries as SQ
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def joins(monkeypatch):
    """Frames that ``records`` has handed out unwritten, as the optimised plans of what is then computed show them."""
    seen = []
    whole = tables.written

    def counted(df):
        seen.append(plan(df).count("Join Inner"))
        return whole(df)

    monkeypatch.setattr(tables, "written", counted)
    monkeypatch.setattr(model_queries, "written", counted)
    return seen


@pytest.mark.parametrize("name", ["error_summary", "error_summary_distributed", "prediction_range", "subset_summary", "tree_depth3_error",
                                  "cluster_profile", "cluster_profile_distributed", "profile_assembly", "period_variation"])
def test_records_are_joined_once(spark, joins, name):
    out = QUERIES[name](spark, SF_SMALL)
    assert joins == [1]
    assert "o_orderkey" not in plan(out) and "lineitem" not in plan(out)
    assert out.count() > 0


def test_all_fits_of_the_final_scoring_share_one_join(spark, joins, monkeypatch):
    monkeypatch.setattr(model_queries, "FOREST_GRID", {"small": {"num_trees": 2, "max_depth": 2}})
    assert {r["model"] for r in QUERIES["final_scoring"](spark, SF_SMALL).collect()} == {"baseline", "linear", "forest"}
    assert joins == [1]


@pytest.mark.parametrize("name", ["cluster_names", "kmeans_profile", "pca_projection", "contrast_specs"])
def test_clusterings_share_one_join(spark, joins, monkeypatch, name):
    monkeypatch.setattr(SQ, "KS", (2, 3))
    assert QUERIES[name](spark, SF_SMALL).count() > 0
    assert joins == [1]


def test_kmeans_reads_written_features_in_few_tasks(spark, monkeypatch):
    parts, fit = [], G.kmeans

    def seen(*args):
        km = fit(*args)
        assert km.getSolver() == "block"
        inner = km.fit
        km.fit = lambda df: parts.append((df.rdd.getNumPartitions(), df.storageLevel.useMemory)) or inner(df)
        return km

    monkeypatch.setattr(G, "kmeans", seen)
    df = spark.range(0, 400, 1, 40).select((F.col("id") % 2 * 100 + F.rand(1)).alias("a"), (F.col("id") % 2 * 100 + F.rand(2)).alias("b"))
    table, models = G.evaluate_k(df, ["a", "b"], [2])
    assert parts and parts[0][0] < 40 and not parts[0][1]
    assert sorted(table.first()["sizes"]) == [200, 200]
    assert sorted(round(c[0]) for c in models[2].stages[-1].clusterCenters()) == [-1, 1]


def test_projection_sorts_no_more_than_its_sample(spark, monkeypatch):
    seen, whole = [], G.written
    monkeypatch.setattr(G, "written", lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or whole(df))
    df = spark.range(0, 300, 1, 3).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"))
    scaled = G.Pipeline(stages=G.scaling_stages(["a", "b"])).fit(df).transform(df)
    out = G.pca_projection(scaled, G.pca(scaled), ["a"], 20, ["id"])
    assert len(seen) == 1 and "TakeOrderedAndProject" in seen[0]
    assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 20


def _train(spark, parts):
    return spark.range(0, 600, 1, parts).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 3).cast("string").alias("c"),
                                                (F.col("id") % 7 * 2 + F.col("id") % 3).cast("double").alias("y"))


def test_grid_scores_all_models_in_one_pass_per_set(spark, monkeypatch):
    calls, table_of = [], M.metrics_table
    monkeypatch.setattr(M, "metrics_table", lambda df, label, of: calls.append(list(of)) or table_of(df, label, of))
    configs = {"one": {"num_trees": 1, "max_depth": 2}, "two": {"num_trees": 3, "max_depth": 4}}
    df = _train(spark, 2)
    table, models = M.grid_search(df, df.filter("a < 4"), ["a"], ["c"], "y", configs, M.forest_regressor)
    assert calls == [["one", "two"], ["one", "two"]]
    for r in table.collect():
        for part, at in (("train", df), ("valid", df.filter("a < 4"))):
            alone = table_of(models[r["config"]].transform(at), "y", {"m": "prediction"}).first()
            assert np.isclose(r[f"rmse_{part}"], alone["rmse"]) and np.isclose(r[f"mae_{part}"], alone["mae"])


def test_grid_deals_large_partitions_anew(spark):
    seen = []

    class Probe:
        def __init__(self, label):
            self.inner = M.linear_regressor(label)

        def fit(self, df):
            seen.append((df.rdd.getNumPartitions(), df.storageLevel.useMemory))
            return self.inner.fit(df)

    df = _train(spark, 2)
    M.grid_search(df, df, ["a"], ["c"], "y", {"m": {}}, Probe, rows_per_task=100)
    M.grid_search(df, df, ["a"], ["c"], "y", {"m": {}}, Probe)
    assert seen == [(6, False), (2, False)]


def test_conflict_columns_shuffles_rows_not_partial_aggregates(spark):
    rows = [(1, 1, "a", None), (1, 1, "b", None), (2, 1, "a", 1.0), (2, 1, "a", None), (None, 1, "a", 2.0), (None, 1, "a", 3.0), (3, 1, "x", 1.0)]
    out = Q.conflict_columns(spark.createDataFrame(rows, "k long, l int, s string, v double"), ["k", "l"])
    assert {r["column"]: r["keys_with_difference"] for r in out.collect()} == {"s": 1, "v": 2}
    physical = out._jdf.queryExecution().sparkPlan().toString()
    assert "RepartitionByExpression" in plan(out) or "REPARTITION_BY_COL" in physical
