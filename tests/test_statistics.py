"""Models from sufficient statistics against the iterative fits, numpy and brute force."""
import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from tabulae.operators import gram, lloyd, moments, tree
from tabulae.operators import models as M
from tabulae.operators.features import preprocessing_stages
from tabulae.operators.segment import scaling_stages

CONFIGS = {"ols": {"reg_param": 0.0, "elastic_net": 0.0}, "ridge_0.1": {"reg_param": 0.1, "elastic_net": 0.0},
           "ridge_1": {"reg_param": 1.0, "elastic_net": 0.0}, "lasso_0.1": {"reg_param": 0.1, "elastic_net": 1.0},
           "elastic_0.1": {"reg_param": 0.1, "elastic_net": 0.5}}


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(11)
    rows = []
    for i in range(600):
        a, b, code = float(rng.normal(2020, 2)), float(rng.integers(0, 9)), "xyyzzz"[rng.integers(0, 6)]
        group = None if i % 97 == 0 else "uvw"[rng.integers(0, 3)]
        y = 3.0 * (a - 2020) - 1.5 * b + {"x": 4.0, "y": -2.0, "z": 0.0}[code] + (1.0 if group is None else 0.0) + float(rng.normal())
        rows.append((i, a, b, code, group, y))
    return spark.createDataFrame(rows, "id long, a double, b double, code string, grp string, y double").repartition(4).cache()


@pytest.mark.parametrize("name", CONFIGS)
def test_every_penalty_equals_the_iterative_fit(people, name):
    params = CONFIGS[name]
    design = gram.cross_products(people, ["a", "b"], ["code", "grp"], "y")
    fit = gram.solve(design, **params)
    lr = LinearRegression(featuresCol="features", labelCol="y", regParam=params["reg_param"], elasticNetParam=params["elastic_net"], maxIter=2000, tol=1e-14)
    model = Pipeline(stages=[*preprocessing_stages(["a", "b"], ["code", "grp"]), lr]).fit(people)
    both = model.transform(people).select("prediction", fit.prediction().alias("own")).collect()
    spread = np.std([r.prediction for r in both])
    assert max(abs(r.prediction - r.own) for r in both) < 1e-5 * spread
    if params["reg_param"] and params["elastic_net"] == 0.0:
        assert np.allclose(model.stages[-1].coefficients.toArray(), fit.coefficients, atol=1e-6)


def test_grid_table_equals_the_fit_loop(people):
    train, valid = people.filter("id < 450"), people.filter("id >= 450")
    own, fits = gram.linear_grid(train, valid, ["a", "b"], ["code", "grp"], "y", CONFIGS)
    other, _ = M.grid_search(train, valid, ["a", "b"], ["code", "grp"], "y", CONFIGS, M.linear_regressor)
    assert own.schema == other.schema
    for x, y in zip(own.orderBy("position").collect(), other.orderBy("position").collect()):
        assert x.config == y.config and x.params == y.params
        assert np.allclose(x[3:], y[3:], rtol=1e-4)
    table = gram.coefficient_table(fits["ridge_1"], train).collect()
    assert table[0].variable == "(intercept)" and [abs(r.coefficient) for r in table[1:]] == sorted((abs(r.coefficient) for r in table[1:]), reverse=True)


def test_cells_pool_to_numpy_moments_with_a_large_offset(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3)) @ rng.normal(size=(3, 3)) + 1e7
    codes = rng.integers(0, 4, 300)
    rows = [(*map(float, v), str(c) if c else None) for v, c in zip(x, codes)] + [(None, 1.0, 2.0, "1"), (float("nan"), 1.0, 2.0, "2")]
    df = spark.createDataFrame(rows, "p double, q double, r double, c string")
    found = moments.cells(df, ["p", "q", "r"], ["c"])
    n, mean, cov = found.pooled()
    assert n == 300 and len(found.codes) == 4 and np.allclose(mean, x.mean(axis=0))
    assert np.allclose(cov, np.cov(x.T, bias=True), rtol=1e-6)
    with pytest.raises(ValueError):
        gram.cross_products(df.filter("p < 0"), ["p"], ["c"], "q")


def test_principal_axes_equal_the_pca_stage_and_have_fixed_signs(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 4)) * [1, 5, 0.1, 3]
    x[:, 3] += x[:, 1]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    cols = df.columns
    axes = moments.principal_axes(df, cols, 3)
    scaled = Pipeline(stages=scaling_stages(cols)).fit(df).transform(df)
    model = PCA(k=3, inputCol="x_std", outputCol="pc").fit(scaled)
    assert np.allclose([a["explained"] for a in axes], model.explainedVariance.toArray())
    own = np.array([list(r) for r in moments.project(df, cols, axes).collect()])
    ml = np.array([r[0] for r in model.transform(scaled).select(vector_to_array("pc")).collect()])
    order = lambda m: m[np.lexsort(np.round(np.abs(m), 6).T)]
    assert np.allclose(order(np.abs(own)), order(np.abs(ml)), atol=1e-8)
    assert all(a["loadings"][int(np.argmax(np.abs(a["loadings"])))] > 0 for a in axes)
    flat = moments.principal_axes(df.withColumn("e", F.lit(7.0)), ["a", "e"], 2)
    assert abs(flat[0]["explained"] - 1.0) < 1e-12 and abs(flat[0]["loadings"][1]) < 1e-12


def brute_lloyd(x, starts, rounds):
    c = np.array(starts, dtype=float)
    for _ in range(rounds):
        near = ((x[:, None] - c) ** 2).sum(axis=2).argmin(axis=1)
        c = np.array([x[near == i].mean(axis=0) if (near == i).any() else c[i] for i in range(len(c))])
    d = ((x[:, None] - c) ** 2).sum(axis=2)
    return c, d.argmin(axis=1), d.min(axis=1).sum()


def test_rounds_equal_brute_force_and_the_evaluator(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(m, 0.6, size=(70, 2)) for m in (0.0, 3.0, 7.0)]).round(1)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x] + [(None, 1.0)], "a double, b double").repartition(3)
    starts = {k: lloyd.spaced_centres(["a", "b"], k) for k in (2, 3, 4)}
    fits = lloyd.fit(df, ["a", "b"], starts, rounds=6, tolerance=0.0)
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    scaled = Pipeline(stages=scaling_stages(["a", "b"])).fit(df.dropna()).transform(df.dropna()).withColumn("zz", vector_to_array("x_std"))
    for k, f in fits.of.items():
        centres, near, cost = brute_lloyd(z, starts[k], 6)
        assert np.allclose(f.centres, centres) and f.sizes.tolist() == np.bincount(near, minlength=k).tolist() and abs(f.wssse - cost) < 1e-8
        distance = F.array(*[sum((F.col("zz")[j] - float(v)) * (F.col("zz")[j] - float(v)) for j, v in enumerate(c)) for c in centres])
        labelled = scaled.withColumn("cluster", F.array_position(distance, F.array_min(distance)).cast("int"))
        ev = ClusteringEvaluator(featuresCol="x_std", predictionCol="cluster", metricName="silhouette")
        assert abs(ev.evaluate(labelled) - f.silhouette) < 1e-9
    table = {r.k: r for r in lloyd.grid_table(df, fits).collect()}
    assert table[2].wssse_reduction_pct is None and table[3].wssse_reduction_pct > 0 and sum(table[3].sizes) == 210
    best = KMeans(featuresCol="x_std", k=3, seed=1).fit(scaled).summary.trainingCost
    assert abs(lloyd.fit(df, ["a", "b"], {3: starts[3]}, 50).of[3].wssse - best) < 1e-6 * best


def test_a_cluster_without_rows_keeps_its_centre_and_one_value_is_enough(spark):
    df = spark.createDataFrame([(1.0, 1.0)] * 5, "a double, b double")
    fits = lloyd.fit(df, ["a", "b"], {2: [[0.0, 0.0], [9.0, 9.0]]}, rounds=3)
    assert fits.of[2].sizes.tolist() == [5, 0] and fits.of[2].centres[1].tolist() == [9.0, 9.0] and fits.of[2].wssse == 0.0
    with pytest.raises(ValueError):
        lloyd.fit(df.filter("a > 1"), ["a"], {2: [[0.0], [1.0]]})


@pytest.mark.parametrize("depth", [1, 3, 5])
def test_tree_equals_an_unbagged_forest_of_one(spark, depth):
    rng = np.random.default_rng(depth)
    rows = [(float(rng.integers(0, 12)), float(rng.integers(0, 7)) / 10, float(rng.integers(0, 2)), 0.0) for _ in range(400)]
    rows = [(a, b, c, a * (1 + c) + 5 * (b > 0.3) * c + float(rng.normal())) for a, b, c, _ in rows]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double").repartition(3)
    nodes = tree.grow(df, ["a", "b", "c"], "y", depth)
    forest = RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=1, maxDepth=depth, featureSubsetStrategy="all", bootstrap=False, maxBins=32)
    model = Pipeline(stages=[*preprocessing_stages(["a", "b", "c"], []), forest]).fit(df)
    both = model.transform(df).select("prediction", tree.prediction(nodes).alias("own")).collect()
    assert max(abs(r.prediction - r.own) for r in both) < 1e-9
    assert sum(x.n for x in nodes if x.feature is None) == 400 and len(model.stages[-1].trees[0].toDebugString) > 0
    assert model.stages[-1].trees[0].numNodes == len(nodes)


def test_tree_edges(spark):
    flat = spark.createDataFrame([(float(i % 4), 2.0) for i in range(20)] + [(None, 9.0), (float("nan"), 9.0), (1.0, None)], "x double, y double")
    assert [(n.number, n.n, n.mean, n.feature) for n in tree.grow(flat, ["x"], "y")] == [(1, 20, 2.0, None)]
    assert tree.grow(flat.filter("x > 100 AND NOT isnan(x)"), ["x"], "y") == []
    many = spark.createDataFrame([(float(i), float(i >= 500)) for i in range(1000)], "x double, y double")
    nodes = tree.grow(many, ["x"], "y", 1, max_bins=8)
    assert nodes[0].feature == "x" and abs(nodes[0].threshold - 500) < 130 and tree.table(many, nodes).count() == 3
    some = spark.createDataFrame([(None,), (float("nan"),), (3.0,)], "x double").select(tree.prediction(nodes).alias("p")).collect()
    assert some[0].p == some[1].p == nodes[0].mean and some[2].p == nodes[1].mean
