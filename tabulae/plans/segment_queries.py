"""Segmentation operators bound to the driver's tables.

Value-checked: silhouette of the given ``embeddings.label`` labelling, cluster
profile / composition / dominant category with ``l_returnflag`` as the
cluster label, and the explained variance of a 2-variable PCA
(``(1 +- |r|) / 2``).  KMeans fits are layout-dependent and get rows-only
checks plus invariant tests.
"""
from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabulae.functions import log10_positive
from tabulae.operators import explore as X
from tabulae.operators import lloyd as L
from tabulae.operators import segment as G
from tabulae.plans.explore_queries import RECORDS_SQL
from tabulae.plans.registry import query, round_doubles, rsql, sround
from tabulae.plans.tables import kept_records, load, records
from tabulae.sources.shared import written

VARS = ["l_quantity", "l_discount", "l_tax"]
TARGET = "l_extendedprice"
KS = (2, 3, 4, 5)
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
# Fixed values of the binding: words used to name clusters.
TRAITS = [("l_quantity", "small orders", "large orders"), ("l_discount", "low discount", "high discount"),
          ("l_tax", "low tax", "high tax")]

_SIL_SQL = """
WITH x AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
pt AS (SELECT vec_id, any_value(label) AS label, sum(v * v) AS nx FROM x GROUP BY vec_id),
cs AS (SELECT label, count(*) AS n, sum(nx) AS psi FROM pt GROUP BY label),
cy AS (SELECT label, i, sum(v) AS y FROM x GROUP BY label, i),
dt AS (SELECT x.vec_id, cy.label AS c, sum(x.v * cy.y) AS dot FROM x JOIN cy ON x.i = cy.i GROUP BY x.vec_id, cy.label),
d AS (SELECT dt.vec_id, dt.c, pt.label AS own, cs.n, pt.nx + cs.psi / cs.n - 2 * dt.dot / cs.n AS dist
      FROM dt JOIN pt ON dt.vec_id = pt.vec_id JOIN cs ON dt.c = cs.label),
ab AS (SELECT vec_id, max(CASE WHEN c = own THEN n END) AS n_own,
              max(CASE WHEN c = own THEN dist * n / (n - 1) END) AS a,
              min(CASE WHEN c <> own THEN dist END) AS b FROM d GROUP BY vec_id),
s AS (SELECT CASE WHEN n_own = 1 THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0.0 END AS s FROM ab)
"""


@query("silhouette", _SIL_SQL + f"SELECT {rsql('avg(s)', 8)} AS silhouette FROM s")
def q_silhouette(spark, sf_dir):
    """Silhouette (squared Euclidean) of the embeddings' given labels, distributed evaluator."""
    e = load(spark, sf_dir, "embeddings").select(array_to_vector("embedding").alias("v"), F.col("label").cast("double").alias("label"))
    value = G.silhouette(e, "v", "label")
    return spark.range(1).select((F.round(F.lit(value) * 1e8, 0) / 1e8).alias("silhouette"))


def _profile_sql() -> str:
    cols = []
    for v in VARS + [TARGET]:
        cols += [f"{rsql(f'avg({v})', 4)} AS {v}_mean", f"{rsql(f'quantile_cont({v}, 0.5)', 4)} AS {v}_median"]
    cols += [f"{rsql(f'quantile_cont({TARGET}, 0.25)', 4)} AS {TARGET}_p25",
             f"{rsql(f'quantile_cont({TARGET}, 0.75)', 4)} AS {TARGET}_p75"]
    return RECORDS_SQL + f"""SELECT l_returnflag, count(*) AS n, {sround('100.0 * count(*) / sum(count(*)) OVER ()', 2)} AS pct,
      {', '.join(cols)} FROM r GROUP BY l_returnflag"""


@query("cluster_profile", _profile_sql())
def q_cluster_profile(spark, sf_dir):
    """Profile per cluster label (return flag): n, %, mean / median per variable, target P25 / P75."""
    return round_doubles(G.cluster_profile(kept_records(spark, sf_dir, ["l_returnflag", *VARS, TARGET]), VARS, TARGET, "l_returnflag"), 4, skip=("pct",))


@query("composition", RECORDS_SQL + """
  , c AS (SELECT l_returnflag, o_orderpriority, count(*) AS n FROM r GROUP BY ALL)
  , t AS (SELECT l_returnflag, sum(n) AS tot FROM c GROUP BY 1)
  SELECT t.l_returnflag, """ + ", ".join(
    f"""{sround(f"100.0 * coalesce(sum(CASE WHEN o_orderpriority = '{p}' THEN n END), 0) / any_value(tot)", 2)} AS "{p}" """
    for p in PRIORITIES) + " FROM t JOIN c USING (l_returnflag) GROUP BY t.l_returnflag")
def q_composition(spark, sf_dir):
    """% of each order priority inside each cluster label, zero-filled, rows sum to 100."""
    return G.composition(records(spark, sf_dir), "o_orderpriority", "l_returnflag", PRIORITIES)


@query("dominant", RECORDS_SQL + f"""
  , c AS (SELECT l_returnflag, o_orderpriority AS category, count(*) AS n FROM r GROUP BY ALL)
  , p AS (SELECT l_returnflag, category, {sround('100.0 * n / sum(n) OVER (PARTITION BY l_returnflag)', 2)} AS pct FROM c)
  , k AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY pct DESC,
                 try_cast(category AS DOUBLE) NULLS LAST, category) AS rn FROM p)
  SELECT l_returnflag, category, pct FROM k WHERE rn = 1""")
def q_dominant(spark, sf_dir):
    """Dominant order priority per cluster label and its %."""
    return G.dominant(G.composition_long(records(spark, sf_dir), "o_orderpriority", "l_returnflag"), "l_returnflag")


@query("pca_variance", RECORDS_SQL + f"""
  , c AS (SELECT abs(corr(l_quantity, l_discount)) AS r FROM r)
  SELECT 1 AS component, {rsql('(1 + r) / 2', 8)} AS explained_variance FROM c
  UNION ALL SELECT 2, {rsql('(1 - r) / 2', 8)} FROM c""")
def q_pca_variance(spark, sf_dir):
    """Explained variance of a 2-component PCA of two standardised variables."""
    from pyspark.ml import Pipeline
    r = records(spark, sf_dir)
    scaled = Pipeline(stages=G.scaling_stages(["l_quantity", "l_discount"])).fit(r).transform(r)
    return round_doubles(G.explained_variance(G.pca(scaled)), 8)


@query("elbow_choice", RECORDS_SQL + ", t AS (" + " UNION ALL ".join(
    f"""SELECT {k} AS k, sum(ss) AS wssse, 100.0 * min(n) / sum(n) AS smallest_pct
        FROM (SELECT count(*) AS n, count(*) * var_pop(l_quantity) AS ss FROM r GROUP BY floor((l_quantity - 1) * {k} / 50))""" for k in KS) + """)
  , f AS (SELECT *, (lag(wssse) OVER (ORDER BY k) - wssse) / lag(wssse) OVER (ORDER BY k) AS fall FROM t)
  SELECT CAST(arg_max(k, fall) FILTER (k >= 3 AND smallest_pct >= 5) AS INTEGER) AS k, 'elbow' AS rule FROM f""")
def q_elbow_choice(spark, sf_dir):
    """The elbow rule over given labellings (k equal bands of the quantity)."""
    r, table = records(spark, sf_dir).select("l_quantity"), None
    for k in KS:
        sizes = r.groupBy(F.floor((F.col("l_quantity") - 1) * k / 50).alias("c")).agg(
            F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) * F.var_pop("l_quantity")).alias("ss"))
        one = sizes.agg(F.lit(k).alias("k"), F.sum("ss").alias("wssse"), (100.0 * F.min("n") / F.sum("n")).alias("smallest_pct"),
                        F.lit(0.0).alias("silhouette"))
        table = one if table is None else table.unionByName(one)
    return G.choose_k(G.with_reduction(table))


@query("level_names", RECORDS_SQL + f"""
  , s AS (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_discount) AS md, stddev_samp(l_discount) AS sd,
                 avg(l_tax) AS mt, stddev_samp(l_tax) AS st FROM r)
  , z AS (SELECT CAST(floor((l_quantity - 1) / 10) AS INTEGER) * 3 + CAST(floor(l_discount / 0.04) AS INTEGER) AS cluster,
                 avg((l_quantity - mq) / sq) AS q, avg((l_discount - md) / sd) AS d, avg((l_tax - mt) / st) AS t FROM r, s GROUP BY 1)
  , w AS (SELECT *, concat_ws(', ', CASE WHEN q >= 0.5 THEN 'large orders' WHEN q <= -0.5 THEN 'small orders' END,
                 CASE WHEN d >= 0.5 THEN 'high discount' WHEN d <= -0.5 THEN 'low discount' END,
                 CASE WHEN t >= 0.5 THEN 'high tax' WHEN t <= -0.5 THEN 'low tax' END) AS words FROM z)
  SELECT cluster, {rsql('q', 6)} AS l_quantity_z, {rsql('d', 6)} AS l_discount_z, {rsql('t', 6)} AS l_tax_z,
         CASE WHEN words = '' THEN 'Average profile' ELSE upper(words[1]) || words[2:] END AS name FROM w""")
def q_level_names(spark, sf_dir):
    """Z-centroids of a given labelling (bands of quantity and discount), named from their profile."""
    from tabulae.operators.features import standardise
    label = F.floor((F.col("l_quantity") - 1) / 10).cast("int") * 3 + F.floor(F.col("l_discount") / 0.04).cast("int")
    r = records(spark, sf_dir).select(label.alias("cluster"), *VARS)
    cent = standardise(r, VARS, keep=["cluster"]).groupBy("cluster").agg(*[F.avg(f"{v}_z").alias(f"{v}_z") for v in VARS])
    return round_doubles(G.name_clusters(cent, TRAITS), 6)


# --------------------------------------------------------------------------- KMeans (rows-only)

def _grid(df, variables=VARS):
    return G.evaluate_k(df, variables, KS, seed=42)


def _rounds(spark, sf_dir):
    r = records(spark, sf_dir)
    return L.grid_table(r, L.fit(r, VARS, {k: L.spaced_centres(VARS, k) for k in KS}))


@query("kmeans_grid")
def q_kmeans_grid(spark, sf_dir):
    """KMeans for k = 2..5 on standardised measures: silhouette, WSSSE, sizes, reduction; every k in the same rounds."""
    return _rounds(spark, sf_dir)


@query("choose_k")
def q_choose_k(spark, sf_dir):
    """K chosen by the elbow rule (fallback: best silhouette)."""
    return G.choose_k(_rounds(spark, sf_dir))


@query("cluster_names")
def q_cluster_names(spark, sf_dir):
    """Centroids (z and original units) of the chosen k, named from their z-profile."""
    table, models = _grid(kept_records(spark, sf_dir, VARS))
    k = G.choose_k(table).first()["k"]
    return G.name_clusters(G.centroids(models[k], VARS), TRAITS)


@query("kmeans_profile")
def q_kmeans_profile(spark, sf_dir):
    """G6/G10 on KMeans output: profile and median ratio of each fitted cluster."""
    r = kept_records(spark, sf_dir, [*VARS, TARGET])
    table, models = _grid(r)
    k = G.choose_k(table).first()["k"]
    pred = written(models[k].transform(r).select("cluster", *VARS, TARGET))  # several passes read the clusters
    prof = G.cluster_profile(pred, VARS, TARGET)
    return prof.join(X.median_ratio(pred, "cluster", TARGET).select("cluster", "ratio"), "cluster")


@query("pca_projection")
def q_pca_projection(spark, sf_dir):
    """Sample of 5,000 records projected on the first two principal components with their cluster."""
    r, key = kept_records(spark, sf_dir, ["l_orderkey", "l_linenumber", *VARS, TARGET]), ["l_orderkey", "l_linenumber"]
    table, models = _grid(r)
    k = G.choose_k(table).first()["k"]
    components = G.pca(models[k].transform(r))
    # the sample is the same before and after the transformation; before, only its rows are transformed
    return G.pca_projection(models[k].transform(X.hash_sample(r, 5000, key, 42)), components, ["cluster", *VARS, TARGET], 5000, key)


@query("contrast_specs")
def q_contrast_specs(spark, sf_dir):
    """Chosen k, silhouette, smallest share and z-range without / with the log10 target."""
    r = kept_records(spark, sf_dir, [*VARS, TARGET]).withColumn("log_price", log10_positive(TARGET))
    with_log = VARS + ["log_price"]
    t1, m1 = _grid(r, VARS)
    t2, m2 = _grid(r, with_log)
    return G.contrast({"without_target": (r, t1, m1), "with_log_target": (r, t2, m2)}, "l_quantity")


@query("cluster_profile_distributed", _profile_sql())
def q_cluster_profile_distributed(spark, sf_dir):
    """G6 with distributed exact medians and quartiles per cluster label."""
    r = kept_records(spark, sf_dir, ["l_returnflag", *VARS, TARGET])
    out = G.cluster_profile(r, VARS, TARGET, "l_returnflag", method="distributed")
    return round_doubles(out, 4, skip=("pct",))


@query("profile_assembly", RECORDS_SQL + f"""
  , o AS (SELECT quantile_disc(l_extendedprice, 0.5) AS om FROM r)
  , g AS (SELECT l_returnflag, count(*) AS n, {rsql('avg(l_quantity)', 4)} AS l_quantity_mean,
                 {rsql('quantile_disc(l_extendedprice, 0.5) / any_value(om)', 6)} AS ratio FROM r, o GROUP BY l_returnflag)
  , c AS (SELECT l_returnflag, o_orderpriority AS category, count(*) AS cn FROM r GROUP BY ALL)
  , p AS (SELECT l_returnflag, category, {sround('100.0 * cn / sum(cn) OVER (PARTITION BY l_returnflag)', 2)} AS pct FROM c)
  , k AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY pct DESC,
                 try_cast(category AS DOUBLE) NULLS LAST, category) AS rn FROM p)
  SELECT g.l_returnflag, g.n, g.l_quantity_mean, g.ratio, k.category AS dominant, k.pct AS dominant_pct
  FROM g JOIN k ON g.l_returnflag = k.l_returnflag AND k.rn = 1""")
def q_profile_assembly(spark, sf_dir):
    """Profile table assembled from cluster-keyed parts (size, mean, median ratio, dominant category)."""
    r = kept_records(spark, sf_dir, ["l_returnflag", "o_orderpriority", "l_quantity", TARGET])
    prof = G.cluster_profile(r, ["l_quantity"], TARGET, "l_returnflag").select(
        "l_returnflag", "n", (F.round(F.col("l_quantity_mean") * 1e4, 0) / 1e4).alias("l_quantity_mean"))
    ratio = X.median_ratio(r, "l_returnflag", TARGET).select(
        "l_returnflag", (F.round(F.col("ratio") * 1e6, 0) / 1e6).alias("ratio"))
    dom = G.dominant(G.composition_long(r, "o_orderpriority", "l_returnflag"), "l_returnflag").select(
        "l_returnflag", F.col("category").alias("dominant"), F.col("pct").alias("dominant_pct"))
    return prof.join(ratio, "l_returnflag").join(dom, "l_returnflag")
