"""Models from sufficient statistics bound to the driver's tables: linear models of every penalty from
cross products, KMeans in rounds from given centres, a regression tree by levels, principal axes."""
from __future__ import annotations

from pyspark.sql import functions as F

from tabulae.operators import gram as GR
from tabulae.operators import lloyd as L
from tabulae.operators import moments as MO
from tabulae.operators import tree as TR
from tabulae.plans.explore_queries import RECORDS_SQL
from tabulae.plans.model_queries import LABEL, NUMERICS, _splits
from tabulae.plans.registry import query, rnd, round_doubles, rsql
from tabulae.plans.tables import records

KS = (2, 3, 4, 5)
ROUNDS = 15
DEPTH = 3
#: Penalties of the bound coefficients: (name, numerics, reg_param, elastic_net).
PENALTIES = [("ridge", ["l_quantity", "l_discount"], 1000.0, 0.0), ("lasso", ["l_quantity"], 5000.0, 1.0),
             ("elastic", ["l_quantity"], 2000.0, 0.5)]

_TRAIN_SQL = RECORDS_SQL + ", tr AS (SELECT * FROM r WHERE year BETWEEN 1995 AND 1999)\n"


# --------------------------------------------------------------------------- linear models

def _penalties_sql() -> str:
    """Ridge of two variables by Cramer's rule, one-variable penalties by their soft thresholds."""
    parts = [_TRAIN_SQL + """
, s AS (SELECT avg(l_quantity) AS mq, avg(l_discount) AS md, avg(l_extendedprice) AS my, stddev_pop(l_quantity) AS sq,
        stddev_pop(l_discount) AS sd, stddev_pop(l_extendedprice) AS sy, corr(l_quantity, l_discount) AS qd,
        corr(l_quantity, l_extendedprice) AS qy, corr(l_discount, l_extendedprice) AS dy FROM tr)"""]
    selects = []
    for name, numerics, reg, mix in PENALTIES:
        if len(numerics) == 2:
            parts.append(f", {name} AS (SELECT *, (qy * (1 + {reg} / sy) - qd * dy) / ((1 + {reg} / sy) * (1 + {reg} / sy) - qd * qd) * sy / sq AS b1, "
                         f"(dy * (1 + {reg} / sy) - qd * qy) / ((1 + {reg} / sy) * (1 + {reg} / sy) - qd * qd) * sy / sd AS b2 FROM s)")
        else:
            parts.append(f", {name} AS (SELECT *, sign(qy) * greatest(abs(qy) - {reg * mix} / sy, 0) / (1 + {reg * (1 - mix)} / sy) * sy / sq AS b1, "
                         f"0.0 AS b2 FROM s)")
        selects += [f"SELECT '{name}' AS config, '(intercept)' AS variable, {rsql('my - b1 * mq - b2 * md', 3)} AS coefficient FROM {name}",
                    f"SELECT '{name}', 'l_quantity', {rsql('b1', 3)} FROM {name}"]
        if len(numerics) == 2:
            selects.append(f"SELECT '{name}', 'l_discount', {rsql('b2', 3)} FROM {name}")
    return "\n".join(parts) + "\n" + " UNION ALL ".join(selects)


@query("penalised_coefficients", _penalties_sql())
def q_penalised_coefficients(spark, sf_dir):
    """Ridge, lasso and mixed coefficients, each solved from the cross products of the training records."""
    train, _, _ = _splits(spark, sf_dir)
    rows = []
    for name, numerics, reg, mix in PENALTIES:
        fit = GR.solve(GR.cross_products(train, numerics, [], LABEL), reg, mix)
        rows += [(name, variable, value) for variable, value in fit.table()]
    return round_doubles(spark.createDataFrame(rows, "config string, variable string, coefficient double"), 3)


@query("dummy_ols", _TRAIN_SQL + f"""
, g AS (SELECT l_returnflag, count(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice) AS my, covar_pop(l_quantity, l_extendedprice) AS cxy,
               var_pop(l_quantity) AS vx FROM tr GROUP BY 1)
, b AS (SELECT sum(n * cxy) / sum(n * vx) AS slope FROM g)
  SELECT l_orderkey, l_linenumber, {rsql('my + slope * (l_quantity - mx)', 2)} AS prediction
  FROM (SELECT * FROM r WHERE year = 2001) x JOIN g USING (l_returnflag), b""")
def q_dummy_ols(spark, sf_dir):
    """M1/M6: least squares on one numeric and a column per level of a code; within a level the line goes through its means."""
    train, _, test = _splits(spark, sf_dir)
    fit = GR.solve(GR.cross_products(train, ["l_quantity"], ["l_returnflag"], LABEL))
    return round_doubles(test.select("l_orderkey", "l_linenumber", fit.prediction().alias("prediction")), 2)


# --------------------------------------------------------------------------- segmentation

def _rounds_sql() -> str:
    """The rounds one after the other; a cluster without rows keeps its centre."""
    starts = ", ".join(f"({k}, {c}, {', '.join([repr(float(x)) for x in z])})"
                       for k in KS for c, z in enumerate(L.spaced_centres(NUMERICS, k)))
    parts = [RECORDS_SQL + """
, w AS MATERIALIZED (SELECT l_quantity AS a, l_discount AS b, l_tax AS c, count(*) AS w FROM r GROUP BY ALL)
, s AS (SELECT sum(w * a) / sum(w) AS ma, sum(w * b) / sum(w) AS mb, sum(w * c) / sum(w) AS mc, sum(w) AS n FROM w)
, v AS (SELECT sqrt(sum(w * (a - ma) * (a - ma)) / (any_value(n) - 1)) AS sa, sqrt(sum(w * (b - mb) * (b - mb)) / (any_value(n) - 1)) AS sb,
               sqrt(sum(w * (c - mc) * (c - mc)) / (any_value(n) - 1)) AS sc FROM w, s)
, z AS MATERIALIZED (SELECT row_number() OVER () AS i, w, (a - ma) / sa AS x, (b - mb) / sb AS y, (c - mc) / sc AS t FROM w, s, v)""",
             f", c0 AS MATERIALIZED (SELECT * FROM (VALUES {starts}) t(k, c, x, y, t))"]
    nearest = ("SELECT z.i, any_value(z.w) AS w, any_value(z.x) AS x, any_value(z.y) AS y, any_value(z.t) AS t, o.k, "
               "min(struct_pack(d := (z.x - o.x) * (z.x - o.x) + (z.y - o.y) * (z.y - o.y) + (z.t - o.t) * (z.t - o.t), c := o.c)) AS m "
               "FROM z, {0} o GROUP BY z.i, o.k")
    for i in range(1, ROUNDS + 1):
        parts.append(f", a{i} AS MATERIALIZED (SELECT k, m.c AS c, sum(w * x) / sum(w) AS x, sum(w * y) / sum(w) AS y, sum(w * t) / sum(w) AS t "
                     f"FROM ({nearest.format(f'c{i - 1}')}) GROUP BY k, m.c)")
        parts.append(f", c{i} AS MATERIALIZED (SELECT o.k, o.c, coalesce(n.x, o.x) AS x, coalesce(n.y, o.y) AS y, coalesce(n.t, o.t) AS t "
                     f"FROM c{i - 1} o LEFT JOIN a{i} n ON n.k = o.k AND n.c = o.c)")
    parts.append(f""", e AS MATERIALIZED ({nearest.format(f'c{ROUNDS}')})
, q AS MATERIALIZED (SELECT k, m.c AS c, sum(w) AS n, sum(w * m.d) AS ss, sum(w * (x * x + y * y + t * t)) AS psi, sum(w * x) AS x, sum(w * y) AS y,
       sum(w * t) AS t FROM e GROUP BY k, m.c)
, far AS (SELECT e.i, e.k, e.w, e.m.c AS own, q.c, q.n,
       e.x * e.x + e.y * e.y + e.t * e.t + q.psi / q.n - 2 * (e.x * q.x + e.y * q.y + e.t * q.t) / q.n AS d FROM e JOIN q ON q.k = e.k)
, ab AS (SELECT i, k, any_value(w) AS w, any_value(d * n / (n - 1)) FILTER (c = own) AS a, min(d) FILTER (c <> own) AS b FROM far GROUP BY i, k)
, sil AS (SELECT k, sum(w * CASE WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END) / sum(w) AS silhouette FROM ab GROUP BY k)
, g AS (SELECT k, sum(ss) AS wssse, 100.0 * min(n) / sum(n) AS smallest_pct, 100.0 * max(n) / sum(n) AS largest_pct,
        list(CAST(n AS BIGINT) ORDER BY c) AS sizes FROM q GROUP BY k)""")
    return "\n".join(parts)


def _fits(spark, sf_dir):
    return L.fit(records(spark, sf_dir), NUMERICS, {k: L.spaced_centres(NUMERICS, k) for k in KS}, ROUNDS, 0.0)


@query("kmeans_rounds", _rounds_sql() + f"""
  SELECT CAST(g.k AS INTEGER) AS k, {rsql('silhouette', 5)} AS silhouette, {rsql('wssse', 2)} AS wssse, {rsql('smallest_pct', 3)} AS smallest_pct,
         {rsql('largest_pct', 3)} AS largest_pct, sizes FROM g JOIN sil USING (k)""")
def q_kmeans_rounds(spark, sf_dir):
    """Every k from given centres, fifteen rounds: silhouette, WSSSE, sizes."""
    found = L.grid_table(records(spark, sf_dir), _fits(spark, sf_dir)).drop("wssse_reduction_pct")
    return found.select("k", rnd("silhouette", 5).alias("silhouette"), rnd("wssse", 2).alias("wssse"), rnd("smallest_pct", 3).alias("smallest_pct"),
                        rnd("largest_pct", 3).alias("largest_pct"), "sizes")


@query("kmeans_centres", _rounds_sql() + f"""
  SELECT CAST(c AS INTEGER) AS cluster, {rsql('x', 5)} AS l_quantity_z, {rsql('y', 5)} AS l_discount_z, {rsql('t', 5)} AS l_tax_z,
         {rsql('x * sa + ma', 4)} AS l_quantity, {rsql('y * sb + mb', 4)} AS l_discount, {rsql('t * sc + mc', 4)} AS l_tax
  FROM c{ROUNDS}, s, v WHERE k = 4""")
def q_kmeans_centres(spark, sf_dir):
    """The four centres of those rounds in z units and in the variables' own."""
    found = L.centre_table(records(spark, sf_dir), _fits(spark, sf_dir), 4)
    return found.select("cluster", *[rnd(f"{v}_z", 5).alias(f"{v}_z") for v in NUMERICS], *[rnd(v, 4).alias(v) for v in NUMERICS])


@query("pca_axes")
def q_pca_axes(spark, sf_dir):
    """All principal axes of the standardised measures, with fixed signs."""
    axes = MO.principal_axes(records(spark, sf_dir), NUMERICS, 3)
    rows = [(i + 1, a["explained"], *a["loadings"]) for i, a in enumerate(axes)]
    return round_doubles(spark.createDataFrame(rows, "component int, explained double, " + ", ".join(f"{v} double" for v in NUMERICS)), 6)


# --------------------------------------------------------------------------- tree

def _tree_sql() -> str:
    """Level by level: sums along the values of each feature, the best cut of each node, the rows of its children."""
    value = "CASE f WHEN 0 THEN l_quantity WHEN 1 THEN l_discount ELSE l_tax END"
    parts = [_TRAIN_SQL + f"""
, n0 AS MATERIALIZED (SELECT l_quantity, l_discount, l_tax, count(*) AS n, sum(l_extendedprice) AS s, 1 AS node FROM tr GROUP BY 1, 2, 3)
, mid AS MATERIALIZED (SELECT f, x, (x + lead(x) OVER (PARTITION BY f ORDER BY x)) / 2 AS threshold
                       FROM (SELECT DISTINCT f, {value} AS x FROM tr, (SELECT unnest([0, 1, 2]) AS f)))"""]
    for d in range(DEPTH):
        parts.append(f"""
, h{d} AS (SELECT node, f, {value} AS x, sum(n) AS n, sum(s) AS s FROM n{d}, (SELECT unnest([0, 1, 2]) AS f) GROUP BY 1, 2, 3)
, l{d} AS (SELECT node, f, x, sum(n) OVER o AS nl, sum(s) OVER o AS sl, sum(n) OVER p AS n, sum(s) OVER p AS s FROM h{d}
           WINDOW o AS (PARTITION BY node, f ORDER BY x), p AS (PARTITION BY node, f))
, b{d} AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, x) AS place
           FROM (SELECT *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain FROM l{d} WHERE nl < n))
, n{d + 1} AS MATERIALIZED (SELECT l_quantity, l_discount, l_tax, t.n, t.s,
           2 * t.node + CASE WHEN CASE b.f WHEN 0 THEN l_quantity WHEN 1 THEN l_discount ELSE l_tax END > b.x THEN 1 ELSE 0 END AS node
           FROM n{d} t JOIN b{d} b ON b.node = t.node AND b.place = 1)""")
    inner = " UNION ALL ".join(
        f"SELECT CAST(node AS INTEGER) AS node, CASE b.f WHEN 0 THEN 'l_quantity' WHEN 1 THEN 'l_discount' ELSE 'l_tax' END AS feature, "
        f"{rsql('threshold', 4)} AS threshold, CAST(n AS BIGINT) AS n, {rsql('s / n', 2)} AS mean FROM b{d} b JOIN mid ON mid.f = b.f AND mid.x = b.x WHERE place = 1"
        for d in range(DEPTH))
    leaves = f"SELECT CAST(node AS INTEGER), NULL, NULL, CAST(sum(n) AS BIGINT), {rsql('sum(s) / sum(n)', 2)} FROM n{DEPTH} GROUP BY node"
    return "\n".join(parts) + "\n" + inner + " UNION ALL " + leaves


@query("tree_depth3", _tree_sql())
def q_tree_depth3(spark, sf_dir):
    """M7: one unbagged tree of depth three on the measures: cuts, rows and means of its nodes."""
    train, _, _ = _splits(spark, sf_dir, [LABEL, *NUMERICS])
    nodes = TR.grow(train, NUMERICS, LABEL, DEPTH, max_bins=64)
    found = TR.table(train, nodes)
    return found.select("node", "feature", rnd("threshold", 4).alias("threshold"), "n", rnd("mean", 2).alias("mean"))


@query("tree_depth3_error", None)
def q_tree_depth3_error(spark, sf_dir):
    """Error of that tree and of the linear fit on the test year, scored in one pass."""
    from tabulae.operators.evaluate import metrics_table

    train, _, test = _splits(spark, sf_dir, [LABEL, *NUMERICS])
    nodes = TR.grow(train, NUMERICS, LABEL, DEPTH, max_bins=64)
    fit = GR.solve(GR.cross_products(train, NUMERICS, [], LABEL))
    scored = test.select(F.col(LABEL), TR.prediction(nodes).alias("tree"), fit.prediction().alias("linear"))
    return round_doubles(metrics_table(scored, LABEL, {"tree": "tree", "linear": "linear"}), 4)
