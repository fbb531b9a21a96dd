"""A regression tree of any depth, grown level by level from grouped sums.

Features are cut into bins once.  Rows with equal bins are one cell with their number and the sums
of the label, so that the data are read once and the levels work on cells.  A level sums the
cells by (node, feature, bin), accumulates the sums along the bins of a feature, and the cut with
the largest fall in squared error wins in its node: one shuffle of bins a level.  The driver holds
the tree.
"""
from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulae.operators.quantiles import quantile_table
from tabulae.sources.shared import written

MAX_BINS = 32
#: Falls in squared error per row below this share of the label's variance are rounding.
LEAST_GAIN = 1e-12


@dataclass(frozen=True)
class Node:
    """A node: rows, mean of the label, and for inner ones the cut (left is up to ``threshold``) and its gain."""

    number: int
    n: int
    mean: float
    feature: str | None = None
    threshold: float | None = None
    gain: float | None = None


def cut_points(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> dict[str, list[float]]:
    """Cuts between the bins of each feature: middles of neighbouring values, of quantiles where there are more values than bins."""
    out = {}
    for f in features:
        x = F.col(f"`{f}`").cast("double")
        some = sorted(r[0] for r in df.select(x.alias("x")).filter("x IS NOT NULL AND NOT isnan(x)").distinct().limit(max_bins + 1).collect())
        if len(some) > max_bins:
            table = quantile_table(df.select(x.alias("x")).filter("x IS NOT NULL AND NOT isnan(x)"), "x", [i / max_bins for i in range(1, max_bins + 1)])
            some = sorted(set(table.first()["_q"]))
        out[f] = [(a + b) / 2.0 for a, b in zip(some, some[1:])]
    return out


def _bin(x: Column, cuts: Sequence[float]) -> Column:
    """Number of cuts below a value, by halving; a value on a cut is left of it."""
    if not cuts:
        return F.lit(0)
    half = len(cuts) // 2
    return F.when(x <= F.lit(cuts[half]), _bin(x, cuts[:half])).otherwise(_bin(x, cuts[half + 1:]) + (half + 1))


def grow(df: DataFrame, features: Sequence[str], label: str, max_depth: int = 3, max_bins: int = MAX_BINS,
         cuts: Mapping[str, Sequence[float]] | None = None, min_rows: int = 1) -> list[Node]:
    """The nodes of the tree, the root is number 1, the children of i are 2 i (up to the threshold) and 2 i + 1.

    Of cuts with equal gain the first feature's lowest wins.  A node whose rows have one label, or
    without a cut that leaves ``min_rows`` on both sides, is a leaf.  Rows with a NULL or NaN feature
    or label are left out; an empty table gives no node.
    """
    cuts = {f: list(c) for f, c in (cuts or cut_points(df, features, max_bins)).items()}
    rows = df.select(F.col(f"`{label}`").cast("double").alias("_y"), *[F.col(f"`{f}`").cast("double").alias(f"_x{i}") for i, f in enumerate(features)])
    for c in rows.columns:
        rows = rows.filter(F.col(c).isNotNull() & ~F.isnan(c))
    bins = [f"_b{i}" for i in range(len(features))]
    cells = written(rows.select("_y", *[_bin(F.col(f"_x{i}"), cuts[f]).cast("int").alias(b) for i, (f, b) in enumerate(zip(features, bins))])
                    .groupBy(*bins).agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("s"), F.sum(F.col("_y") * F.col("_y")).alias("ss"))
                    .withColumn("node", F.lit(1)))
    nodes: dict[int, Node] = {}
    open_ = [1]
    for depth in range(max_depth + 1):
        here = cells.filter(F.col("node").isin(open_))
        totals = {r["node"]: r for r in here.groupBy("node").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).collect()}
        best = {r["node"]: r["best"] for r in _best_cuts(here, bins, min_rows).collect()} if depth < max_depth else {}
        if depth == 0:
            everything = max(0.0, (totals[1]["ss"] - totals[1]["s"] ** 2 / totals[1]["n"]) / totals[1]["n"]) if totals else 0.0
        splits = {}
        for number, r in sorted(totals.items()):
            cut = best.get(number)
            if cut is not None and cut["gain"] / r["n"] > LEAST_GAIN * everything:
                f = features[cut["feature"]]
                nodes[number] = Node(number, r["n"], r["s"] / r["n"], f, cuts[f][cut["bin"]], cut["gain"])
                splits[number] = (cut["feature"], cut["bin"])
            else:
                nodes[number] = Node(number, r["n"], r["s"] / r["n"])
        if not splits:
            break
        node = F.col("node")
        for number, (i, b) in splits.items():
            node = F.when(F.col("node") == number, F.when(F.col(bins[i]) <= b, 2 * number).otherwise(2 * number + 1)).otherwise(node)
        cells = written(cells.withColumn("node", node.cast("int")))
        open_ = [c for number in splits for c in (2 * number, 2 * number + 1)]
    return [nodes[k] for k in sorted(nodes)]


def _best_cuts(cells: DataFrame, bins: Sequence[str], min_rows: int) -> DataFrame:
    """(node, best): the cut of each node with the largest gain, as (gain, feature, bin)."""
    of = F.inline(F.array(*[F.struct(F.lit(i).alias("feature"), F.col(b).alias("bin")) for i, b in enumerate(bins)]))
    sums = cells.select("node", "n", "s", of).groupBy("node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    one = Window.partitionBy("node", "feature")
    along = one.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    left = sums.select("node", "feature", "bin", F.sum("n").over(along).alias("nl"), F.sum("s").over(along).alias("sl"),
                       F.sum("n").over(one).alias("n"), F.sum("s").over(one).alias("s"))
    nr, sr = F.col("n") - F.col("nl"), F.col("s") - F.col("sl")
    cut = left.filter((F.col("nl") >= min_rows) & (nr >= min_rows)).withColumn(
        "gain", F.col("sl") * F.col("sl") / F.col("nl") + sr * sr / nr - F.col("s") * F.col("s") / F.col("n"))
    order = F.struct("gain", -F.col("feature"), -F.col("bin"))
    return cut.groupBy("node").agg(F.max_by(F.struct("gain", "feature", "bin"), order).alias("best"))


def prediction(nodes: Sequence[Node]) -> Column:
    """The tree as an expression: the mean of the leaf; a NULL or NaN feature stops at its node."""
    of = {node.number: node for node in nodes}

    def value(number: int) -> Column:
        node = of[number]
        if node.feature is None:
            return F.lit(node.mean)
        x = F.col(f"`{node.feature}`").cast("double")
        return (F.when(x <= F.lit(node.threshold), value(2 * number))
                .when(x.isNotNull() & ~F.isnan(x), value(2 * number + 1)).otherwise(F.lit(node.mean)))

    return value(1)


def table(df: DataFrame, nodes: Sequence[Node]) -> DataFrame:
    """One row per node: number, feature and threshold (NULL for a leaf), rows, mean and gain."""
    rows = [(x.number, x.feature, x.threshold, x.n, x.mean, x.gain) for x in nodes]
    return df.sparkSession.createDataFrame(rows, "node int, feature string, threshold double, n long, mean double, gain double")
