"""KMeans from given centres as rounds of grouped sums, every k in the same rounds.

Rows with equal values are one row with a weight, so that a round reads each distinct row once.
A round assigns a row to the nearest centre of every k (distances are plain expressions over the
centres of the round before) and sums up weights and coordinates by (k, cluster): one row per
cluster and task is shuffled, and the driver holds the centres.  Silhouettes (squared Euclidean)
follow from the clusters' sums, one pass for all k.
"""
from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulae.operators.segment import with_reduction
from tabulae.sources.shared import written


@dataclass(frozen=True)
class Fit:
    """Centres in z units, sizes and squared distances of the clusters of one k."""

    centres: np.ndarray
    sizes: np.ndarray
    wssse: float
    silhouette: float


@dataclass(frozen=True)
class Fits:
    variables: list[str]
    mean: np.ndarray
    spread: np.ndarray
    of: dict[int, Fit]
    rounds: int


def spaced_centres(variables: Sequence[str], k: int) -> list[list[float]]:
    """``k`` starting centres in z units along the diagonal of the variables, from -1 to 1."""
    return [[-1.0 + 2.0 * (i + 0.5) / k] * len(variables) for i in range(k)]


def _assigned(rows: DataFrame, z: Sequence[str], centres: Mapping[int, np.ndarray], *more: str) -> DataFrame:
    """A row (k, c, d, weight, z ...) per row and k: its nearest centre, the first of equal ones, and the squared distance.

    The centres are one array literal, so that a round's plan is as small as its code whatever their number.
    """
    def listed(m: np.ndarray) -> str:
        return "array(" + ", ".join("array(" + ", ".join(f"{float(v)!r}D" for v in c) + ")" for c in m) + ")"

    each = F.expr("inline(array(" + ", ".join(f"struct({k} AS k, {listed(m)} AS centres)" for k, m in centres.items()) + "))")
    place = F.array(*z)

    def distance(centre: Column) -> Column:
        return F.aggregate(F.zip_with(place, centre, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, x: t + x)

    apart = rows.select("weight", *z, *more, each).select("weight", *z, *more, "k", F.transform("centres", distance).alias("apart"))
    least = apart.select("weight", *z, *more, "k", "apart", F.array_min("apart").alias("d"))
    return least.select("weight", *z, *more, "k", (F.array_position("apart", F.col("d")) - 1).cast("int").alias("c"), "d")


def fit(df: DataFrame, variables: Sequence[str], starts: Mapping[int, Sequence[Sequence[float]]], rounds: int = 50,
        tolerance: float = 1e-4) -> Fits:
    """Lloyd's rounds for every k of ``starts`` (centres in z units) on variables scaled to mean 0 and sample deviation 1.

    Stops when no centre of any k moved by more than ``tolerance``, or after ``rounds``.  A cluster that
    loses all rows keeps its centre.  Rows with a NULL or NaN variable are left out; an empty table is
    an error.
    """
    values = df.select(*[F.col(f"`{v}`").cast("double").alias(f"_x{i}") for i, v in enumerate(variables)])
    for i in range(len(variables)):
        values = values.filter(F.col(f"_x{i}").isNotNull() & ~F.isnan(f"_x{i}"))
    raw = [f"_x{i}" for i in range(len(variables))]
    distinct = written(values.groupBy(*raw).agg(F.count(F.lit(1)).alias("weight")))
    w = F.col("weight")
    first = distinct.agg(F.sum(w).alias("n"), *[(F.sum(w * F.col(c)) / F.sum(w)).alias(c) for c in raw]).first()
    if not first["n"]:
        raise ValueError("no rows to cluster")
    n, mean = float(first["n"]), np.array([first[c] for c in raw])
    second = distinct.agg(*[F.sum(w * (F.col(c) - float(m)) * (F.col(c) - float(m))).alias(c) for c, m in zip(raw, mean)]).first()
    spread = np.sqrt(np.array([second[c] for c in raw]) / max(1.0, n - 1.0))
    z = [f"_z{i}" for i in range(len(variables))]
    scaled = distinct.select("weight", *[((F.col(c) - float(m)) / float(s) if s > 0 else F.lit(0.0)).alias(to)
                                         for c, m, s, to in zip(raw, mean, spread, z)])
    centres = {int(k): np.array(c, dtype=float) for k, c in starts.items()}
    done = 0
    while done < rounds:
        done += 1
        sums = _assigned(scaled, z, centres).groupBy("k", "c").agg(
            F.sum("weight").alias("n"), *[(F.sum(F.col("weight") * F.col(c)) / F.sum("weight")).alias(c) for c in z]).collect()
        after = {k: m.copy() for k, m in centres.items()}
        for r in sums:
            after[r["k"]][r["c"]] = [r[c] for c in z]
        moved = max(float(np.sqrt(((after[k] - centres[k]) ** 2).sum(axis=1)).max()) for k in centres)
        centres = after
        if moved <= tolerance:
            break
    return Fits(list(variables), mean, spread, _measured(scaled, z, centres), done)


def _measured(scaled: DataFrame, z: Sequence[str], centres: Mapping[int, np.ndarray]) -> dict[int, Fit]:
    """Sizes, squared distances and silhouette of every k at its centres."""
    norm = sum((F.col(c) * F.col(c) for c in z), F.lit(0.0))
    with_norm = scaled.withColumn("_norm", norm)
    sums = _assigned(with_norm, z, centres, "_norm").groupBy("k", "c").agg(
        F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("d")).alias("ss"), F.sum(F.col("weight") * F.col("_norm")).alias("psi"),
        *[F.sum(F.col("weight") * F.col(c)).alias(c) for c in z]).collect()
    by: dict[int, dict[int, object]] = {k: {} for k in centres}
    for r in sums:
        by[r["k"]][r["c"]] = r
    # mean squared distance of a row to all of a cluster: its norm, the cluster's mean norm, less twice the product with its mean
    rows = _assigned(with_norm, z, centres, "_norm")
    score = F.lit(None).cast("double")
    for k, found in by.items():
        far = {c: F.col("_norm") + F.lit(float(r["psi"] / r["n"])) - 2.0 * sum((F.col(x) * F.lit(float(r[x] / r["n"])) for x in z), F.lit(0.0))
               for c, r in found.items()}
        one = F.lit(0.0)
        for c, r in found.items():
            others = [d for o, d in far.items() if o != c]
            if r["n"] > 1 and others:
                a = far[c] * F.lit(r["n"] / (r["n"] - 1.0))
                b = others[0] if len(others) == 1 else F.least(*others)
                s = F.when(a < b, 1.0 - a / b).when(a > b, b / a - 1.0).otherwise(0.0)
                one = F.when(F.col("c") == c, s).otherwise(one)
        score = F.when(F.col("k") == k, one).otherwise(score)
    silhouettes = {r["k"]: r["s"] for r in rows.select("k", "weight", score.alias("s")).groupBy("k").agg(
        (F.sum(F.col("weight") * F.col("s")) / F.sum("weight")).alias("s")).collect()}
    out = {}
    for k, m in centres.items():
        sizes = np.array([by[k][c]["n"] if c in by[k] else 0 for c in range(len(m))], dtype=np.int64)
        out[k] = Fit(m, sizes, float(sum(r["ss"] for r in by[k].values())), float(silhouettes[k]))
    return out


def grid_table(df: DataFrame, fits: Fits) -> DataFrame:
    """The table of ``segment.evaluate_k`` (G2): per k silhouette, WSSSE, sizes, smallest and largest share, reduction."""
    rows = [(k, f.silhouette, f.wssse, 100.0 * f.sizes.min() / f.sizes.sum(), 100.0 * f.sizes.max() / f.sizes.sum(), f.sizes.tolist())
            for k, f in sorted(fits.of.items())]
    table = df.sparkSession.createDataFrame([(k, s, w, float(a), float(b), c) for k, s, w, a, b, c in rows],
                                            "k int, silhouette double, wssse double, smallest_pct double, largest_pct double, sizes array<bigint>")
    return with_reduction(table)


def centre_table(df: DataFrame, fits: Fits, k: int) -> DataFrame:
    """Centres of one k in z units and in the variables' own."""
    z = fits.of[k].centres
    own = z * fits.spread + fits.mean
    schema = ", ".join(["cluster int", *[f"`{v}_z` double" for v in fits.variables], *[f"`{v}` double" for v in fits.variables]])
    return df.sparkSession.createDataFrame([(i, *a, *b) for i, (a, b) in enumerate(zip(z.tolist(), own.tolist()))], schema)


def contrast(df: DataFrame, specs: Mapping[str, Fits], chosen: Mapping[str, int], z_variable: str) -> DataFrame:
    """Variable sets side by side (G11): chosen k, its silhouette and smallest share, range of one variable's centres in z units."""
    rows = []
    for name, fits in specs.items():
        k, at = chosen[name], fits.variables.index(z_variable)
        f = fits.of[k]
        rows.append((name, k, f.silhouette, float(100.0 * f.sizes.min() / f.sizes.sum()), float(np.ptp(f.centres[:, at]))))
    return df.sparkSession.createDataFrame(rows, "spec string, k int, silhouette double, smallest_pct double, z_range double")
