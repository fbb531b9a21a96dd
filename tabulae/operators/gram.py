"""Linear models of every penalty from one set of cross products.

The cross products of the design (numerics, a column per level of each code and one for NULL or
unseen codes) and the label are pooled from per-cell moments: one scan of the training rows.
Every penalty is then solved on the driver, on a matrix as wide as the design: normal equations
without an L1 part, coordinate descent with one.  The objective is that of ``LinearRegression``
with standardisation and intercept: half the mean squared error of the standardised label plus
the penalty, divided by the label's deviation, on standardised coefficients.
"""
from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulae.operators.evaluate import metrics_table
from tabulae.operators.features import UNSEEN
from tabulae.operators.moments import cells

GRID_SCHEMA = ("position int, config string, params map<string,double>, mae_train double, rmse_train double, r2_train double, "
               "mae_valid double, rmse_valid double, r2_valid double")


@dataclass(frozen=True)
class CrossProducts:
    """Means and covariances of the design's columns and, last, of the label."""

    numerics: list[str]
    levels: dict[str, list[str]]
    n: float
    mean: np.ndarray
    cov: np.ndarray

    @property
    def names(self) -> list[str]:
        return [*self.numerics, *[f"{c}={v}" for c, levels in self.levels.items() for v in [*levels, UNSEEN]]]


@dataclass(frozen=True)
class LinearFit:
    """Intercept and coefficients by name of the design's column."""

    design: CrossProducts
    intercept: float
    coefficients: np.ndarray

    def prediction(self) -> Column:
        """The prediction as an expression over the source columns; a NULL or unseen code takes its own coefficient."""
        weight = dict(zip(self.design.names, self.coefficients.tolist()))
        out = F.lit(self.intercept)
        for c in self.design.numerics:
            out = out + F.lit(weight[c]) * F.col(f"`{c}`").cast("double")
        for c, levels in self.design.levels.items():
            other = F.lit(weight[f"{c}={UNSEEN}"])
            if levels:
                known = F.create_map(*[F.lit(x) for v in levels for x in (v, weight[f"{c}={v}"])])
                other = F.coalesce(F.element_at(known, F.col(f"`{c}`").cast("string")), other)
            out = out + other
        return out

    def table(self) -> list[tuple[str, float]]:
        return [("(intercept)", self.intercept), *zip(self.design.names, self.coefficients.tolist())]


def cross_products(train: DataFrame, numerics: Sequence[str], categoricals: Sequence[str], label: str) -> CrossProducts:
    """All cross products of the design and the label from one aggregate.

    Levels stand by falling frequency, then by name, as the indexer orders them.  Rows with a
    NULL or NaN numeric or label are left out.
    """
    found = cells(train, [*numerics, label], categoricals)
    levels: dict[str, list[str]] = {}
    for i, c in enumerate(categoricals):
        count: dict[str, float] = {}
        for code, n in zip(found.codes, found.n):
            if code[i] is not None:
                count[code[i]] = count.get(code[i], 0.0) + n
        levels[c] = sorted(count, key=lambda v: (-count[v], v))
    flags = np.array([[float(code[i] == v) if v is not None else float(code[i] is None)
                       for i, c in enumerate(categoricals) for v in [*levels[c], None]] for code in found.codes], dtype=float)
    if not len(found.codes):
        raise ValueError("no training rows")
    flags = flags.reshape(len(found.codes), -1)
    n, mean, cov = found.pooled(flags)
    # numerics first, then the flags, the label last
    d, m = flags.shape[1], len(numerics)
    order = [*range(d, d + m), *range(d), d + m]
    return CrossProducts(list(numerics), levels, n, mean[order], cov[np.ix_(order, order)])


def solve(design: CrossProducts, reg_param: float = 0.0, elastic_net: float = 0.0, tolerance: float = 1e-13,
          max_rounds: int = 100_000) -> LinearFit:
    """The coefficients of one penalty.

    Columns without spread get 0.  Where the equations are singular (a column per level, no
    penalty) the shortest standardised solution is taken; its predictions are those of any other.
    """
    spread = np.sqrt(np.maximum(np.diag(design.cov), 0.0))
    label = spread[-1]
    scale = np.abs(design.mean[:-1]) + spread[:-1]
    use = np.flatnonzero(spread[:-1] > 1e-12 * np.where(scale > 0, scale, 1.0))
    weights = np.zeros(len(spread) - 1)
    if label > 0 and len(use):
        a = design.cov[np.ix_(use, use)] / np.outer(spread[use], spread[use])
        b = design.cov[use, -1] / (spread[use] * label)
        l1, l2 = elastic_net * reg_param / label, (1.0 - elastic_net) * reg_param / label
        if l1 == 0.0:
            z = np.linalg.lstsq(a + l2 * np.eye(len(use)), b, rcond=1e-10)[0]
        else:
            z, diagonal = np.zeros(len(use)), np.diag(a) + l2
            for _ in range(max_rounds):
                moved = 0.0
                for j in range(len(use)):
                    rest = b[j] - a[j] @ z + a[j, j] * z[j]
                    new = np.sign(rest) * max(abs(rest) - l1, 0.0) / diagonal[j]
                    moved, z[j] = max(moved, abs(new - z[j])), new
                if moved < tolerance:
                    break
        weights[use] = z * label / spread[use]
    return LinearFit(design, float(design.mean[-1] - weights @ design.mean[:-1]), weights)


def linear_grid(train: DataFrame, valid: DataFrame, numerics: Sequence[str], categoricals: Sequence[str], label: str,
                configs: Mapping[str, Mapping[str, float]]) -> tuple[DataFrame, dict[str, LinearFit]]:
    """``models.grid_search`` for linear models: the same table, from one scan for all fits and one per set for all metrics."""
    design = cross_products(train, numerics, categoricals, label)
    fits = {name: solve(design, **params) for name, params in configs.items()}

    def measured(df: DataFrame) -> dict:
        scored = df.select(F.col(f"`{label}`").alias("_y"), *[f.prediction().alias(f"_p{i}") for i, f in enumerate(fits.values())])
        return {r["model"]: r for r in metrics_table(scored, "_y", {name: f"_p{i}" for i, name in enumerate(fits)}).collect()}

    on_train, on_valid = measured(train), measured(valid)
    rows = [(i, name, {k: float(v) for k, v in params.items()}, *[on[name][m] for on in (on_train, on_valid) for m in ("mae", "rmse", "r2")])
            for i, (name, params) in enumerate(configs.items())]
    return train.sparkSession.createDataFrame(rows, GRID_SCHEMA), fits


def coefficient_table(fit: LinearFit, df: DataFrame) -> DataFrame:
    """Intercept first, then coefficients by falling size."""
    rows = [(name, int(i > 0), value) for i, (name, value) in enumerate(fit.table())]
    t = df.sparkSession.createDataFrame(rows, "variable string, _g int, coefficient double")
    return t.orderBy("_g", F.abs("coefficient").desc(), "variable").drop("_g")
