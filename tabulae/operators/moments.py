"""Means and co-moments of columns from one aggregate, per combination of codes.

A combination of codes (a cell) sends one partial row per map task, whatever the number of its
rows.  Co-moments are central (Spark merges them around the means), so large offsets such as
years don't cancel.  Statistics of any design over the cells follow by pooling.
"""
from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Cells that are pooled on the driver at most; dictionary-coded columns have far fewer combinations.
MOST_CELLS = 200_000


@dataclass(frozen=True)
class Cells:
    """Per cell: its codes, number of rows, means and population co-moments of the columns."""

    codes: list[tuple]
    n: np.ndarray
    means: np.ndarray
    moments: np.ndarray

    def pooled(self, values: np.ndarray | None = None) -> tuple[float, np.ndarray, np.ndarray]:
        """(rows, means, population covariances) of the columns, and before them of ``values``, one row of constants per cell."""
        fixed = np.empty((len(self.n), 0)) if values is None else values
        both = np.hstack([fixed, self.means])
        total = self.n.sum()
        mean = self.n @ both / total
        apart = both - mean
        cov = (apart * self.n[:, None]).T @ apart
        cov[fixed.shape[1]:, fixed.shape[1]:] += np.tensordot(self.n, self.moments, axes=1)
        return float(total), mean, cov / total


def cells(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> Cells:
    """Moments of ``columns`` in every combination of the codes ``by`` (NULL is a code of its own).

    Rows in which one of the columns is NULL or NaN are left out.  One scan, one shuffle of a row
    per cell and map task.  More than ``MOST_CELLS`` combinations are an error: such columns are keys,
    not codes.
    """
    rows = df.select(*[F.col(f"`{c}`").cast("string").alias(f"_c{i}") for i, c in enumerate(by)],
                     *[F.col(f"`{c}`").cast("double").alias(f"_x{i}") for i, c in enumerate(columns)])
    for i in range(len(columns)):
        rows = rows.filter(F.col(f"_x{i}").isNotNull() & ~F.isnan(f"_x{i}"))
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    found = rows.groupBy(*[f"_c{i}" for i in range(len(by))]).agg(
        F.count(F.lit(1)).alias("_n"), *[F.avg(f"_x{i}").alias(f"_m{i}") for i in range(len(columns))],
        *[F.covar_pop(f"_x{i}", f"_x{j}").alias(f"_s{i}_{j}") for i, j in pairs]).filter("_n > 0").limit(MOST_CELLS + 1).collect()
    if len(found) > MOST_CELLS:
        raise ValueError(f"{list(by)} have more than {MOST_CELLS} combinations of codes")
    found.sort(key=lambda r: [(r[f"_c{i}"] is None, r[f"_c{i}"] or "") for i in range(len(by))])
    moments = np.zeros((len(found), len(columns), len(columns)))
    for i, j in pairs:
        moments[:, i, j] = moments[:, j, i] = [r[f"_s{i}_{j}"] for r in found]
    means = np.array([[r[f"_m{i}"] for i in range(len(columns))] for r in found], dtype=float).reshape(len(found), len(columns))
    return Cells([tuple(r[f"_c{i}"] for i in range(len(by))) for r in found], np.array([r["_n"] for r in found], dtype=float), means, moments)


def principal_axes(df: DataFrame, columns: Sequence[str], k: int = 2, standardise: bool = True) -> list[dict]:
    """The first ``k`` principal axes of any number of columns (G9): ``explained``, ``centre``, ``scale`` and ``loadings``.

    Covariances come from one aggregate, eigenvectors from the driver.  An axis points to where its
    largest loading (the first of equal ones) is positive, so that the signs are fixed.  A column
    without spread has no loading.
    """
    found = cells(df, columns)
    if not len(found.n):
        raise ValueError("no rows without a NULL")
    n, mean, cov = found.pooled()
    deviation = np.sqrt(np.diag(cov) * n / max(1.0, n - 1.0))
    flat = deviation <= 1e-12 * np.abs(mean)  # rounding alone
    cov[flat, :] = cov[:, flat] = 0.0
    spread = np.where(flat, 1.0, deviation) if standardise else np.ones(len(columns))
    values, vectors = np.linalg.eigh(cov / np.outer(spread, spread))
    order = np.argsort(-values, kind="stable")[:k]
    out = []
    for i in order:
        axis = vectors[:, i]
        axis = axis * (1.0 if axis[np.argmax(np.round(np.abs(axis), 9))] >= 0 else -1.0)
        out.append({"explained": float(values[i] / values.sum()) if values.sum() > 0 else 0.0, "centre": mean.tolist(),
                    "scale": spread.tolist(), "loadings": axis.tolist()})
    return out


def project(df: DataFrame, columns: Sequence[str], axes: Sequence[dict], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and the coordinates ``pc1``, ``pc2``, ... on the given axes, as plain expressions; NULL where a column is."""
    def coordinate(axis: dict):
        terms = [(F.col(f"`{c}`").cast("double") - m) * (w / s) for c, m, s, w in zip(columns, axis["centre"], axis["scale"], axis["loadings"])]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        return total

    return df.select(*keep, *[coordinate(a).alias(f"pc{i + 1}") for i, a in enumerate(axes)])
