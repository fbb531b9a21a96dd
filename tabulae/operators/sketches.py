"""Quantile sketches kept per period and merged, so that a new period reads itself alone.

A stored row is (period, group, column): the count and a KLL sketch of the column's values.
Merged sketches bracket the ranks of a quantile over all periods, as the first pass of
``quantiles`` does, and the values inside the brackets are then counted: exact quantiles whose
first scan is of a few kilobytes a group and period.  Approximate ones need no scan at all.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulae.operators.quantiles import bracketed, grid_of, value_stream

#: Size parameter of a sketch; its rank error is below MARGIN, with a probability of over 0.99 for one rank.
K, MARGIN = 4096, 0.0015


def period_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), period: str = "period", k: int = K) -> DataFrame:
    """Rows (period, *by, _pos, _n, _sketch) for column number ``_pos``; NULL values count for nothing."""
    return value_stream(df, columns, [period, *by]).groupBy(period, *by, "_pos").agg(
        F.count(F.lit(1)).alias("_n"), F.kll_sketch_agg_double("_v", k).alias("_sketch"))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stored sketches of any periods as one row (*by, _pos, _n, _sketch) per group and column."""
    return sketches.groupBy(*by, "_pos").agg(F.sum("_n").alias("_n"), F.kll_merge_agg_double("_sketch").alias("_sketch"))


def stored_quantiles(df: DataFrame, sketches: DataFrame, columns: Sequence[str], ps: Sequence[float], by: Sequence[str] = (),
                     interpolate: bool = False) -> DataFrame:
    """Exact quantiles (*by, variable, p, value) of the rows of which ``sketches`` are the stored sketches.

    A rank outside its bracket (a chance below 1 in 100) takes its whole group, as in ``quantiles``.  Groups
    without a value have no row.  ``sketches`` must be those of the same rows: counts that differ are not noticed.
    """
    ps = [float(p) for p in ps]
    at = F.array(*[F.lit(x) for x in grid_of(ps, MARGIN)])
    nothing = F.array_repeat(F.lit(float("nan")), len(grid_of(ps, MARGIN)))  # a sketch skips NaN, which comes after all numbers
    grid = F.when(F.kll_sketch_get_n_double("_sketch") > 0, F.kll_sketch_get_quantile_double("_sketch", at)).otherwise(nothing)
    stats = merged(sketches, by).select(*by, "_pos", "_n", grid.alias("_grid"))
    found = bracketed(df, columns, ps, by, interpolate, stats)
    return found.select(*by, F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_pos") + 1).alias("variable"),
                        F.element_at(F.array(*[F.lit(x) for x in ps]), F.col("_j") + 1).alias("p"), F.col("_q").alias("value"))


def approximate_quantiles(sketches: DataFrame, columns: Sequence[str], ps: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Rows (*by, variable, p, value) from the stored sketches alone; NaN values count for nothing."""
    ps = [float(p) for p in ps]
    values = F.kll_sketch_get_quantile_double("_sketch", F.array(*[F.lit(x) for x in ps]))
    pairs = F.arrays_zip(F.array(*[F.lit(x) for x in ps]).alias("p"), values.alias("value"))
    return merged(sketches, by).filter(F.kll_sketch_get_n_double("_sketch") > 0).select(*by, F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_pos") + 1).alias("variable"),
                                       F.inline(pairs))
