"""Exact quantiles without holding a group in one task, and approximate ones.

Spark's exact ``percentile`` keeps a value -> count map of a group's distinct values and merges
it in one task, which a hot group or a continuous measure of a large table does not survive.
``exact_quantiles`` gives the same values with bounded work per task, for several columns and
probabilities in one run:

1. one pass: per group and column the count and a quantile sketch, evaluated on a small grid
   around each requested probability.  The ends of the grid bracket the target rank, its inner
   points cut the bracket into slices;
2. one pass: rows are placed against the grid.  One aggregate by (group, placement, slice, value
   if inside a bracket) has the rows below each bracket and the candidates with their counts;
3. candidates are ranked inside their slice and moved on by the counts of the slices before.

The tables of steps 1 and 2 are written to the session's shared folder: every later use sees
one and the same grid, so a slice is a function of the value, and nothing depends on whether
Spark reuses an exchange.  A bracket that misses its rank (it doesn't under the sketch's
guarantee) takes its whole group instead.  Element quantile: the value at 1-based rank
``max(1, ceil(p * n))`` with the product in exact decimals; interpolated: position
``p * (n - 1)`` between its two neighbours.
"""
from __future__ import annotations

from decimal import Decimal
from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulae.sources.shared import written

EXACT, DISTRIBUTED, APPROX = "exact", "distributed", "approx"  # the first two are one method
METHODS = (EXACT, DISTRIBUTED, APPROX)
ACCURACY = 10000


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, where a NULL key equals a NULL key; the left side's keys stay."""
    other = right.select(*[F.col(f"`{k}`").alias(f"_r{i}") if k in keys else F.col(f"`{k}`")
                           for i, k in enumerate([*keys, *[c for c in right.columns if c not in keys]])])
    on = reduce(Column.__and__, [left[f"`{k}`"].eqNullSafe(other[f"_r{i}"]) for i, k in enumerate(keys)])
    out = left.join(other, on, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_r{i}" for i in range(len(keys))])


def exact_quantiles(df: DataFrame, value: str, ps: Sequence[float], by: Sequence[str] = (),
                    interpolate: bool = False, accuracy: int = ACCURACY) -> DataFrame:
    """Exact quantiles of one column: ``(*by, j, p, value)``, one row per group and probability."""
    ps = [float(p) for p in ps]
    p = F.element_at(F.array(*[F.lit(x) for x in ps]), F.col("_j") + 1)
    return _found(df, [value], ps, by, interpolate, accuracy).select(
        *by, F.col("_j").cast("int").alias("j"), p.alias("p"), F.col("_q").alias("value"))


def exact_arrays(df: DataFrame, values: Mapping[str, str], ps: Sequence[float], by: Sequence[str] = (),
                 interpolate: bool = False, accuracy: int = ACCURACY) -> DataFrame:
    """One row per group: ``by`` and, for each entry (name -> column) of ``values``, the array of the column's quantiles
    in the order of ``ps``; NULL if the group has no value.  Ungrouped: one row."""
    found = _found(df, list(values.values()), [float(p) for p in ps], by, interpolate, accuracy)

    def array_of(i: int) -> Column:
        # all probabilities of a group arrive together: a few values per column
        rows = F.array_sort(F.collect_list(F.when(F.col("_pos") == i, F.struct("_j", "_q"))))
        return F.when(F.size(rows) > 0, F.transform(rows, lambda r: r["_q"]))

    grouped = found.groupBy(*by) if by else found
    return grouped.agg(*[array_of(i).alias(name) for i, name in enumerate(values)])


def _found(df: DataFrame, columns: Sequence[str], ps: list[float], by: Sequence[str], interpolate: bool,
           accuracy: int) -> DataFrame:
    """Rows (*by, _pos, _j, _q): the quantile ``ps[_j]`` of column number ``_pos``."""
    stream = value_stream(df, columns, by)
    stats = written(stream.groupBy(*by, "_pos").agg(F.count(F.lit(1)).alias("_n"),
                                                    F.percentile_approx("_v", grid_of(ps, 5.0 / accuracy), accuracy).alias("_grid")))
    return _exact(stream, ps, by, interpolate, stats)


def value_stream(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (*by, _pos, _v): the values of column number ``_pos`` that are not NULL."""
    return df.select(*by, F.inline(F.array(*[F.struct(F.lit(i).alias("_pos"), F.col(f"`{c}`").cast("double").alias("_v"))
                                             for i, c in enumerate(columns)]))).filter("_v IS NOT NULL")


def _steps(ps: Sequence[float]) -> int:
    """Slices of a bracket."""
    return 8 if len(ps) <= 12 else 2


def grid_of(ps: Sequence[float], margin: float) -> list[float]:
    """The ranks at which a sketch is evaluated: ends and inner points of a bracket around every probability."""
    steps = _steps(ps)
    return [min(1.0, max(0.0, p + margin * (2.0 * k / steps - 1.0))) for p in ps for k in range(steps + 1)]


def bracketed(df: DataFrame, columns: Sequence[str], ps: list[float], by: Sequence[str], interpolate: bool, stats: DataFrame) -> DataFrame:
    """Rows (*by, _pos, _j, _q) of ``df`` from rows (*by, _pos, _n, _grid) of a sketch made before, evaluated at ``grid_of``."""
    return _exact(value_stream(df, columns, by), ps, by, interpolate, written(stats))


def _exact(stream: DataFrame, ps: list[float], by: Sequence[str], interpolate: bool, stats: DataFrame) -> DataFrame:
    n_ps, steps, keys = len(ps), _steps(ps), [*by, "_pos"]

    # rows below, inside and above the brackets; the candidates with their slices
    def ends(at: int) -> Column:
        return F.array_sort(F.array(*[F.col("_grid")[j * (steps + 1) + at] for j in range(n_ps)]))

    v = F.col("_v")
    placed = _same(stream, stats.select(*keys, F.array_sort("_grid").alias("_grid"), ends(0).alias("_lo"), ends(steps).alias("_hi")), keys)
    placed = placed.select(*keys, "_v", "_grid", F.size(F.filter("_lo", lambda x: x <= v)).alias("_from_below"),
                           F.size(F.filter("_hi", lambda x: x < v)).alias("_past"))
    inside = F.col("_past") < F.col("_from_below")
    cells = written(placed.groupBy(*keys, "_from_below", "_past", F.when(inside, F.size(F.filter("_grid", lambda x: x < v))).alias("_slice"),
                                   F.when(inside, v).alias("_cv")).agg(F.count(F.lit(1)).alias("_c")))

    # per probability: target ranks, and the rows below and inside its bracket
    each = F.explode(F.sequence(F.lit(0), F.lit(n_ps - 1))).alias("_j")
    n, p = F.col("_n"), F.element_at(F.array(*[F.lit(x) for x in ps]), F.col("_j") + 1)
    if interpolate:
        first, last = F.floor(p * (n - 1)) + 1, F.ceil(p * (n - 1)) + 1
    else:
        written_p = F.element_at(F.array(*[F.lit(f"{Decimal(repr(x)):.17f}").cast("decimal(18,17)") for x in ps]), F.col("_j") + 1)
        first = last = F.greatest(F.lit(1), F.ceil(written_p * n.cast("decimal(19,0)")))
    below = (cells.groupBy(*keys, "_from_below", "_past").agg(F.sum("_c").alias("_c")).select("*", each).groupBy(*keys, "_j")
             .agg(F.sum(F.when(F.col("_from_below") <= F.col("_j"), F.col("_c")).otherwise(0)).alias("_below"),
                  F.sum(F.when((F.col("_past") <= F.col("_j")) & (F.col("_j") < F.col("_from_below")), F.col("_c")).otherwise(0)).alias("_in")))
    target = _same(stats.select(*keys, "_n", each).select("*", first.cast("long").alias("_k1"), last.cast("long").alias("_k2")),
                   below, [*keys, "_j"])
    target = target.withColumn("_ok", (F.col("_below") < F.col("_k1")) & (F.col("_k2") <= F.col("_below") + F.col("_in")))
    candidates = cells.filter("_cv IS NOT NULL").select(
        *keys, F.col("_cv").alias("_v"), "_slice", "_c", F.explode(F.sequence(F.col("_past"), F.col("_from_below") - 1)).alias("_j"))
    missed = target.filter(~F.col("_ok"))
    if not missed.isEmpty():
        whole = _same(stream, stats.select(*keys), keys).select("*", each)
        whole = _same(whole, missed.select(*keys, "_j"), [*keys, "_j"], "left_semi").groupBy(*keys, "_j", "_v").agg(F.count(F.lit(1)).alias("_c"))
        candidates = _same(candidates, missed.select(*keys, "_j"), [*keys, "_j"], "left_anti").unionByName(
            whole.withColumn("_slice", F.lit(0)))
        target = target.withColumn("_below", F.when(F.col("_ok"), F.col("_below")).otherwise(F.lit(0)))

    # ranks: inside the slice, after the slices before it
    sizes = candidates.groupBy(*keys, "_j", "_slice").agg(F.sum("_c").alias("_size"))
    earlier = Window.partitionBy(*keys, "_j").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_j", "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    local = Window.partitionBy(*keys, "_j", "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = _same(candidates.withColumn("_upto", F.sum("_c").over(local)), offsets, [*keys, "_j", "_slice"])
    ranked = _same(ranked, target, [*keys, "_j"])
    end = F.col("_below") + F.col("_offset") + F.col("_upto")

    def at(rank: str) -> Column:
        return F.max(F.when((F.col(rank) <= end) & (F.col(rank) > end - F.col("_c")), v))

    picked = ranked.groupBy(*keys, "_j").agg(at("_k1").alias("_v1"), at("_k2").alias("_v2"), F.max("_n").alias("_n"))
    value = F.col("_v1")
    if interpolate:
        place = p * (n - 1)
        value = F.when(F.col("_v1") == F.col("_v2"), value).otherwise(
            (F.ceil(place) - place) * F.col("_v1") + (place - F.floor(place)) * F.col("_v2"))
        value = F.when(F.ceil(place) == F.floor(place), F.col("_v1")).otherwise(value)
    return picked.select(*keys, "_j", value.alias("_q"))


def _check(method: str) -> None:
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")


def grouped_quantiles(df: DataFrame, by: Sequence[str], aggs: Sequence[Column], values: Mapping[str, str], ps: Sequence[float],
                      interpolate: bool, method: str = EXACT, accuracy: int = ACCURACY) -> DataFrame:
    """One row per group: ``by``, the aggregates ``aggs`` and one array of quantiles per entry of ``values`` (name -> column).

    ``approx`` takes everything from one aggregate; ``exact`` joins the arrays of ``exact_arrays``.
    """
    _check(method)
    if method == APPROX:
        aggs = [*aggs, *[F.percentile_approx(F.col(f"`{c}`"), [float(p) for p in ps], accuracy).alias(name) for name, c in values.items()]]
    found = exact_arrays(df, values, ps, by, interpolate, accuracy) if method != APPROX else None
    if not aggs:
        return found
    base = (df.groupBy(*by) if by else df).agg(*aggs)
    if found is None:
        return base
    if by:
        return _same(base, found, list(by), "left")
    for name in values:  # one row on each side
        base = base.withColumn(name, found.select(name).scalar())
    return base


def quantile_table(df: DataFrame, value: str, ps: Sequence[float], by: Sequence[str] = (), interpolate: bool = False,
                   method: str = EXACT, accuracy: int = ACCURACY, name: str = "_q") -> DataFrame:
    """One row per group: ``(*by, name)`` with the quantiles of one column as an array in ``ps`` order."""
    return grouped_quantiles(df, by, [], {name: value}, ps, interpolate, method, accuracy)
