"""Registry of the bound queries: name -> (Spark builder, oracle SQL or None).

Rounding: both sides round a double ``x`` to ``d`` decimals as
``round(x * 10^d) / 10^d`` (half away from zero on the scaled value).  The
scaled double is bit-identical in the JVM and in DuckDB, so the two engines
agree on it even where ``round(x, d)`` would not (Spark rounds the shortest
decimal text of ``x``, DuckDB its binary value).
"""
from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
HEADLINE: list[str] = []


def query(name: str, sql: str | None = None, headline: bool = False):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        if headline:
            HEADLINE.append(name)
        return fn
    return deco


def rnd(c: Column | str, d: int = 4) -> Column:
    """Spark side of the shared rounding rule."""
    x = F.col(c) if isinstance(c, str) else c
    m = float(10 ** d)
    return F.round(x * F.lit(m), 0) / F.lit(m)


def rsql(expr: str, d: int = 4) -> str:
    """DuckDB side of the shared rounding rule."""
    return f"(round(({expr}) * {10 ** d}.0) / {10 ** d}.0)"


def round_doubles(df: DataFrame, d: int = 4, skip: tuple[str, ...] = ()) -> DataFrame:
    """Apply ``rnd`` to every double column of a result (for the oracle comparison)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float") and f.name not in skip:
            out.append(rnd(F.col(f.name).cast("double"), d).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def sround(expr: str, d: int = 2) -> str:
    """DuckDB emulation of Spark's ``round(x, d)`` (half-up on the shortest decimal text of x).

    Casting the double to a 12-decimal DECIMAL first recovers that text for any
    value with at most 12 decimals; DuckDB's own ``round`` works on the binary
    value and turns 1.005 into 1.0 where Spark gives 1.01.
    """
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38,12)), {d}) AS DOUBLE)"
