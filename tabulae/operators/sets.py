"""Set operations on periods and categories, and the leakage guard."""
from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulae.sources.shared import written


def split_periods(df: DataFrame, period: str, train: Sequence[str], valid: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Train / validation split by period (F4); a filter on a partition column prunes files."""
    return df.filter(F.col(period).isin(list(train))), df.filter(F.col(period).isin(list(valid)))


def periods_outside(df: DataFrame, period: str, allowed: Sequence[str]) -> DataFrame:
    """Distinct periods not in the allowed set, NULL included (O2 / F5 as a table)."""
    bad = ~F.coalesce(F.col(period).isin(list(allowed)), F.lit(False))
    return df.filter(bad).select(period).distinct()


def guard_periods(df: DataFrame, period: str, allowed: Sequence[str], what: str = "this set") -> None:
    """Raise ``ValueError`` when a period outside ``allowed`` is present.

    The message has the number of offending labels and up to 20 of them.
    """
    labels = written(periods_outside(df, period, allowed).select(F.coalesce(F.col(period).cast("string"), F.lit("NULL")).alias("label")))
    n = labels.count()
    if n:
        some = [r["label"] for r in labels.orderBy("label").limit(20).collect()]
        more = "" if n <= len(some) else f" and {n - len(some)} more"
        raise ValueError(f"{what} may only contain {sorted(allowed)}; found also {n}: {some}{more}")


def unseen_categories(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per categorical, the codes present in ``test`` and absent from ``train`` (O3).

    Both sides are unpivoted to (variable, code), de-duplicated and anti-joined:
    a distributed set difference, no driver-side sets.
    """
    def codes(df):
        arr = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("code")) for c in columns])
        return df.select(F.inline(arr)).distinct()
    return codes(test).join(codes(train), ["variable", "code"], "left_anti")


def unseen_summary(unseen: DataFrame) -> DataFrame:
    """Unseen codes collected per variable: for dictionary-coded columns, whose codes are few.

    Keys (customers, orders) stay in the long form of ``unseen_categories``.
    """
    return unseen.groupBy("variable").agg(F.array_sort(F.collect_set("code")).alias("codes"),
                                          F.count(F.lit(1)).alias("n_unseen"))


def periods_per_split(splits: Mapping[str, DataFrame], period: str) -> DataFrame:
    """Distinct sorted periods of each named set."""
    parts = [df.select(F.lit(name).alias("split"), F.col(period).cast("string").alias("period")).distinct()
             for name, df in splits.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("split").agg(F.array_sort(F.collect_set("period")).alias("periods"),
                                  F.count(F.lit(1)).alias("n_periods"))
