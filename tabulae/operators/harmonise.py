"""Harmonisation of text-typed extracts: header normalisation, required-column
projection, renaming + typing by kind, provenance columns, stacking by name
and header-drift audit."""
from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulae.functions import canonical_code, to_double, to_int


def normalise_name(name) -> str:
    """Header spelling used for matching: stripped and upper-cased."""
    return str(name).strip().upper()


def normalise_header(df: DataFrame) -> DataFrame:
    """Rename every column to its normalised spelling (no data is touched)."""
    return df.select(*[F.col(f"`{c}`").alias(normalise_name(c)) for c in df.columns])


def select_required(df: DataFrame, required: Sequence[str], source: str = "input") -> DataFrame:
    """Project the required columns by normalised name, whatever their position (S3).

    Raises ``ValueError`` naming the missing ones.  Column pruning then reaches
    the scan, so a 300-column extract is read as ``len(required)`` columns.
    """
    by_norm = {normalise_name(c): c for c in df.columns}
    missing = [c for c in required if normalise_name(c) not in by_norm]
    if missing:
        raise ValueError(f"{source} lacks the columns: {missing}")
    return df.select(*[F.col(f"`{by_norm[normalise_name(c)]}`").alias(normalise_name(c)) for c in required])


def harmonise(df: DataFrame, renames: Mapping[str, str] | None = None, doubles: Sequence[str] = (),
              ints: Sequence[str] = (), codes: Sequence[str] = ()) -> DataFrame:
    """Rename by dictionary, then type by kind in one projection.

    ``doubles`` / ``ints`` / ``codes`` name columns *after* renaming.  Text that
    does not parse becomes NULL (``try_cast``); ints truncate toward zero;
    codes get their canonical spelling.  Other columns pass through.
    """
    renames = dict(renames or {})
    kinds = {**{c: "d" for c in doubles}, **{c: "i" for c in ints}, **{c: "c" for c in codes}}
    out = []
    for c in df.columns:
        new = renames.get(c, c)
        x = F.col(f"`{c}`")
        kind = kinds.get(new)
        if kind == "d":
            x = to_double(x)
        elif kind == "i":
            x = to_int(x)
        elif kind == "c":
            x = canonical_code(x)
        out.append(x.alias(new))
    return df.select(*out)


def add_provenance(df: DataFrame, period: str, source: str, year: int | None = None,
                   quarter: int | None = None, prefix: str = "") -> DataFrame:
    """Provenance taken from the delivery, not from the data."""
    cols = [F.lit(period).alias(f"{prefix}period"), F.lit(source).alias(f"{prefix}source")]
    if year is not None:
        cols.append(F.lit(int(year)).cast("int").alias(f"{prefix}year"))
    if quarter is not None:
        cols.append(F.lit(int(quarter)).cast("int").alias(f"{prefix}quarter"))
    return df.select("*", *cols)


def provenance_from_files(df: DataFrame, period_of_file: Mapping[str, str]) -> DataFrame:
    """Provenance for a multi-file scan: the file name from ``_metadata`` mapped to its period.

    One scan covers every delivery; the map is a literal of one entry per file.
    """
    name = F.col("_metadata.file_name")
    lookup = F.create_map(*[F.lit(v) for kv in period_of_file.items() for v in kv])
    return df.select("*", F.try_element_at(lookup, name).alias("period"), name.alias("source"))


def stack_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack deliveries by column name, never by position; a missing column raises (O1)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), dfs)


def header_drift(spark: SparkSession, headers: Mapping[str, Sequence[str]], required: Sequence[str],
                 base: str | None = None) -> DataFrame:
    """Header audit of several deliveries.

    Per delivery: number of columns, how many required columns sit at another
    position than in ``base``, whether all required are present, and the extra
    columns.  Works on the (small) header lists, never on the data.
    """
    base = base or next(iter(headers))
    rows = [(name, i, normalise_name(c)) for name, cols in headers.items() for i, c in enumerate(cols)]
    h = spark.createDataFrame(rows, "delivery string, pos int, col string")
    req = [normalise_name(c) for c in required]
    ref = h.filter(F.col("delivery") == base).select("col", F.col("pos").alias("base_pos"))
    j = h.join(ref, "col", "left")
    return (j.groupBy("delivery").agg(
                F.count(F.lit(1)).alias("columns"),
                F.sum(((F.col("pos") != F.col("base_pos")) & F.col("col").isin(req)).cast("int")).alias("moved_required"),
                (F.sum(F.col("col").isin(req).cast("int")) == len(req)).alias("all_required"),
                F.array_sort(F.collect_list(F.when(~F.col("col").isin(req), F.col("col")))).alias("extra"))
             .orderBy("delivery"))
