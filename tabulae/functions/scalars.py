"""Scalar column expressions (all JVM-side, ANSI-safe).

Spark 4 runs with ANSI mode on, so a bad text -> number cast raises instead of
returning NULL.  Every text conversion here goes through ``try_cast``.
"""
from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finite(c: ColumnOrName) -> Column:
    """True only for a value that is not NULL, not NaN and not +/-infinity."""
    # NaN sorts above infinity, so the comparison refuses it as well; NULL gives False
    return F.coalesce(F.abs(_col(c)) < F.lit(float("inf")), F.lit(False))


def to_double(c: ColumnOrName) -> Column:
    """Trimmed text -> double, NULL when it does not parse."""
    return F.trim(_col(c).cast("string")).try_cast("double")


def to_int(c: ColumnOrName) -> Column:
    """Trimmed text -> double -> int, truncating toward zero; NULL if it does not fit."""
    return to_double(c).try_cast("int")


_WHOLE = r"^([+-]?)0*([0-9]+?)(?:\.0*)?$"


def canonical_code(c: ColumnOrName) -> Column:
    """One spelling per code.

    Trimmed; empty -> NULL; a whole number -> its integer text (``'1'``, ``'1.0'``, ``' 1 '``,
    ``'+01'`` all give ``'1'``); anything else keeps its trimmed text.  Plain digits stay text
    all the way, so codes of any length keep every digit; only exponent forms such as ``1e3``
    are read as numbers, up to 2^53.
    """
    txt = F.trim(_col(c).cast("string"))
    digits = F.regexp_extract(txt, _WHOLE, 2)
    minus = (F.regexp_extract(txt, _WHOLE, 1) == "-") & (digits != "0")
    number = F.when(txt.rlike("^[+-]?[0-9.]+[eE][+-]?[0-9]+$"), txt.try_cast("double"))
    exact = (F.abs(number) <= F.lit(float(1 << 53))) & (number == F.rint(number))
    return (F.when(txt == "", None)
             .when(txt.rlike(_WHOLE), F.concat(F.when(minus, "-").otherwise(""), digits))
             .when(exact, number.cast("long").cast("string"))
             .otherwise(txt))


def compound_duration(major: ColumnOrName, minor: ColumnOrName, per: float = 12.0) -> Column:
    """``major + minor / per`` (years + months / 12); NULL when either part is (P5)."""
    return _col(major) + _col(minor) / F.lit(per)


def log10_positive(c: ColumnOrName) -> Column:
    """log10 of a strictly positive value, NULL otherwise."""
    x = _col(c)
    return F.when(x > 0, F.log10(x))


def pow10(c: ColumnOrName) -> Column:
    """Inverse of ``log10_positive``."""
    return F.pow(F.lit(10.0), _col(c))


def validate_code(c: ColumnOrName, valid: Sequence[str], unknown: str = "UNKNOWN") -> Column:
    """Keep a code found in the dictionary; absent or unrecognised -> ``unknown``."""
    x = _col(c)
    return F.when(x.isin(list(valid)), x).otherwise(F.lit(unknown))


def label_of(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Code -> label through a map literal, falling back to the code itself."""
    x = _col(c)
    if not mapping:
        return x.cast("string")
    lookup = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.coalesce(F.try_element_at(lookup, x.cast("string")), x.cast("string"))


def code_order(c: ColumnOrName) -> list[Column]:
    """Sort keys for codes: numeric codes by value, non-numeric after them (P10)."""
    x = _col(c)
    return [x.cast("string").try_cast("double").asc_nulls_last(), x.asc_nulls_last()]


def thousands(c: ColumnOrName) -> Column:
    """Number with thousands separators and no decimals (half-even, like ``{:,.0f}``)."""
    return F.format_number(F.bround(_col(c), 0), 0)


def band_label(lower: ColumnOrName, upper: ColumnOrName, prefix: str = "Q") -> Column:
    """``<= Q{upper}`` / ``Q{lower} - Q{upper}`` / ``> Q{lower}``.

    A NULL lower bound means the band is open below, a NULL upper bound open above.
    """
    lo, hi = _col(lower), _col(upper)
    p = F.lit(prefix)
    return (F.when(lo.isNull(), F.concat(F.lit("<= "), p, thousands(hi)))
             .when(hi.isNull(), F.concat(F.lit("> "), p, thousands(lo)))
             .otherwise(F.concat(p, thousands(lo), F.lit(" - "), p, thousands(hi))))


def level_word(z: ColumnOrName, low: str, high: str, threshold: float = 0.5) -> Column:
    """``high`` when z >= threshold, ``low`` when z <= -threshold, else '' (P14)."""
    x = _col(z)
    return (F.when(x >= threshold, F.lit(high))
             .when(x <= -threshold, F.lit(low))
             .otherwise(F.lit("")))


def profile_name(words: Sequence[Column], default: str = "Average profile") -> Column:
    """Join the non-empty level words with ', ' and capitalise the first letter."""
    joined = F.concat_ws(", ", F.array_compact(F.array(*[F.nullif(w, F.lit("")) for w in words])))
    capitalised = F.concat(F.upper(F.substring(joined, 1, 1)), F.lower(F.right(joined, F.length(joined) - 1)))
    return F.when(joined == "", F.lit(default)).otherwise(capitalised)


def correlation_strength(r: ColumnOrName, labels: Sequence[str] = (
        "negligible", "weak", "moderate", "strong")) -> Column:
    """|r| < .1, < .3, < .5, else."""
    a = F.abs(_col(r))
    return (F.when(a < 0.1, F.lit(labels[0])).when(a < 0.3, F.lit(labels[1]))
             .when(a < 0.5, F.lit(labels[2])).otherwise(F.lit(labels[3])))


def skew_verdict(s: ColumnOrName, labels: Sequence[str] = (
        "right-skewed", "left-skewed", "roughly symmetric")) -> Column:
    """> .5 right, < -.5 left, otherwise symmetric."""
    x = _col(s)
    return F.when(x > 0.5, F.lit(labels[0])).when(x < -0.5, F.lit(labels[1])).otherwise(F.lit(labels[2]))


def residual(actual: ColumnOrName, predicted: ColumnOrName) -> Column:
    """actual - predicted: positive means under-estimated."""
    return _col(actual) - _col(predicted)


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den, NULL when den is 0 (ANSI-safe)."""
    return F.try_divide(_col(num), _col(den))
