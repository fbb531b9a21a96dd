"""Generic validity rules: predicates that are False, never NULL, on absent or unusable values."""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabulae.functions.scalars import ColumnOrName, compound_duration, is_finite


def within(c: ColumnOrName, low: float | None = None, high: float | None = None, above: float | None = None) -> Column:
    """A finite number from ``low`` to ``high``, both included, and greater than ``above``; open where no bound is given."""
    x = F.col(c) if isinstance(c, str) else c
    ok = is_finite(x)
    for bound, holds in ((low, x >= F.lit(low)), (high, x <= F.lit(high)), (above, x > F.lit(above))):
        if bound is not None:
            ok = ok & holds
    return ok


def member(c: ColumnOrName, codes: Sequence[str]) -> Column:
    """One of the codes of a dictionary."""
    x = F.col(c) if isinstance(c, str) else c
    return F.coalesce(x.isin(list(codes)), F.lit(False))


def valid_duration(major: str, minor: str, limit: ColumnOrName | None = None, per: int = 12) -> Column:
    """A duration in two parts (F3): ``major`` >= 0, ``minor`` a whole number below ``per``, and the whole at most ``limit``."""
    whole = compound_duration(major, minor, float(per))
    ok = within(major, low=0) & within(minor, low=0, high=per - 1) & F.coalesce(F.col(minor) == F.floor(F.col(minor)), F.lit(False))
    if limit is not None:
        bound = F.col(limit) if isinstance(limit, str) else limit
        ok = ok & F.coalesce(whole <= bound, F.lit(False))
    return ok
