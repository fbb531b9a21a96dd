"""Column roles shared by every operator.

A ``TableSpec`` says which column plays which part (period, key, target,
numeric predictors, coded categoricals …) so that the operators stay generic:
the same funnel, duplicate audit or error breakdown runs on any table once the
roles are named.
"""
from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Mapping, Sequence

from pyspark.sql import Column


@dataclass(frozen=True, eq=False)
class TableSpec:
    """Roles of the columns of one microdata table.

    period        column holding the delivery / period label
    key           columns that identify a record (period usually included)
    target        numeric outcome used by descriptives, models and error tables
    numerics      numeric predictors / profile variables
    categoricals  coded categorical predictors
    codes         valid codes per categorical (anything else becomes ``unknown``)
    labels        code -> human label per categorical (fallback: the code)
    steps         ordered population predicates ``(name, Column)``
    train / valid / test  period labels of each split
    """

    period: str = "period"
    key: tuple[str, ...] = ()
    target: str = "target"
    numerics: tuple[str, ...] = ()
    categoricals: tuple[str, ...] = ()
    codes: Mapping[str, Sequence[str]] = field(default_factory=dict)
    labels: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    steps: tuple[tuple[str, Column], ...] = ()
    train: tuple[str, ...] = ()
    valid: tuple[str, ...] = ()
    test: tuple[str, ...] = ()
    unknown: str = "UNKNOWN"
    absent: str = "<ABSENT>"
    seed: int = 42

    def with_(self, **changes) -> "TableSpec":
        return replace(self, **changes)

    @property
    def development(self) -> tuple[str, ...]:
        return tuple(self.train) + tuple(self.valid)

    @property
    def predictors(self) -> tuple[str, ...]:
        return tuple(self.numerics) + tuple(self.categoricals)
