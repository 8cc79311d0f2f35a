"""Classification of strings by ``IN`` lists (CASE ... WHEN ... IN ... ELSE)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def class_of(c: str | Column, classes: Mapping[str, Sequence[str]],
             default: str | None = None) -> Column:
    """First class whose list holds the value, else ``default``.

    ``classes`` is ordered: earlier classes win, as in a SQL ``CASE``.  A null
    input falls through to ``default`` (``NULL IN (...)`` is not true).
    """
    c = _col(c)
    expr = None
    for label, values in classes.items():
        cond = c.isin(list(values))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def indicator(c: str | Column, values: Sequence[str]) -> Column:
    """1 when the value is in ``values``, else 0 (null counts as 0)."""
    return F.when(_col(c).isin(list(values)), F.lit(1)).otherwise(F.lit(0))


def indicator_sum(c: str | Column, values: Sequence[str]) -> Column:
    """``SUM(CASE WHEN c IN (...) THEN 1 ELSE 0 END)`` as a BIGINT aggregate."""
    return F.sum(indicator(c, values).cast("bigint"))
