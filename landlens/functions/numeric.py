"""Numeric expressions: guarded percent change, year conversion, averages, correlation."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


_MONEY = T.DecimalType(38, 2)


def round_ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """``num / den`` of money values, rounded half away from zero once, as decimal(38, digits).

    Decided on the exact remainder, so no intermediate rounding can move a
    tie; NULL (never an error) for a zero or null operand pair or when the
    result does not fit into 38 digits.
    """
    n = num.try_cast(_MONEY)
    unit = F.try_multiply(den.try_cast(_MONEY), F.lit(Decimal(1).scaleb(-digits)))   # one step of the result
    rest = F.try_mod(n, unit)
    whole = F.try_divide(F.try_subtract(n, rest), unit).try_cast(T.DecimalType(36, 0))
    up = F.abs(rest) >= F.try_subtract(F.abs(unit), F.abs(rest))
    away = F.when((n < 0) == (unit < 0), F.lit(1)).otherwise(F.lit(-1)).cast(T.DecimalType(1, 0))
    steps = F.when(up, F.try_add(whole, away)).otherwise(whole)
    return F.try_multiply(steps, F.lit(Decimal(1).scaleb(-digits))).try_cast(T.DecimalType(38, digits))


def percent_change(base: Column, followup: Column, scale: int = 2) -> Column:
    """NULL when the base is 0, else ``ROUND((f - b) * 100.0 / b, scale)``, exactly rounded (see ``round_ratio``)."""
    b, f = base.try_cast(_MONEY), followup.try_cast(_MONEY)
    hundredfold = F.try_multiply(F.try_subtract(f, b), F.lit(Decimal(100)))
    return F.when(b == 0, F.lit(None)).otherwise(round_ratio(hundredfold, b, scale))


def two_digit_year(c: Column, century: int = 2000) -> Column:
    """``CAST(x AS INT) + 2000``: licence folder years are two digits."""
    return c.cast("int") + F.lit(century)


def finish_avg(total: Column, count: Column, as_double: bool = False,
               scale: int = 2) -> Column:
    """Average from an exact sum and a count.

    ``as_double=False`` keeps money semantics: a decimal rounded half up to
    ``scale`` digits, once (the warehouse kept the argument's scale).  With
    ``as_double=True`` the exact sum is divided as a double and not rounded,
    which is bit-for-bit reproducible by any engine that sums decimals exactly.
    """
    if as_double:
        return F.try_divide(total.cast("double"), count.cast("double"))
    return round_ratio(total, count, scale)


def share_percent(part: Column, other: Column, digits: int = 1) -> Column:
    """``ROUND(100 * part / (part + other), digits)``; NULL when both are 0."""
    a, b = part.cast("double"), other.cast("double")
    return F.round(F.try_divide(a * 100, a + b), digits)


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation that is NULL (not an error) for one pair or zero variance.

    Spark's ``corr`` raises DIVIDE_BY_ZERO under ANSI for a constant input;
    ``covar_pop / (stddev_pop * stddev_pop)`` with ``try_divide`` yields NULL.
    Rows with a null in x or y must be removed before (pairwise deletion).
    """
    denom = F.stddev_pop(x) * F.stddev_pop(y)
    return F.when(denom == 0, F.lit(None).cast("double")).otherwise(
        F.try_divide(F.covar_pop(x, y), denom))
