"""Type conformance that tolerates bad values (null instead of a failed job).

Spark 4 runs with ANSI on, where ``cast('abc' AS date)`` raises; the cleaning
jobs expect a null.  ``try_cast`` gives that.  Text to integer goes through a
decimal so that ``'3.9999999'`` becomes 3 (truncation, as a non-ANSI cast did)
and not null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def to_int(c: Column, source_type: T.DataType | None = None,
           target: T.DataType = T.IntegerType()) -> Column:
    """Integer cast that truncates fractional text and nulls bad or overflowing text."""
    if source_type is not None and not isinstance(source_type, T.StringType):
        return c.try_cast(target)
    # as many fraction digits as 38 leave beside the target's own, then the whole
    # part taken in decimals: neither step can round a value to the next integer
    whole = 19 if isinstance(target, T.LongType) else 10
    d = c.try_cast(T.DecimalType(38, 38 - whole))
    return F.when(d < 0, F.ceil(d)).otherwise(F.floor(d)).try_cast(target)


def conform_column(c: Column, target: T.DataType,
                   source_type: T.DataType | None = None) -> Column:
    """Cast one column to its contract type; bad values become null."""
    if source_type is not None and source_type == target:
        return c
    if isinstance(target, _INTEGRAL):
        return to_int(c, source_type, target)
    return c.try_cast(target)
