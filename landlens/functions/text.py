"""Text expressions: truncation, pattern extraction, point text, name normalisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncate(c: Column, n: int) -> Column:
    """Keep the first ``n`` characters; null stays null (``LEFT(c, n)``)."""
    return F.left(c, F.lit(n))


def extract_pattern(c: Column, pattern: str, group: int = 0) -> Column:
    """First match of ``pattern`` (whole match for group 0); ``''`` if none, null on null."""
    return F.regexp_extract(c, pattern, group)


def comma_count(s: Column) -> Column:
    """Number of commas: ``LENGTH(s) - LENGTH(REPLACE(s, ',', ''))``."""
    return F.length(s) - F.length(F.replace(s, F.lit(","), F.lit("")))


def point_part(s: Column, n: int) -> Column:
    """n-th (1-based) number of a ``"lat, lon"`` text; NULL unless exactly one comma.

    A part that is not a number becomes NULL instead of failing the query.
    """
    bad = s.isNull() | (comma_count(s) != 1)
    return F.when(bad, F.lit(None).cast("double")).otherwise(
        F.trim(F.split_part(s, F.lit(","), F.lit(n))).try_cast("double"))


def normalise_names(c: Column, names: Sequence[str], old: str = "-", new: str = " ") -> Column:
    """Replace ``old`` by ``new`` only in the listed spellings; other values pass through.

    Two sources spell some area names differently (hyphen vs space) while other
    names keep their hyphen in both, so the rewrite applies to a list only.
    """
    return F.when(c.isin(list(names)), F.replace(c, F.lit(old), F.lit(new))).otherwise(c)
