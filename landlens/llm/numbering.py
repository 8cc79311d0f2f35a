"""Row numbers inside groups of any size, without a window over a whole group (DataFrame operations only).

Rows are range-partitioned and sorted by (group, order), numbered inside their
partition and written to the shared folder.  A run is what one partition holds of
one group; a window over the runs of a group (at most one a partition) says how
many rows come before each run.  A group that holds a third of all rows is spread
over a third of the partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: ``monotonically_increasing_id`` is the partition's number times 2^33 plus the row's number in it.
_PART_BITS = 33


def write_ordered(rows: DataFrame, group: Sequence[str], order: Sequence[str], path: str) -> DataFrame:
    """Writes ``rows`` in (group, order), nulls last, with the columns part and at (place in part); returns what was written."""
    keys = [F.col(c).asc_nulls_last() for c in (*group, *order)]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    placed = placed.withColumn("part", F.shiftright("at", _PART_BITS)).withColumn("at", F.col("at").bitwiseAND(F.lit((1 << _PART_BITS) - 1)))
    placed.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def runs(ordered: DataFrame, group: Sequence[str]) -> DataFrame:
    """part, the group's columns and shift: a row's number in its group, from 1, is ``at`` + ``shift``."""
    found = ordered.groupBy("part", *group).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    return found.select("part", *group, (before - F.col("first") + 1).alias("shift"))


def same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Null-safe equality of the named columns of two aliased frames."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out
