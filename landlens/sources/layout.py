"""A stored layout for tables that many results group and join by one key.

Most results start with a group or a join by postal code, and each shuffles its table
for that.  A table bucketed by the key is shuffled once, when it is written: groups by
the key (and more columns) and joins on it then read bucket by bucket.

A bucket is one task, and unlike a shuffle it is not split when it is skewed.  So
:func:`write_bucketed` looks first how many rows the most frequent key has, and leaves
a table unbucketed in which that key alone would make a bucket ``LARGEST`` times the mean;
its results then shuffle as before, with partial aggregation and AQE's skew splitting.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Times the mean bucket that the rows of one key may make.
LARGEST = 4.0
#: With these a join on (key, year) takes inputs that are bucketed by the key alone.
BUCKETED_CONF = {"spark.sql.sources.bucketing.enabled": "true", "spark.sql.requireAllClusterKeysForCoPartition": "false"}
#: The key of each clean table.
POSTAL_KEYS = {"property_tax": "PROPERTY_POSTAL_CODE", "building_permits": "POSTAL_CODE", "business_licenses": "POSTAL_CODE"}


def hottest_share(df: DataFrame, key: str) -> float:
    """The share of all rows that the most frequent value of ``key`` has (0 for an empty table)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return row["most"] / row["all"] if row["all"] else 0.0


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> bool:
    """Writes ``df`` as the table ``table``, bucketed and sorted by ``key`` unless one key is too frequent; returns whether it is bucketed."""
    fits = hottest_share(df, key) * buckets <= LARGEST
    if fits:
        # one exchange by the key itself, so that a bucket is one file and not one for each task that writes
        df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    else:
        df.write.mode("overwrite").saveAsTable(table)
    return fits


def bucketed_tables(tables: Mapping[str, DataFrame], prefix: str, buckets: int) -> dict[str, DataFrame]:
    """The clean tables as stored tables ``<prefix>_<name>`` by postal code; tables without one as they are."""
    out = {}
    for name, df in tables.items():
        if name in POSTAL_KEYS:
            write_bucketed(df, f"{prefix}_{name}", POSTAL_KEYS[name], buckets)
            df = df.sparkSession.table(f"{prefix}_{name}")
        out[name] = df
    return out


@contextmanager
def bucketed_session(spark: SparkSession) -> Iterator[None]:
    """Plans made inside may use the buckets; the session's settings come back at the end."""
    before = {k: spark.conf.get(k, None) for k in BUCKETED_CONF}
    for k, v in BUCKETED_CONF.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
