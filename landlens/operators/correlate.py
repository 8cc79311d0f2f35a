"""Cross-year correlation (W2, J8, A10, M1) — rewrite R4.

The source computes, for every pair of years A <= B, the Pearson correlation
between the investment column of the n-th row of year A and the land-value
column of the n-th row of year B (positional pairing; the shorter year bounds
it), in a nested loop over years.  Here:

1. ``positional_rank`` numbers rows within each year by an explicit order key
   (the source relied on file order).  It does *not* use a window partitioned
   by year (that would put a whole year into one task): rows are range-
   partitioned and sorted by (year, key), checkpointed (lineage cut, stable
   under task retry), and each row's rank is its position inside its
   partition plus the number of rows of the same year in earlier partitions,
   from a per-(year, partition) count table that is joined.
2. The rows of one rank, at most one a year, are gathered into one array, which
   gives the pairs of years that the rank has; every pair's moments are summed
   up partially before they are shuffled, so no pair row is shuffled and
   nothing is joined to itself.  The years come out of the data; none is named
   in the plan.
3. A row is in two segments: 'both' and its own ('residential' or 'non-residential').
   ``segment_ranks`` numbers it in both at once: the rows of a range partition are
   sorted and numbered by key, then sorted and numbered by (segment, key), two
   local sorts of one exchange.  So every row is shuffled and checkpointed once, and is
   doubled only on its way into the next aggregate.

The checkpoint is the only job that runs while a plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landlens.functions.numeric import safe_corr
from landlens.operators.clean import segment_tag
from landlens.session import checkpoint_dir, default_parallelism


def positional_rank(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
                    rank_col: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """``row_number()`` within ``partition_cols`` by ``order_cols``, computed
    without gathering any partition group into a single task."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    p = num_partitions or default_parallelism(spark)
    # a row hash ends the key so that many rows tied on the order key can still
    # be split across range partitions (ties are numbered in hash order)
    keys = [*partition_cols, *order_cols, F.xxhash64(*[F.col(c) for c in df.columns])]
    s = (df.repartitionByRange(p, *keys).sortWithinPartitions(*keys)
         .withColumn("__pid", F.spark_partition_id())
         .withColumn("__idx", F.monotonically_increasing_id()))
    s = s.checkpoint(eager=True)
    stats = s.groupBy(*partition_cols, "__pid").agg(F.min("__idx").alias("__first"),
                                                    F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*partition_cols).orderBy("__pid") \
        .rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.select(*[F.col(c).alias(f"__k_{c}") for c in partition_cols],
                         F.col("__pid").alias("__k_pid"), "__first",
                         F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    cond = reduce(lambda a, b: a & b,
                  [s[c].eqNullSafe(stats[f"__k_{c}"]) for c in partition_cols]
                  + [s["__pid"] == stats["__k_pid"]])
    j = s.join(stats, cond)
    out = j.withColumn(rank_col, (F.col("__offset") + F.col("__idx") - F.col("__first") + 1).cast("bigint"))
    return out.drop("__pid", "__idx", "__first", "__offset", "__k_pid",
                    *[f"__k_{c}" for c in partition_cols])


def segment_ranks(df: DataFrame, year_col: str, order_cols: Sequence[str], segment_col: str, num_partitions: int | None = None) -> DataFrame:
    """W2 for two groupings in one pass: adds ``rn_all``, the row's number within its year, and ``rn_own``, its number
    among the year's rows of its segment, both by ``order_cols``."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    p = num_partitions or default_parallelism(spark)
    keys = [year_col, *order_cols, F.xxhash64(*[F.col(c) for c in df.columns])]  # tied rows can be split, as in positional_rank
    s = df.repartitionByRange(p, *keys).sortWithinPartitions(*keys).withColumn("__all", F.monotonically_increasing_id())
    s = s.sortWithinPartitions(year_col, segment_col, "__all").withColumn("__own", F.monotonically_increasing_id())
    s = s.withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True)

    def numbered(rows: DataFrame, group: list[str], idx: str, rank: str) -> DataFrame:
        before = Window.partitionBy(*group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
        runs = rows.groupBy("__pid", *group).agg(F.min(idx).alias("__first"), F.count(F.lit(1)).alias("__n"))
        runs = runs.withColumn("__shift", F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1)
        runs = runs.select(*[F.col(c).alias(f"__k{c}") for c in ("__pid", *group)], "__shift")
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__k{c}")) for c in ("__pid", *group)])
        return rows.join(runs, same).withColumn(rank, (F.col(idx) + F.col("__shift")).cast("bigint")).select(*rows.columns, rank)

    out = numbered(s, [year_col], "__all", "rn_all")
    return numbered(out, [year_col, segment_col], "__own", "rn_own").drop("__all", "__own", "__pid")


def rank_pair_correlation(df: DataFrame, year_col: str = "year", order_col: str = "postal_code",
                          x_col: str = "total_project_value", y_col: str = "total_land_value",
                          segment_col: str | None = "property_use",
                          segment_value: str = "residential",
                          segments: Sequence[str] | None = None,
                          digits: int | None = None, strategy: str = "gather") -> DataFrame:
    """A10 (+ C13, J8): long table ``(segment, investment_year, value_year, n_pairs, corr)``.

    ``corr`` is NULL for fewer than two complete pairs or zero variance.
    Rows with a null in x or y still count for their rank (as in the
    source's positional pairing) but drop out of the correlation.

    ``strategy='gather'`` (default): one array per (segment, rank) holding each
    year's x and y, exploded to the pairs of years A <= B and aggregated.
    ``strategy='join'``: equi join of the ranked rows with themselves on
    (segment, rank) — same result, kept for comparison.
    """
    base = df.where(F.col(year_col).isNotNull()).select(
        F.col(year_col).cast("int").alias("__year"), F.col(order_col).alias("__ord"),
        F.col(x_col).cast("double").alias("__x"), F.col(y_col).cast("double").alias("__y"),
        *([F.col(segment_col).alias("__segcol")] if segment_col else []))
    if segment_col:
        own = segment_tag("__segcol", segment_value)[1]
        ranked = segment_ranks(base.withColumn("__seg", own).drop("__segcol"), "__year", ["__ord"], "__seg")
        places = F.array(F.struct(F.lit("both").alias("segment"), F.col("rn_all").alias("rn")), F.struct(F.col("__seg").alias("segment"), F.col("rn_own").alias("rn")))
        ranked = ranked.select("__year", "__x", "__y", F.inline(places)).withColumnRenamed("rn", "__rn")
    else:
        ranked = positional_rank(base, ["__year"], ["__ord"], rank_col="__rn").withColumn("segment", F.lit("both"))
    if segments is not None:
        ranked = ranked.where(F.col("segment").isin(list(segments)))
    if strategy == "join":
        xs = ranked.select("segment", F.col("__year").alias("investment_year"), "__rn", "__x")
        ys = ranked.select("segment", F.col("__year").alias("value_year"), "__rn", "__y")
        pairs = xs.join(ys, ["segment", "__rn"]).where(F.col("value_year") >= F.col("investment_year"))
    elif strategy == "gather":
        years = ranked.groupBy("segment", "__rn").agg(
            F.collect_list(F.struct("__year", "__x", "__y")).alias("__v"))     # one entry a year
        first = years.select("segment", "__v", F.explode("__v").alias("__a"))
        pairs = first.select("segment", "__a", F.explode("__v").alias("__b")) \
            .where(F.col("__b.__year") >= F.col("__a.__year")) \
            .select("segment", F.col("__a.__year").alias("investment_year"), F.col("__b.__year").alias("value_year"),
                    F.col("__a.__x").alias("__x"), F.col("__b.__y").alias("__y"))
    else:
        raise ValueError(f"unknown correlation strategy {strategy!r}")
    ok = F.col("__x").isNotNull() & F.col("__y").isNotNull()
    corr = safe_corr(F.when(ok, F.col("__x")), F.when(ok, F.col("__y")))
    if digits is not None:
        corr = F.round(corr, digits)
    return (pairs.groupBy("segment", "investment_year", "value_year")
            .agg(F.count_if(ok).alias("n_pairs"), corr.alias("corr")))


def correlation_matrix(long: DataFrame, years: Sequence[int]) -> DataFrame:
    """M1: for each segment the upper-triangular year x year matrix; cells with value
    year < investment year (and years that the data lack) are null.

    ``years`` names the columns, so no job runs to discover them.
    """
    return (long.groupBy("segment", "investment_year").pivot("value_year", list(years))
            .agg(F.first("corr")))
