"""Aggregation through a many-to-many bridge (J3, J4, A4) — rewrite R1.

The source defines the postal->area bridge as ``tax JOIN permits ON postal``
with duplicates kept (V6), then joins tax to it again and aggregates by
(year, area) (V7).  Every tax row of postal ``p`` therefore counts
``w(p, a) = n(p) * m(p, a)`` times in area ``a``, where ``n`` is the number of
tax rows of ``p`` and ``m`` the number of permits of ``p`` in ``a``.  The naive
plan materialises ``sum_p n(p)^2 * m(p)`` rows (10^8 for one area-year in the
published figures) and Catalyst cannot push the aggregate below the joins.

The rewrite aggregates first and joins small frames:

* ``g``: tax grouped by (postal, year): sums, non-null counts, class counts
* ``n``: tax rows per postal, a window sum over ``g`` (no second scan)
* ``m``: permits grouped by (postal, area)
* ``w = n * m`` on postal; ``g JOIN w`` on postal; group by (year, area):
  ``AVG = sum(sum_v * w) / sum(count_v * w)``, class counts ``= sum(c * w)``.
  Weights and weighted counts are 38-digit decimals: a postal code with millions
  of rows on both sides overflows no BIGINT on the way.  A published class count
  beyond BIGINT is NULL.

All aggregates are exact (decimal sums, integer counts), so the result equals
the naive plan bit for bit.  Rows shuffled drop to about the number of
distinct (postal, year, area).  ``weighting='distinct'`` uses a de-duplicated
bridge (``w = 1``) through the same code path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landlens.contracts import ZONING_AREA
from landlens.functions.classify import indicator
from landlens.functions.numeric import finish_avg

_WIDE = T.DecimalType(38, 2)
_COUNT = T.DecimalType(38, 0)
_MEASURES = (("average_land_value", "CURRENT_LAND_VALUE"),
             ("average_improvement_value", "CURRENT_IMPROVEMENT_VALUE"),
             ("average_tax_levy", "TAX_LEVY"))


def _weight(weighting: str) -> Column:
    """How often one tax row counts in an area, from ``__m`` and ``__n``."""
    if weighting == "fanout":
        return F.try_multiply(F.col("__m").cast(T.DecimalType(19, 0)), F.col("__n").cast(T.DecimalType(19, 0))).cast(_COUNT)
    if weighting == "distinct":
        return F.lit(1).cast(_COUNT)
    raise ValueError(f"unknown weighting {weighting!r}")


def _weighted(c: Column, weight: Column, scale: int = 0) -> Column:
    """``sum(c * weight)`` as a decimal of 38 digits; NULL if even that is too small."""
    kind = T.DecimalType(38, scale)
    return F.try_sum(F.try_multiply(c.cast(kind), weight).try_cast(kind)).try_cast(kind)


def bridge_weights(tax: DataFrame | None, permits: DataFrame, weighting: str = "fanout",
                   tax_rows: DataFrame | None = None) -> DataFrame:
    """``(postal, LOCAL_AREA, w)``: how often one tax row of ``postal`` repeats in the area.

    This is the bridge (V6) in compressed form: V6 has exactly ``sum(w)`` rows.
    ``tax_rows`` (``__postal, __n``) may be passed when the caller already has
    the tax row count per postal code; otherwise it is counted from ``tax``.
    """
    m = (permits.groupBy(F.col("POSTAL_CODE").alias("__postal"),
                         F.col("GEO_LOCAL_AREA").alias("LOCAL_AREA"))
         .agg(F.count(F.lit(1)).alias("__m")))
    n = tax_rows if tax_rows is not None else (
        tax.groupBy(F.col("PROPERTY_POSTAL_CODE").alias("__postal"))
        .agg(F.count(F.lit(1)).alias("__n")))
    return m.join(n, "__postal").select("__postal", "LOCAL_AREA", _weight(weighting).alias("__w"))


def bridge_row_count(tax: DataFrame, permits: DataFrame, weighting: str = "fanout") -> DataFrame:
    """A8 over V6 without building it: ``count(*)`` of the bridge as ``sum(w)`` (NULL beyond BIGINT)."""
    w = bridge_weights(tax, permits, weighting)
    return w.agg(F.coalesce(F.try_sum("__w"), F.lit(0)).try_cast("bigint").alias("total_rows"))


def postal_area_bridge(tax: DataFrame, permits: DataFrame, distinct: bool = False) -> DataFrame:
    """The postal -> area bridge.

    ``distinct=False`` is the bridge as the source defines it: one row per
    (tax row, permit row) pair sharing a postal code, ``sum n*m`` rows; use
    :func:`bridge_weights` to aggregate through it.  ``distinct=True`` gives
    its distinct pairs without building the product: the distinct (postal,
    area) pairs of the permits, semi-joined to the postal codes present in
    the tax table.
    """
    pairs = permits.select("POSTAL_CODE", F.col("GEO_LOCAL_AREA").alias("LOCAL_AREA"))
    taxed = tax.select(F.col("PROPERTY_POSTAL_CODE").alias("POSTAL_CODE"))
    if distinct:
        return pairs.distinct().join(taxed, "POSTAL_CODE", "left_semi")
    return taxed.join(pairs, "POSTAL_CODE")


def property_tax_by_year_area(tax: DataFrame, permits: DataFrame,
                              zoning_classes: Mapping[str, Sequence[str]] = ZONING_AREA,
                              weighting: str = "fanout", avg_double: bool = False) -> DataFrame:
    """A4 / V7 through R1: tax averages and zoning-class counts per (year, area)."""
    res = list(zoning_classes.get("residential", []))
    non = list(zoning_classes.get("non-residential", []))
    aggs: list[Column] = []
    for name, src in _MEASURES:
        aggs += [F.sum(F.col(src)).cast(_WIDE).alias(f"__s_{name}"),
                 F.count(F.col(src)).alias(f"__c_{name}")]
    aggs += [F.sum(indicator("ZONING_CLASSIFICATION", res).cast("bigint")).alias("__res"),
             F.sum(indicator("ZONING_CLASSIFICATION", non).cast("bigint")).alias("__non"),
             F.count(F.lit(1)).alias("__rows")]
    g = tax.groupBy(F.col("PROPERTY_POSTAL_CODE").alias("__postal"),
                    F.col("REPORT_YEAR").alias("YEAR")).agg(*aggs)
    # n(p) as a window sum over the (postal, year) groups of p: one scan of the
    # tax table, and the result is already partitioned by postal for the join.
    g = g.withColumn("__n", F.sum("__rows").over(Window.partitionBy("__postal")))
    m = (permits.groupBy(F.col("POSTAL_CODE").alias("__postal"),
                         F.col("GEO_LOCAL_AREA").alias("LOCAL_AREA"))
         .agg(F.count(F.lit(1)).alias("__m")))
    j = g.join(m, "__postal")
    wt = _weight(weighting)
    out_aggs: list[Column] = []
    for name, _ in _MEASURES:
        out_aggs += [_weighted(F.col(f"__s_{name}"), wt, 2).alias(f"__S_{name}"),
                     _weighted(F.col(f"__c_{name}"), wt).alias(f"__C_{name}")]
    out_aggs += [_weighted(F.col("__res"), wt).try_cast("bigint").alias("residential_zoning_count"),
                 _weighted(F.col("__non"), wt).try_cast("bigint").alias("non_residential_zoning_count")]
    r = j.groupBy("YEAR", "LOCAL_AREA").agg(*out_aggs)
    return r.select("YEAR", "LOCAL_AREA",
                    *[finish_avg(F.col(f"__S_{n}"), F.col(f"__C_{n}"), as_double=avg_double).alias(n)
                      for n, _ in _MEASURES],
                    "residential_zoning_count", "non_residential_zoning_count")


def property_tax_by_year_area_naive(tax: DataFrame, permits: DataFrame,
                                    zoning_classes: Mapping[str, Sequence[str]] = ZONING_AREA,
                                    distinct: bool = False, avg_double: bool = False) -> DataFrame:
    """The literal plan (tax JOIN bridge, then aggregate), for equivalence tests only."""
    res = list(zoning_classes.get("residential", []))
    non = list(zoning_classes.get("non-residential", []))
    v6 = postal_area_bridge(tax, permits, distinct).withColumnRenamed("POSTAL_CODE", "__postal")
    j = tax.join(v6, tax["PROPERTY_POSTAL_CODE"] == v6["__postal"])
    aggs: list[Column] = []
    for name, src in _MEASURES:
        aggs += [F.sum(F.col(src)).cast(_WIDE).alias(f"__S_{name}"), F.count(F.col(src)).alias(f"__C_{name}")]
    aggs += [F.sum(indicator("ZONING_CLASSIFICATION", res).cast("bigint")).alias("residential_zoning_count"),
             F.sum(indicator("ZONING_CLASSIFICATION", non).cast("bigint")).alias("non_residential_zoning_count")]
    r = j.groupBy(F.col("REPORT_YEAR").alias("YEAR"), "LOCAL_AREA").agg(*aggs)
    return r.select("YEAR", "LOCAL_AREA",
                    *[finish_avg(F.col(f"__S_{n}"), F.col(f"__C_{n}"), as_double=avg_double).alias(n)
                      for n, _ in _MEASURES],
                    "residential_zoning_count", "non_residential_zoning_count")
