"""Aggregations.

Column names follow the clean-table contracts.  Every aggregate here is
algebraic (sum, count, max, min) or a distinct count, so Spark plans a partial
aggregate before the shuffle: a postal code holding a third of all rows is
combined map-side and never lands whole in one task.

Averages are computed as exact decimal ``sum / count`` (``finish_avg``), either
as money (decimal, two digits) or as an unrounded double (``avg_double=True``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landlens.contracts import USE_AREA, USE_POSTAL, USE_POSTAL_DEFAULT, ZONING_POSTAL, ZONING_POSTAL_DEFAULT
from landlens.functions.classify import class_of, indicator_sum
from landlens.functions.numeric import finish_avg, share_percent, two_digit_year


def _avg(c: Column, name: str, avg_double: bool) -> tuple[list[Column], Column]:
    """Aggregates for an average, and the final expression over them."""
    s, n = f"__sum_{name}", f"__cnt_{name}"
    return ([F.sum(c).alias(s), F.count(c).alias(n)],
            finish_avg(F.col(s), F.col(n), as_double=avg_double).alias(name))


def _grouped_with_avgs(df: DataFrame, keys: Sequence[Column | str], plain: Sequence[Column],
                       avgs: Mapping[str, Column], avg_double: bool,
                       order: Sequence[str]) -> DataFrame:
    aggs = list(plain)
    finals = {}
    for name, c in avgs.items():
        a, fin = _avg(c, name, avg_double)
        aggs += a
        finals[name] = fin
    g = df.groupBy(*keys).agg(*aggs)
    return g.select(*[finals.get(c, F.col(c)) for c in order])


# -- V1 -----------------------------------------------------------------------
def business_size_by_postal_code(lic: DataFrame) -> DataFrame:
    """A1 / V1: employees and businesses per (postal code, folder year, street, area)."""
    return (lic.groupBy("POSTAL_CODE", "FOLDER_YEAR", "STREET_NAME", "LOCAL_AREA")
            .agg(F.sum("NUMBER_OF_EMPLOYEES").cast("bigint").alias("TOTAL_EMPLOYEES"),
                 F.count("BUSINESS_NAME").alias("TOTAL_BUSINESSES")))


# -- V2 -----------------------------------------------------------------------
def property_aggregated_by_postal_code(tax: DataFrame) -> DataFrame:
    """A2 / V2: four value totals per (postal code, report year, zoning, street)."""
    return (tax.groupBy(F.col("PROPERTY_POSTAL_CODE").alias("POSTAL_CODE"), "REPORT_YEAR",
                        "ZONING_CLASSIFICATION", "STREET_NAME")
            .agg(F.sum("PREVIOUS_LAND_VALUE").alias("TOTAL_PREVIOUS_LAND_VALUE"),
                 F.sum("CURRENT_LAND_VALUE").alias("TOTAL_CURRENT_LAND_VALUE"),
                 F.sum("PREVIOUS_IMPROVEMENT_VALUE").alias("TOTAL_PREVIOUS_IMPROVEMENT_VALUE"),
                 F.sum("CURRENT_IMPROVEMENT_VALUE").alias("TOTAL_CURRENT_IMPROVEMENT_VALUE")))


# -- V4 -----------------------------------------------------------------------
_TOTALS = ("PREVIOUS_LAND_VALUE", "CURRENT_LAND_VALUE", "PREVIOUS_IMPROVEMENT_VALUE", "CURRENT_IMPROVEMENT_VALUE")


def combined_by_local_area(v1: DataFrame, v2: DataFrame, avg_double: bool = False) -> DataFrame:
    """A3 / V4: the postal-level join (V3) rolled up to (area, year), without building it.

    The sums repeat a business group once per matching tax group and the
    reverse (bag semantics of the join, kept on purpose), so both sides are
    reduced first: licences to (postal, year, area) with their number of
    groups, tax to (postal, year) with its sums, counts and number of groups.
    One row of the join then stands for all its pairs, each side weighted by
    the other's number of groups.  A (postal, year, area) occurs once, so
    ``NUM_OF_PROPERTIES``, the number of distinct postal codes, is a row count.
    """
    wide = T.DecimalType(38, 2)
    lic = (v1.groupBy("POSTAL_CODE", two_digit_year(F.col("FOLDER_YEAR")).alias("YEAR"), "LOCAL_AREA")
           .agg(F.sum("TOTAL_EMPLOYEES").alias("__emp"), F.sum("TOTAL_BUSINESSES").alias("__biz"),
                F.count(F.lit(1)).cast("decimal(20,0)").alias("__k")))
    tax = (v2.groupBy("POSTAL_CODE", F.col("REPORT_YEAR").alias("YEAR"))
           .agg(F.count(F.lit(1)).alias("__r"),
                *[F.sum(f"TOTAL_{m}").cast(wide).alias(f"__s_{m}") for m in _TOTALS],
                *[F.count(f"TOTAL_{m}").cast("decimal(20,0)").alias(f"__c_{m}") for m in _TOTALS]))
    g = lic.join(tax, ["POSTAL_CODE", "YEAR"]).groupBy("LOCAL_AREA", "YEAR").agg(
        F.sum(F.col("__emp") * F.col("__r")).cast("bigint").alias("TOTAL_EMPLOYEES"),
        F.sum(F.col("__biz") * F.col("__r")).cast("bigint").alias("TOTAL_BUSINESSES"),
        *[F.sum((F.col(f"__s_{m}") * F.col("__k")).cast(wide)).cast(wide).alias(f"__s_{m}") for m in _TOTALS],
        *[F.sum(F.col(f"__c_{m}") * F.col("__k")).alias(f"__c_{m}") for m in _TOTALS],
        F.count(F.lit(1)).alias("NUM_OF_PROPERTIES"))
    return g.select("LOCAL_AREA", "YEAR", "TOTAL_EMPLOYEES", "TOTAL_BUSINESSES",
                    *[finish_avg(F.col(f"__s_{m}"), F.col(f"__c_{m}"), as_double=avg_double).alias(f"AVG_TOTAL_{m}")
                      for m in _TOTALS], "NUM_OF_PROPERTIES")


def combined_by_local_area_naive(v3: DataFrame, avg_double: bool = False) -> DataFrame:
    """The roll-up over the join itself, for equivalence tests only."""
    avgs = {f"AVG_TOTAL_{m}": F.col(f"TOTAL_{m}") for m in _TOTALS}
    plain = [F.sum("TOTAL_EMPLOYEES").cast("bigint").alias("TOTAL_EMPLOYEES"),
             F.sum("TOTAL_BUSINESSES").cast("bigint").alias("TOTAL_BUSINESSES"),
             F.count_distinct("POSTAL_CODE").alias("NUM_OF_PROPERTIES")]
    order = ["LOCAL_AREA", "YEAR", "TOTAL_EMPLOYEES", "TOTAL_BUSINESSES", *avgs, "NUM_OF_PROPERTIES"]
    return _grouped_with_avgs(v3, ["LOCAL_AREA", "YEAR"], plain, avgs, avg_double, order)


# -- V8 -----------------------------------------------------------------------
def building_permits_by_year_local_area(permits: DataFrame,
                                        use_classes: Mapping[str, Sequence[str]] = USE_AREA,
                                        avg_double: bool = False) -> DataFrame:
    """A5 / V8: permits, average project value and use-class counts per (year, area)."""
    res = use_classes.get("residential", [])
    non = use_classes.get("non-residential", [])
    plain = [F.count(F.lit(1)).alias("total_permits_issued"),
             indicator_sum("PROPERTY_USE", res).alias("residential_property_use_count"),
             indicator_sum("PROPERTY_USE", non).alias("non_residential_property_use_count")]
    order = ["YEAR", "LOCAL_AREA", "total_permits_issued", "average_project_value",
             "residential_property_use_count", "non_residential_property_use_count"]
    return _grouped_with_avgs(
        permits, [F.col("ISSUE_YEAR").alias("YEAR"), F.col("GEO_LOCAL_AREA").alias("LOCAL_AREA")],
        plain, {"average_project_value": F.col("PROJECT_VALUE")}, avg_double, order)


# -- V10 ----------------------------------------------------------------------
def _sum_cast(df: DataFrame, expr: Column, name: str) -> Column:
    """``sum`` of a partial-sum column ``name``, cast to the type a one-level
    ``sum(expr)`` would have (decimal(p + 10, s)); the type is read from the
    analysed plan, no job runs."""
    t = df.select(expr.alias("__t")).schema["__t"].dataType
    s = F.sum(name)
    if isinstance(t, T.DecimalType):
        return s.cast(T.DecimalType(min(t.precision + 10, 38), t.scale))
    return s


def property_tax_grouped(tax: DataFrame,
                         zoning_classes: Mapping[str, Sequence[str]] = ZONING_POSTAL,
                         default: str = ZONING_POSTAL_DEFAULT,
                         avg_double: bool = False) -> DataFrame:
    """Postal tax profile; the class comes from the lexicographic
    ``MAX`` of the zoning text (binary collation), as in the source view.

    Two levels: the tax rows are aggregated by (postal code, zoning) — all
    buffers fixed-width, so a hash aggregate with map-side combine — and only
    those few rows per postal code go through the text ``MAX`` (which Spark
    can only do as a sort-based aggregate) and the final sums.
    """
    land, impr = F.col("CURRENT_LAND_VALUE"), F.col("CURRENT_IMPROVEMENT_VALUE")
    both = land + impr
    l1 = tax.groupBy("PROPERTY_POSTAL_CODE", "ZONING_CLASSIFICATION").agg(
        F.count("PID").alias("__pids"),
        F.sum(land).alias("__land"), F.count(land).alias("__nland"),
        F.sum(impr).alias("__impr"), F.count(impr).alias("__nimpr"),
        F.sum(both).alias("__both"), F.count(both).alias("__nboth"),
        F.max("TAX_ASSESSMENT_YEAR").alias("__ay"), F.max("YEAR_BUILT").alias("__yb"),
        F.max("BIG_IMPROVEMENT_YEAR").alias("__iy"))

    land_t = _sum_cast(tax, land, "__land")
    impr_t = _sum_cast(tax, impr, "__impr")
    both_t = _sum_cast(tax, both, "__both")
    g = l1.groupBy("PROPERTY_POSTAL_CODE").agg(
        F.sum("__pids").alias("property_count"),
        F.max("ZONING_CLASSIFICATION").alias("__max_zoning"),
        land_t.alias("total_land_value"), impr_t.alias("total_improvement_value"),
        both_t.alias("total_property_value"),
        F.sum("__nland").alias("__nl"), F.sum("__nimpr").alias("__ni"), F.sum("__nboth").alias("__nb"),
        F.max("__ay").alias("latest_assessment_year"), F.max("__yb").alias("latest_year_built"),
        F.max("__iy").alias("latest_improvement_year"))
    return g.select(
        "PROPERTY_POSTAL_CODE", "property_count",
        class_of("__max_zoning", zoning_classes, default).alias("ZONING"),
        "total_land_value", "total_improvement_value", "total_property_value",
        finish_avg(F.col("total_land_value"), F.col("__nl"), as_double=avg_double).alias("avg_land_value"),
        finish_avg(F.col("total_improvement_value"), F.col("__ni"), as_double=avg_double)
        .alias("avg_improvement_value"),
        finish_avg(F.col("total_property_value"), F.col("__nb"), as_double=avg_double)
        .alias("avg_property_value"),
        "latest_assessment_year", "latest_year_built", "latest_improvement_year")


# -- V11 ----------------------------------------------------------------------
def building_permits_grouped(permits: DataFrame,
                             use_classes: Mapping[str, Sequence[str]] = USE_POSTAL,
                             default: str = USE_POSTAL_DEFAULT,
                             avg_double: bool = False) -> DataFrame:
    """Postal permit profile.

    Level 1 groups the permits by postal code and the three columns whose
    distinct values are counted and holds fixed-width buffers only, so it is a
    hash aggregate; beside it the distinct (postal, geometry, point) texts are
    reduced by a hash aggregate of their own.  Only the few rows left of each go
    through level 2: text maxima (a sort-based aggregate in Spark) and three
    distinct counts.  Both levels aggregate partially before their shuffle (a
    hot postal code is combined map-side).  ``distinct_property_uses`` counts
    the raw use text, not the derived class.
    """
    dims = ["POSTAL_CODE", "TYPE_OF_WORK", "PERMIT_CATEGORY", "PROPERTY_USE"]
    l1 = permits.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("__n"), F.sum("PROJECT_VALUE").alias("__sum"),
        F.count("PROJECT_VALUE").alias("__cnt"), F.max("ISSUE_YEAR").alias("__year"),
        F.max("ISSUE_DATE").alias("__date"))
    total = _sum_cast(permits, F.col("PROJECT_VALUE"), "__sum")     # type of a one-level sum
    places = (permits.select(F.col("POSTAL_CODE").alias("__postal"), "GEOM", "GEO_POINT_2D").distinct()
              .groupBy("__postal").agg(F.max("GEOM").alias("geom"), F.max("GEO_POINT_2D").alias("geo_point_2d")))
    g = l1.groupBy("POSTAL_CODE").agg(
        F.sum("__n").alias("permit_count"), F.max("PROPERTY_USE").alias("__max_use"),
        total.alias("total_project_value"), F.sum("__cnt").alias("__count"),
        F.count_distinct("TYPE_OF_WORK").alias("distinct_work_types"),
        F.count_distinct("PERMIT_CATEGORY").alias("distinct_permit_categories"),
        F.count_distinct("PROPERTY_USE").alias("distinct_property_uses"),
        F.max("__year").alias("latest_issue_year"), F.max("__date").alias("latest_issue_date"))
    g = g.join(places, F.col("POSTAL_CODE").eqNullSafe(F.col("__postal")))
    return g.select(
        "POSTAL_CODE", "permit_count", "geom", "geo_point_2d",
        class_of("__max_use", use_classes, default).alias("PROPERTY_USE"), "total_project_value",
        finish_avg(F.col("total_project_value"), F.col("__count"), as_double=avg_double)
        .alias("avg_project_value"),
        "distinct_work_types", "distinct_permit_categories", "distinct_property_uses",
        "latest_issue_year", "latest_issue_date")


# -- A8 / A9 ------------------------------------------------------------------
def row_count(df: DataFrame, name: str = "total_entries") -> DataFrame:
    """One-row global count."""
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of one column."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_last())


def value_bounds(df: DataFrame, column: str) -> DataFrame:
    """Min and max of one column (e.g. the year range of a slider)."""
    return df.agg(F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"))


# -- A12 ----------------------------------------------------------------------
def class_shares(df: DataFrame, pairs: Sequence[tuple[str, str, str, str]],
                 keys: Sequence[str] = ("LOCAL_AREA", "YEAR"), digits: int = 1) -> DataFrame:
    """For each ``(first, second, first_name, second_name)`` the percentage of
    each count in their sum, for every row at once (no per-area loop).

    A row whose two counts are both 0 gets null shares (no pie to draw).
    """
    cols = [F.col(k) for k in keys]
    for first, second, first_name, second_name in pairs:
        cols += [F.col(first), F.col(second),
                 share_percent(F.col(first), F.col(second), digits).alias(first_name),
                 share_percent(F.col(second), F.col(first), digits).alias(second_name)]
    return df.select(*cols)


# -- A13 ----------------------------------------------------------------------
def trend(df: DataFrame, measures: Sequence[str], area: str | None = None,
          area_col: str = "LOCAL_AREA", year_col: str = "YEAR") -> DataFrame:
    """Measures by year, long form ``(area, year, measure, value)``.

    With ``area`` given, one area's series (C12); otherwise all areas at once.
    Ordered by area, measure, year (O3).
    """
    src = df.where(F.col(area_col) == F.lit(area)) if area is not None else df
    stack = ", ".join(f"'{m}', cast(`{m}` as double)" for m in measures)
    long = src.select(F.col(area_col), F.col(year_col).cast("int").alias(year_col),
                      F.expr(f"stack({len(measures)}, {stack}) as (measure, value)"))
    return long.orderBy(F.col(area_col).asc_nulls_last(), "measure", year_col)
