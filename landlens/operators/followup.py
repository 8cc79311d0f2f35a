"""Investment follow-up (V5: J2, P4, W1) and its area roll-up.

The source view joins the postal-level table (V3) to itself on postal code and
``i.year < f.year <= i.year + 5``, then keeps one arbitrary row per
(postal, investment year, follow-up year).  Any one row of the product is a
legal answer, so we choose it up front (R2): one row per (postal, year) by a
fixed tie-break.  That pick factorises over the join that makes V3: the smallest
area and then licence measures come from the licence groups (V1) alone, the
smallest zoning, street and values from the tax groups (V2) alone.  So each side
is picked by ``min(struct(...))``, a partial aggregate, and one row joins one
row; V3 is never built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landlens.contracts import FOLLOWUP_HORIZON
from landlens.functions.numeric import percent_change, two_digit_year
from landlens.operators.joins import band_join

# Q2 tie-break: area, zoning, street, then the measures (ascending, nulls first).
TIE_BREAK = ("LOCAL_AREA", "ZONING_CLASSIFICATION", "STREET_NAME", "TOTAL_CURRENT_LAND_VALUE",
             "TOTAL_BUSINESSES", "TOTAL_EMPLOYEES", "TOTAL_PREVIOUS_LAND_VALUE",
             "TOTAL_PREVIOUS_IMPROVEMENT_VALUE", "TOTAL_CURRENT_IMPROVEMENT_VALUE")

def pick_one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the smallest by ``order`` (struct ordering, nulls first)."""
    picked = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in order])).alias("__pick"))
    return picked.select(*keys, *[F.col(f"__pick.{c}").alias(c) for c in order])


_FROM_LICENCES = ("LOCAL_AREA", "TOTAL_BUSINESSES", "TOTAL_EMPLOYEES")
_FROM_TAX = tuple(c for c in TIE_BREAK if c not in _FROM_LICENCES)


def postal_year_picks(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """W1 over V3 without V3: its first row by ``TIE_BREAK`` for each (postal, year).

    (zoning, street) is unique within a (postal, year) of V2, so the order of
    the tie-break columns never compares licence measures across tax groups.
    """
    b = pick_one_per_key(v1.withColumn("YEAR", two_digit_year(F.col("FOLDER_YEAR"))), ["POSTAL_CODE", "YEAR"], _FROM_LICENCES)
    p = pick_one_per_key(v2.withColumnRenamed("REPORT_YEAR", "YEAR"), ["POSTAL_CODE", "YEAR"], _FROM_TAX)
    return b.join(p, ["POSTAL_CODE", "YEAR"])


def investment_land_value_followup(v1: DataFrame, v2: DataFrame, horizon: int = FOLLOWUP_HORIZON,
                                   strategy: str = "frame") -> DataFrame:
    """V5: for each postal code and year, the land value ``1..horizon`` years later.

    ``strategy``:

    * ``'frame'`` (default): the picks hold one row per (postal, year), so the
      follow-up partners of a row are the rows of its postal code inside the
      window frame ``RANGE BETWEEN 1 FOLLOWING AND horizon FOLLOWING`` on the
      year; ``collect_list`` over that frame holds at most ``horizon`` entries.
      No self-join, and a postal code has one row a year in its window.
    * ``'explode'`` (R3): the band as an equi join on (postal, year) after
      exploding each row into its candidate years.
    * ``'range'``: equi join on postal code with the band as a residual predicate.

    All return the same rows.
    """
    picked = postal_year_picks(v1, v2)
    i = picked.select("POSTAL_CODE", "YEAR", "LOCAL_AREA",
                      F.col("TOTAL_BUSINESSES").alias("BUSINESSES_COUNT"),
                      F.col("TOTAL_EMPLOYEES").alias("EMPLOYEES_COUNT"),
                      F.col("TOTAL_CURRENT_LAND_VALUE").alias("LAND_VALUE_IN_INVESTMENT_YEAR"))
    if strategy == "frame":
        frame = Window.partitionBy("POSTAL_CODE").orderBy("YEAR").rangeBetween(1, horizon)
        later = F.collect_list(F.struct(F.col("YEAR").alias("FOLLOWUP_YEAR"),
                                        F.col("LAND_VALUE_IN_INVESTMENT_YEAR")
                                        .alias("LAND_VALUE_IN_FOLLOWUP_YEAR"))).over(frame)
        j = i.withColumn("__later", later).withColumn("__f", F.explode("__later")).select(
            *i.columns, F.col("__f.FOLLOWUP_YEAR").alias("FOLLOWUP_YEAR"),
            F.col("__f.LAND_VALUE_IN_FOLLOWUP_YEAR").alias("LAND_VALUE_IN_FOLLOWUP_YEAR"))
    else:
        f = picked.select("POSTAL_CODE", F.col("YEAR").alias("FOLLOWUP_YEAR"),
                          F.col("TOTAL_CURRENT_LAND_VALUE").alias("LAND_VALUE_IN_FOLLOWUP_YEAR"))
        j = band_join(i, f, "POSTAL_CODE", "YEAR", "FOLLOWUP_YEAR", horizon, strategy)
    return j.select(
        "LOCAL_AREA", "POSTAL_CODE", F.col("YEAR").alias("INVESTMENT_YEAR"), "BUSINESSES_COUNT",
        "EMPLOYEES_COUNT", "LAND_VALUE_IN_INVESTMENT_YEAR", "FOLLOWUP_YEAR",
        "LAND_VALUE_IN_FOLLOWUP_YEAR",
        percent_change(F.col("LAND_VALUE_IN_INVESTMENT_YEAR"),
                       F.col("LAND_VALUE_IN_FOLLOWUP_YEAR")).alias("PERCENT_CHANGE_IN_LAND_VALUE"))


def investment_land_value_followup_naive(v3: DataFrame, horizon: int = FOLLOWUP_HORIZON,
                                         tie_break: Sequence[str] = TIE_BREAK) -> DataFrame:
    """The literal product of V3 with itself and ``ROW_NUMBER``, for equivalence tests only."""
    i = v3.select(*[F.col(c).alias(f"i_{c}") for c in v3.columns])
    f = v3.select(*[F.col(c).alias(f"f_{c}") for c in v3.columns])
    j = i.join(f, (F.col("i_POSTAL_CODE") == F.col("f_POSTAL_CODE"))
               & (F.col("f_YEAR") > F.col("i_YEAR"))
               & (F.col("f_YEAR") <= F.col("i_YEAR") + F.lit(horizon)))
    w = Window.partitionBy("i_POSTAL_CODE", "i_YEAR", "f_YEAR").orderBy(
        *[F.col(f"i_{c}").asc_nulls_first() for c in tie_break],
        *[F.col(f"f_{c}").asc_nulls_first() for c in tie_break])
    r = j.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1)
    return r.select(
        F.col("i_LOCAL_AREA").alias("LOCAL_AREA"), F.col("i_POSTAL_CODE").alias("POSTAL_CODE"),
        F.col("i_YEAR").alias("INVESTMENT_YEAR"), F.col("i_TOTAL_BUSINESSES").alias("BUSINESSES_COUNT"),
        F.col("i_TOTAL_EMPLOYEES").alias("EMPLOYEES_COUNT"),
        F.col("i_TOTAL_CURRENT_LAND_VALUE").alias("LAND_VALUE_IN_INVESTMENT_YEAR"),
        F.col("f_YEAR").alias("FOLLOWUP_YEAR"),
        F.col("f_TOTAL_CURRENT_LAND_VALUE").alias("LAND_VALUE_IN_FOLLOWUP_YEAR"),
        percent_change(F.col("i_TOTAL_CURRENT_LAND_VALUE"),
                       F.col("f_TOTAL_CURRENT_LAND_VALUE")).alias("PERCENT_CHANGE_IN_LAND_VALUE"))


def area_followup_rollup(v5: DataFrame) -> DataFrame:
    """The area follow-up file.

    Sums per (area, investment year, follow-up year); the percent change is
    that of the *sums* (not an average of percents).  Null areas form their own
    group (written as the text ``null`` by the CSV sink).
    """
    g = v5.groupBy(F.col("LOCAL_AREA").alias("local_area"),
                   F.col("INVESTMENT_YEAR").alias("investment_year"),
                   F.col("FOLLOWUP_YEAR").alias("followup_year")).agg(
        F.sum("BUSINESSES_COUNT").cast("bigint").alias("total_businesses"),
        F.sum("EMPLOYEES_COUNT").cast("bigint").alias("total_employees"),
        F.sum("LAND_VALUE_IN_INVESTMENT_YEAR").alias("total_land_value_in_investment_year"),
        F.sum("LAND_VALUE_IN_FOLLOWUP_YEAR").alias("total_land_value_in_followup_year"))
    return g.withColumn("percent_change_in_land_value",
                        percent_change(F.col("total_land_value_in_investment_year"),
                                       F.col("total_land_value_in_followup_year")))


def sorted_followup(v5: DataFrame) -> DataFrame:
    """O2: the view's output order (area, postal, years), null areas last."""
    return v5.orderBy(F.col("LOCAL_AREA").asc_nulls_last(), F.col("POSTAL_CODE").asc_nulls_last(),
                      "INVESTMENT_YEAR", "FOLLOWUP_YEAR")
