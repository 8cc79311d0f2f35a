"""Joins (J1, J2, J5, J6, J7).

No join carries a strategy hint: Catalyst broadcasts a side whose known size is
below its byte threshold, and AQE decides again from the sizes it has measured.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landlens.contracts import FOLLOWUP_HORIZON
from landlens.functions.numeric import two_digit_year
from landlens.functions.text import point_part


# -- J1 / V3 ------------------------------------------------------------------
def combined_by_postal_code(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Licence groups x tax groups on postal code and ``folder_year + 2000 = report_year``.

    Many-to-many on purpose (bag semantics).  Both sides are aggregates, so a
    postal code contributes at most (streets x areas) x (zonings x streets)
    rows; AQE splits a skewed partition if one postal code dominates.
    Street comes from the tax side, area from the licence side.
    """
    b = v1.withColumn("__year", two_digit_year(F.col("FOLDER_YEAR")))
    p = v2.withColumnRenamed("POSTAL_CODE", "__p_postal").withColumnRenamed("STREET_NAME", "__p_street")
    j = b.join(p, (b["POSTAL_CODE"] == p["__p_postal"]) & (b["__year"] == p["REPORT_YEAR"]))
    return j.select(
        b["POSTAL_CODE"], p["REPORT_YEAR"].alias("YEAR"), b["LOCAL_AREA"],
        b["TOTAL_EMPLOYEES"], b["TOTAL_BUSINESSES"], p["ZONING_CLASSIFICATION"],
        p["__p_street"].alias("STREET_NAME"), p["TOTAL_PREVIOUS_LAND_VALUE"],
        p["TOTAL_CURRENT_LAND_VALUE"], p["TOTAL_PREVIOUS_IMPROVEMENT_VALUE"],
        p["TOTAL_CURRENT_IMPROVEMENT_VALUE"])


# -- J2 -----------------------------------------------------------------------
def band_join(left: DataFrame, right: DataFrame, key: str, year: str, right_year: str,
              horizon: int = FOLLOWUP_HORIZON, strategy: str = "explode") -> DataFrame:
    """Pair each left row with right rows of the same key and
    ``left.year < right.year <= left.year + horizon``.

    ``strategy='explode'`` (R3) turns the band into a pure equi join on
    (key, year): each left row is expanded to its ``horizon`` candidate years,
    so the join is hash-partitioned on both columns and a key with many years
    is spread over many partitions.  ``strategy='range'`` keeps an equi join
    on the key with a residual range predicate (sort-merge with a condition).
    ``right`` must name its year column ``right_year`` and carry ``key``.
    """
    if strategy == "explode":
        l2 = left.withColumn(right_year, F.explode(F.sequence(F.col(year) + 1, F.col(year) + horizon)))
        return l2.join(right, [key, right_year])
    if strategy == "range":
        r = right.withColumnRenamed(key, "__r_key")
        cond = ((left[key] == r["__r_key"]) & (r[right_year] > left[year])
                & (r[right_year] <= left[year] + F.lit(horizon)))
        return left.join(r, cond).drop("__r_key")
    raise ValueError(f"unknown band-join strategy {strategy!r}")


# -- J5 / V9 ------------------------------------------------------------------
def combined_permits_tax(v8: DataFrame, v7: DataFrame) -> DataFrame:
    """Permit aggregates x tax aggregates on (year, area); one-to-one."""
    j = v8.join(v7, ["YEAR", "LOCAL_AREA"])
    return j.select("YEAR", "LOCAL_AREA", "total_permits_issued", "average_project_value",
                    "residential_property_use_count", "non_residential_property_use_count",
                    "average_land_value", "average_improvement_value", "average_tax_levy",
                    "residential_zoning_count", "non_residential_zoning_count")


# -- J6 / V12 -----------------------------------------------------------------
def property_and_permits_grouped(v10: DataFrame, v11: DataFrame) -> DataFrame:
    """Postal tax profile x postal permit profile, with the point parsed.

    Latitude/longitude are NULL unless ``geo_point_2d`` holds exactly one comma
    (and parse as numbers).
    """
    j = v10.join(v11, v10["PROPERTY_POSTAL_CODE"] == v11["POSTAL_CODE"])
    pt = v11["geo_point_2d"]
    return j.select(
        v10["PROPERTY_POSTAL_CODE"].alias("postal_code"), v10["ZONING"].alias("zoning"),
        v11["PROPERTY_USE"].alias("property_use"), v11["geom"].alias("geom"),
        v10["property_count"], v11["permit_count"].alias("project_count"),
        v10["total_land_value"], v10["total_improvement_value"], v10["total_property_value"],
        v10["avg_land_value"], v10["avg_improvement_value"], v10["avg_property_value"],
        v11["permit_count"], v11["total_project_value"], v11["avg_project_value"],
        v11["latest_issue_year"].alias("year"),
        point_part(pt, 1).alias("latitude"), point_part(pt, 2).alias("longitude"))


# -- J7 -----------------------------------------------------------------------
def join_boundaries(df: DataFrame, boundaries: DataFrame, area_col: str = "local_area",
                    name_col: str = "name") -> DataFrame:
    """Area results x boundary polygons on ``name = area`` (inner).

    Only boundaries whose polygon could be read take part.
    """
    return df.join(boundaries, df[area_col] == boundaries[name_col])
