"""The named results V1-V17, composed from operators, and their registry.

Inputs are the clean tables (``property_tax``, ``building_permits`` with the
upper-case SQL names, ``business_licenses``) and, for the map table, a
boundary table ``(name, polygons)``.  Class maps and the average type are
parameters with the source's values as defaults, so the same code runs on
the city tables and on any stand-in tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landlens.contracts import (
    FOLLOWUP_HORIZON, USE_AREA, USE_POSTAL, USE_POSTAL_DEFAULT, ZONING_AREA, ZONING_POSTAL,
    ZONING_POSTAL_DEFAULT,
)
from landlens.operators import aggregate, clean, correlate, fanout, followup, joins
from landlens.operators.geometry import with_centroid
from landlens.sources.catalog import ViewRegistry


@dataclass(frozen=True)
class ViewOptions:
    zoning_area: Mapping[str, Sequence[str]] = field(default_factory=lambda: ZONING_AREA)
    zoning_postal: Mapping[str, Sequence[str]] = field(default_factory=lambda: ZONING_POSTAL)
    zoning_postal_default: str = ZONING_POSTAL_DEFAULT
    use_area: Mapping[str, Sequence[str]] = field(default_factory=lambda: USE_AREA)
    use_postal: Mapping[str, Sequence[str]] = field(default_factory=lambda: USE_POSTAL)
    use_postal_default: str = USE_POSTAL_DEFAULT
    avg_double: bool = False
    weighting: str = "fanout"          # Q1: 'fanout' (as published) or 'distinct'
    horizon: int = FOLLOWUP_HORIZON
    band_strategy: str = "frame"       # window frame, R3 ('explode') or band predicate ('range')


DEFAULT = ViewOptions()


def v1(lic: DataFrame) -> DataFrame:
    return aggregate.business_size_by_postal_code(lic)


def v2(tax: DataFrame) -> DataFrame:
    return aggregate.property_aggregated_by_postal_code(tax)


def v3(lic: DataFrame, tax: DataFrame) -> DataFrame:
    return joins.combined_by_postal_code(v1(lic), v2(tax))


def v4(v1_df: DataFrame, v2_df: DataFrame, o: ViewOptions = DEFAULT) -> DataFrame:
    """From the licence and tax groups; their join (V3) is not built."""
    return aggregate.combined_by_local_area(v1_df, v2_df, avg_double=o.avg_double)


def v5(v1_df: DataFrame, v2_df: DataFrame, o: ViewOptions = DEFAULT) -> DataFrame:
    """From the licence and tax groups; their join (V3) is not built."""
    return followup.investment_land_value_followup(v1_df, v2_df, o.horizon, o.band_strategy)


def v6(tax: DataFrame, permits: DataFrame, o: ViewOptions = DEFAULT) -> DataFrame:
    return fanout.postal_area_bridge(tax, permits, distinct=o.weighting == "distinct")


def v7(tax: DataFrame, permits: DataFrame, o: ViewOptions = DEFAULT) -> DataFrame:
    return fanout.property_tax_by_year_area(tax, permits, o.zoning_area, o.weighting, o.avg_double)


def v8(permits: DataFrame, o: ViewOptions = DEFAULT) -> DataFrame:
    return aggregate.building_permits_by_year_local_area(permits, o.use_area, o.avg_double)


def v9(tax: DataFrame, permits: DataFrame, o: ViewOptions = DEFAULT) -> DataFrame:
    return joins.combined_permits_tax(v8(permits, o), v7(tax, permits, o))


def v10(tax: DataFrame, o: ViewOptions = DEFAULT) -> DataFrame:
    return aggregate.property_tax_grouped(tax, o.zoning_postal, o.zoning_postal_default, o.avg_double)


def v11(permits: DataFrame, o: ViewOptions = DEFAULT) -> DataFrame:
    return aggregate.building_permits_grouped(permits, o.use_postal, o.use_postal_default, o.avg_double)


def v12(tax: DataFrame, permits: DataFrame, o: ViewOptions = DEFAULT) -> DataFrame:
    return joins.property_and_permits_grouped(v10(tax, o), v11(permits, o))


def v13(v5_df: DataFrame) -> DataFrame:
    return followup.area_followup_rollup(v5_df)


def v14(v12_df: DataFrame, digits: int | None = None) -> DataFrame:
    """Long correlation table for all three segments at once."""
    return correlate.rank_pair_correlation(v12_df, "year", "postal_code", "total_project_value",
                                           "total_land_value", "property_use", digits=digits)


def v15(v9_df: DataFrame) -> DataFrame:
    """Zoning and property-use shares for every (area, year)."""
    return aggregate.class_shares(v9_df, [
        ("residential_zoning_count", "non_residential_zoning_count",
         "residential_zoning_share", "non_residential_zoning_share"),
        ("residential_property_use_count", "non_residential_property_use_count",
         "residential_use_share", "non_residential_use_share")])


def v16(v9_df: DataFrame, boundaries: DataFrame, year: int | None = None,
        measures: Sequence[str] = ("average_land_value", "average_project_value",
                                   "average_improvement_value")) -> DataFrame:
    """Area map table: one year (C11), joined to boundaries (J7), polygons projected
    to UTM 10N (G3) *before* the centroid (G2), as the source did."""
    src = clean.where_equal(v9_df, YEAR=year) if year is not None else v9_df
    j = joins.join_boundaries(src, boundaries, area_col="LOCAL_AREA", name_col="name")
    return with_centroid(j, "polygons", project=True).select(
        "LOCAL_AREA", "YEAR", *measures, "centroid_x", "centroid_y")


def v17(v9_df: DataFrame, area: str | None = None,
        measures: Sequence[str] = ("average_land_value", "average_project_value",
                                   "average_improvement_value")) -> DataFrame:
    return aggregate.trend(v9_df, measures, area, "LOCAL_AREA", "YEAR")


def build_registry(spark: SparkSession, tables: Mapping[str, DataFrame],
                   o: ViewOptions = DEFAULT) -> ViewRegistry:
    """Every named result, resolvable by name and registrable for ``spark.sql``.

    ``tables`` must hold ``property_tax``, ``building_permits`` and
    ``business_licenses``.  No result is cached: a caller that writes a result
    others are built from may ``replace`` it by the written table.  A view that is
    defined again or dropped takes its readers along (see :class:`ViewRegistry`).
    """
    r = ViewRegistry(spark, tables)

    def result(name: str, build: Callable[..., DataFrame], *reads: str) -> None:
        r.define(name, lambda g: build(*[g.get(n) for n in reads]), reads)

    tax, permits, licences = "property_tax", "building_permits", "business_licenses"
    sizes, totals = "business_size_by_postal_code", "property_aggregated_by_postal_code"
    by_tax, by_permits = "property_tax_by_report_year_local_area_view", "building_permits_by_year_local_area_view"
    area_years, postal = "combined_building_permits_property_tax_view", "property_and_permits_grouped"
    result(sizes, v1, licences)
    result(totals, v2, tax)
    result("combined_by_postal_code", joins.combined_by_postal_code, sizes, totals)
    result("combined_by_local_area", lambda b, p: v4(b, p, o), sizes, totals)
    result("investment_land_value_followup", lambda b, p: v5(b, p, o), sizes, totals)
    result("postal_code_local_area_view", lambda t, p: v6(t, p, o), tax, permits)
    result(by_tax, lambda t, p: v7(t, p, o), tax, permits)
    result(by_permits, lambda p: v8(p, o), permits)
    result(area_years, joins.combined_permits_tax, by_permits, by_tax)
    result("property_tax_grouped", lambda t: v10(t, o), tax)
    result("building_permits_grouped", lambda p: v11(p, o), permits)
    result(postal, joins.property_and_permits_grouped, "property_tax_grouped", "building_permits_grouped")
    result("investment_vs_land_value", v13, "investment_land_value_followup")
    result("investment_land_value_correlation", v14, postal)
    result("zoning_and_use_shares", v15, area_years)
    result("area_trend", v17, area_years)
    if "boundaries" in tables:
        result("area_map", v16, area_years, "boundaries")
    return r
