"""Invariants of the follow-up results on the test-table bindings."""

from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from landlens.operators import followup
from landlens.plans import bindings as B
from landlens.plans import views


@pytest.fixture(scope="module")
def v5(spark, smoke_dir):
    return views.v5(views.v1(B.business_licenses(spark, smoke_dir)), views.v2(B.property_tax(spark, smoke_dir)))


def _pct(i, f):
    if i == 0:
        return None
    if i is None or f is None:
        return None
    return ((f - i) * 100 / i).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def test_followup_pairs_and_percent(v5):
    rows = v5.collect()
    assert rows
    keys = set()
    for r in rows:
        assert 1 <= r.FOLLOWUP_YEAR - r.INVESTMENT_YEAR <= 5
        assert r.PERCENT_CHANGE_IN_LAND_VALUE == _pct(r.LAND_VALUE_IN_INVESTMENT_YEAR,
                                                      r.LAND_VALUE_IN_FOLLOWUP_YEAR)
        k = (r.POSTAL_CODE, r.INVESTMENT_YEAR, r.FOLLOWUP_YEAR)
        assert k not in keys
        keys.add(k)


def test_area_file_invariants(spark, v5):
    area = followup.area_followup_rollup(v5.withColumn(
        "LOCAL_AREA", F.when(F.col("LOCAL_AREA") == "NATION_1", F.lit(None)).otherwise(F.col("LOCAL_AREA"))))
    assert area.columns == ["local_area", "investment_year", "followup_year", "total_businesses",
                            "total_employees", "total_land_value_in_investment_year",
                            "total_land_value_in_followup_year", "percent_change_in_land_value"]
    ordered = area.orderBy(F.col("local_area").asc_nulls_last(), "investment_year", "followup_year").collect()
    seen_null = False
    keys = set()
    for r in ordered:
        if r.local_area is None:
            seen_null = True
        else:
            assert not seen_null, "null area must sort last"
        assert 1 <= r.followup_year - r.investment_year <= 5
        assert r.percent_change_in_land_value == _pct(r.total_land_value_in_investment_year,
                                                      r.total_land_value_in_followup_year)
        k = (r.local_area, r.investment_year, r.followup_year)
        assert k not in keys
        keys.add(k)
    assert seen_null


def test_money_types_are_exact(v5):
    types = dict(v5.dtypes)
    assert types["LAND_VALUE_IN_INVESTMENT_YEAR"].startswith("decimal")
    assert types["PERCENT_CHANGE_IN_LAND_VALUE"].startswith("decimal")
