"""Clean tables stored by postal code: no exchange of a clean table, same results."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from landlens.plans import bindings as B
from landlens.plans import views
from landlens.sources import layout


@pytest.fixture(scope="module")
def tables(spark, smoke_dir):
    plain = {"property_tax": B.property_tax(spark, smoke_dir), "building_permits": B.building_permits(spark, smoke_dir),
             "business_licenses": B.business_licenses(spark, smoke_dir)}
    prefix = f"layout_{uuid.uuid4().hex}"
    yield plain, layout.bucketed_tables(plain, prefix, 4)
    for n in plain:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{n}")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


RESULTS = ["business_size_by_postal_code", "property_aggregated_by_postal_code", "combined_by_postal_code", "combined_by_local_area",
           "investment_land_value_followup", "property_tax_by_report_year_local_area_view", "property_tax_grouped", "property_and_permits_grouped"]


@pytest.mark.parametrize("name", RESULTS)
def test_results_on_the_layout_are_the_same(spark, tables, name):
    plain, stored = tables
    with layout.bucketed_session(spark):
        got = sorted(map(repr, views.build_registry(spark, stored).get(name).collect()))
    assert got == sorted(map(repr, views.build_registry(spark, plain).get(name).collect()))


@pytest.mark.parametrize("name, exchanges", [("combined_by_postal_code", 0), ("property_aggregated_by_postal_code", 0), ("property_tax_grouped", 0)])
def test_no_exchange_of_a_clean_table(spark, tables, name, exchanges):
    plain, stored = tables
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # joins as on large tables
    try:
        with layout.bucketed_session(spark):
            text = plan(views.build_registry(spark, stored).get(name))
            assert len(re.findall(r"\bExchange hashpartitioning", text)) == exchanges, text
        assert len(re.findall(r"\bExchange hashpartitioning", plan(views.build_registry(spark, plain).get(name)))) > exchanges
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)


@pytest.mark.parametrize("name", ["property_tax_by_report_year_local_area_view", "property_and_permits_grouped"])
def test_only_aggregates_are_exchanged(spark, tables, name):
    plain, stored = tables
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with layout.bucketed_session(spark):
            lines = plan(views.build_registry(spark, stored).get(name)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    below = [(x, y) for x, y in zip(lines, lines[1:]) if re.search(r"\bExchange hashpartitioning", x)]
    # a clean table's rows or their partial aggregates by postal code would be below an exchange; sums by area are
    moved = [(x, y) for x, y in below if "FileScan" in y or "ColumnarToRow" in y or ("partial_" in y and "POSTAL" in y.upper().split("FUNCTIONS=")[0])]
    assert not moved, moved


def test_a_frequent_key_leaves_the_table_unbucketed(spark):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    name = f"hot_{uuid.uuid4().hex}"
    assert layout.hottest_share(hot, "k") == pytest.approx(1 / 3) and layout.hottest_share(hot.limit(0), "k") == 0
    assert not layout.write_bucketed(hot, name, "k", 64) and spark.table(name).count() == 3000
    assert layout.write_bucketed(hot, name, "k", 8)  # 8 buckets: a third of the rows is 2.7 of them
    assert "Num Buckets" in {r.col_name for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    spark.sql(f"DROP TABLE {name}")
