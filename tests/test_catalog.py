"""The dependency graph of named results."""

import pytest

from landlens.plans import bindings as B
from landlens.plans import views
from landlens.sources.catalog import DependencyError, ViewRegistry


def numbers(spark, n):
    return spark.range(n).select("id")


@pytest.fixture
def reg(spark):
    """base -> doubled -> summed -> told; base -> other."""
    r = ViewRegistry(spark, {"base": numbers(spark, 4)})
    r.define("doubled", lambda g: g.get("base").selectExpr("id * 2 AS id"), ["base"])
    r.define("summed", lambda g: g.get("doubled").selectExpr("sum(id) AS total"), ["doubled"])
    r.define_sql("told", "SELECT total + 1 AS total FROM {summed}")
    r.define("other", lambda g: g.get("base").selectExpr("count(*) AS n"))
    yield r
    for n in (*r.names(), "doubled", "summed", "told"):
        spark.catalog.dropTempView(n)


def one(df):
    return df.first()[0]


def test_readers_follow_a_redefinition(spark, reg):
    reg.register()
    assert one(spark.table("told")) == 13
    assert reg.define("doubled", lambda g: g.get("base").selectExpr("id * 10 AS id"), ["base"]) == ["summed", "told"]
    assert one(reg.get("summed")) == 60 and one(spark.table("summed")) == 60 and one(spark.sql("SELECT * FROM told")) == 61


def test_reads_are_declared_parsed_or_seen(reg):
    assert reg.reads("told") == {"summed"} and reg.reads("other") == set()
    reg.get("other")
    assert reg.reads("other") == {"base"} and reg.dependants("base") == ["doubled", "summed", "told", "other"]


def test_a_new_base_table_reaches_all_readers(spark, reg):
    reg.register("told", "other")
    assert one(spark.table("told")) == 13 and one(spark.table("other")) == 4
    reg.set_table("base", numbers(spark, 3))
    assert one(spark.table("told")) == 7 and one(spark.table("other")) == 3
    with pytest.raises(DependencyError):
        reg.set_table("doubled", numbers(spark, 1))
    with pytest.raises(DependencyError):
        reg.define("base", lambda g: numbers(spark, 1))


def test_drop_refuses_or_takes_the_readers_along(spark, reg):
    reg.register()
    with pytest.raises(DependencyError, match="told, summed"):
        reg.drop("doubled")
    assert one(spark.table("told")) == 13
    assert reg.drop("doubled", cascade=True) == ["told", "summed", "doubled"]
    assert not any(spark.catalog.tableExists(n) for n in ("told", "summed", "doubled")) and spark.catalog.tableExists("other")
    assert reg.names() == ["base", "other"]
    with pytest.raises(KeyError):
        reg.get("summed")
    with pytest.raises(KeyError):
        reg.drop("doubled")
    assert reg.drop("doubled", if_exists=True) == []
    reg.define("doubled", lambda g: g.get("base").selectExpr("id * 3 AS id"))  # defined anew, nothing reads it
    assert reg.drop("doubled") == ["doubled"]


def test_written_results_stand_in_until_their_input_changes(spark, reg):
    assert one(reg.get("told")) == 13
    reg.replace("summed", spark.sql("SELECT 100L AS total"))
    assert one(reg.get("told")) == 101  # built anew on the written table
    reg.replace("told", spark.sql("SELECT 7L AS total"))
    reg.replace("doubled", numbers(spark, 2))
    assert one(reg.get("summed")) == 100 and one(reg.get("told")) == 7  # written ones hold the same rows
    reg.define("doubled", lambda g: g.get("base").selectExpr("id + 1 AS id"))
    assert one(reg.get("summed")) == 10 and one(reg.get("told")) == 11
    with pytest.raises(KeyError):
        reg.replace("base", numbers(spark, 1))


def test_a_definition_that_breaks_a_reader_changes_nothing(spark, reg):
    reg.register()
    with pytest.raises(Exception, match="(?i)total|id"):
        reg.define("summed", lambda g: g.get("doubled").selectExpr("max(id) AS most"))
    assert one(spark.table("summed")) == 12 and one(spark.table("told")) == 13 and one(reg.get("told")) == 13


def test_views_that_read_each_other_are_refused(reg):
    with pytest.raises(DependencyError, match="doubled -> .*doubled"):
        reg.define("doubled", lambda g: g.get("told"), ["told"])
    assert one(reg.get("told")) == 13
    reg.define("ring", lambda g: g.get("ring"))
    with pytest.raises(DependencyError, match="ring -> ring"):
        reg.get("ring")


def test_order_puts_inputs_first_whatever_the_order_of_definition(spark):
    r = ViewRegistry(spark, {"base": numbers(spark, 1)})
    r.define_sql("last", "SELECT * FROM {middle}")
    r.define_sql("middle", "SELECT * FROM {first} CROSS JOIN (SELECT count(*) AS n FROM {base})")
    r.define_sql("first", "SELECT * FROM {base}")
    assert r.order() == ["first", "middle", "last"] and r.dependants("first") == ["middle", "last"]
    assert r.get("last").columns == ["id", "n"]


def test_declared_reads_of_the_named_results_are_what_they_ask_for(spark, smoke_dir):
    tables = {"property_tax": B.property_tax(spark, smoke_dir), "building_permits": B.building_permits(spark, smoke_dir),
              "business_licenses": B.business_licenses(spark, smoke_dir), "boundaries": B.boundaries(spark, smoke_dir)}
    reg = views.build_registry(spark, tables)
    assert reg.dependants("business_size_by_postal_code") == ["combined_by_postal_code", "combined_by_local_area", "investment_land_value_followup", "investment_vs_land_value"]
    assert reg.dependants("boundaries") == ["area_map"] and len(reg.order()) == 17
    declared = {n: reg.reads(n) for n in reg.order()}
    for n in ("combined_by_local_area", "investment_vs_land_value", "zoning_and_use_shares", "area_map"):
        reg.get(n)
    assert declared == {n: reg.reads(n) for n in reg.order()}
