"""Loads: rows of several loads are built once, small tables are joined without a shuffle of the lines."""

import pytest
from pyspark.sql import functions as F

from landlens.plans import bindings as B
from landlens.plans import driver
from landlens.session import conf_for


@pytest.fixture
def tables(spark, tmp_path):
    """Some rows of each table that licences and permits are made of, with a null, a missing and a repeated key."""
    day = F.to_timestamp(F.lit("1996-03-04"))
    key = F.col("id")
    made = {
        "nation": spark.range(3).select(key.alias("n_nationkey"), F.concat(F.lit("N"), key).alias("n_name"), key.alias("n_regionkey")),
        "customer": spark.range(5).select(key.alias("c_custkey"), F.when(key != 3, key % 4).alias("c_nationkey")),
        "supplier": spark.range(6).select((key % 5).alias("s_suppkey"), F.when(key != 2, key % 4).alias("s_nationkey")),
        "orders": spark.range(20).select(key.alias("o_orderkey"), F.when(key != 9, key % 7).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
                                         F.lit("5-LOW").alias("o_orderpriority"), F.lit(10.5).alias("o_totalprice"), day.alias("o_orderdate")),
        "lineitem": spark.range(90).select((key % 22).alias("l_orderkey"), key.alias("l_partkey"), (key % 7).alias("l_suppkey"), (key % 7 + 1).cast("int").alias("l_linenumber"),
                                           F.lit(3.0).alias("l_quantity"), F.lit(7.25).alias("l_extendedprice"), F.lit("R").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
                                           F.date_add(day, (key % 900).cast("int")).cast("timestamp").alias("l_shipdate")),
    }
    for name, df in made.items():
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.fixture
def counted(spark, monkeypatch):
    """The licences of the loads, with a count of how often a row of them was built."""
    built = spark.sparkContext.accumulator(0)

    def seen(text):
        built.add(1)
        return text

    mark = F.udf(seen, "string").asNondeterministic()
    lic = B.business_licenses
    monkeypatch.setattr(driver, "_lic", lambda s, d: lic(s, d).withColumn("BUSINESS_NAME", mark("BUSINESS_NAME")).fillna("0", ["POSTAL_CODE"]))
    return built


@pytest.mark.parametrize("query", ["table_load", "published_load"])
def test_rows_of_several_loads_are_built_once(spark, tables, counted, query):
    n = B.business_licenses(spark, tables).count()
    got = driver.QUERIES[query](spark, tables)
    assert got.count() > 0 and counted.value == n


@pytest.mark.parametrize("rows", [B.business_licenses, B.raw_building_permits])
def test_lines_are_not_shuffled_for_small_tables(spark, tables, rows):
    with conf_for(spark, {"spark.sql.autoBroadcastJoinThreshold": "100000", "spark.sql.adaptive.enabled": "false"}):
        plan = rows(spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_binding_rows_with_null_missing_and_repeated_keys(spark, tables):
    licences = B.business_licenses(spark, tables).groupBy("LOCAL_AREA").count().collect()
    orders = {k: (None if k == 9 else k % 7) for k in range(20)}
    area = {c: (f"N{c % 4}" if c != 3 and c % 4 < 3 else None) for c in range(5)}
    want = {}
    for i in range(90):
        if i % 22 in orders:
            a = area.get(orders[i % 22]) if i % 7 + 1 != 7 else None
            want[a] = want.get(a, 0) + 1
    assert {r.LOCAL_AREA: r["count"] for r in licences} == want
    permits = B.raw_building_permits(spark, tables).groupBy("GeoLocalArea").count().collect()
    suppliers = [(k % 5, None if k == 2 else k % 4) for k in range(6)]
    want = {}
    for i in range(90):
        for n in [n for k, n in suppliers if k == i % 7] or [None]:
            a = f"N{n}" if n is not None and n < 3 else None
            want[a] = want.get(a, 0) + 1
    assert {r.GeoLocalArea: r["count"] for r in permits} == want
