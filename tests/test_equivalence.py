"""Rewrites R1-R4 against their naive forms (exceptAll both ways must be empty)."""

import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from landlens.operators import aggregate, correlate, fanout, followup, joins
from landlens.plans import bindings as B
from landlens.plans import views


def same_bag(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _tax(spark, rows):
    return spark.createDataFrame(
        [(pid, postal, zoning, street, Decimal(land), Decimal(impr), Decimal(levy), year)
         for pid, postal, zoning, street, land, impr, levy, year in rows],
        "PID string, PROPERTY_POSTAL_CODE string, ZONING_CLASSIFICATION string, STREET_NAME string, "
        "CURRENT_LAND_VALUE decimal(18,2), CURRENT_IMPROVEMENT_VALUE decimal(18,2), TAX_LEVY decimal(18,2), "
        "REPORT_YEAR int")


def _permits(spark, rows):
    return spark.createDataFrame(rows, "POSTAL_CODE string, GEO_LOCAL_AREA string")


@pytest.fixture(scope="module")
def join_fixture(spark):
    """postal A in two areas (fan-out), a zero value, postal only on one side each."""
    tax = _tax(spark, [
        ("1", "A", "Residential", "Main", "100.00", "10.00", "1.00", 2020),
        ("2", "A", "Commercial", "Main", "0.00", "20.00", "2.00", 2020),
        ("3", "A", "Residential", "Oak", "300.00", "30.00", "3.00", 2021),
        ("4", "B", "Other", "Elm", "400.00", "40.00", "4.00", 2020),
        ("5", "C", "Residential", "Pine", "500.00", "50.00", "5.00", 2021),   # no permits
    ])
    permits = _permits(spark, [("A", "North"), ("A", "North"), ("A", "South"), ("B", "South"),
                               ("B", None), ("D", "North")])                  # D: no tax rows
    return tax, permits


@pytest.mark.parametrize("weighting", ["fanout", "distinct"])
def test_r1_equals_naive_on_fixture(join_fixture, weighting):
    tax, permits = join_fixture
    a = fanout.property_tax_by_year_area(tax, permits, weighting=weighting)
    b = fanout.property_tax_by_year_area_naive(tax, permits, distinct=weighting == "distinct")
    assert same_bag(a, b)
    assert a.count() == 5   # (2020,North),(2020,South),(2021,North),(2021,South),(2020,None)


def test_r1_fanout_weights(join_fixture):
    tax, permits = join_fixture
    got = {(r.YEAR, r.LOCAL_AREA): r.residential_zoning_count for r in
           fanout.property_tax_by_year_area(tax, permits).collect()}
    # postal A has 3 tax rows and 2 permits in North: each tax row counts 3*2 = 6 times
    assert got[(2020, "North")] == 6
    assert fanout.bridge_row_count(tax, permits).first().total_rows == \
        fanout.postal_area_bridge(tax, permits).count() == 3 * 3 + 1 * 2


def test_r1_equals_naive_on_test_tables(spark, smoke_dir):
    tax, permits = B.property_tax(spark, smoke_dir), B.building_permits(spark, smoke_dir)
    a = fanout.property_tax_by_year_area(tax, permits, B.ZONING_AREA_T)
    b = fanout.property_tax_by_year_area_naive(tax, permits, B.ZONING_AREA_T)
    assert a.count() > 0 and same_bag(a, b)


def groups_fixture(spark, licences, taxes):
    """V1 rows (postal, folder year, street, area, employees, businesses) and V2 rows (postal, year, zoning, street, land)."""
    v1 = spark.createDataFrame(licences, "POSTAL_CODE string, FOLDER_YEAR int, STREET_NAME string, LOCAL_AREA string, "
                                         "TOTAL_EMPLOYEES long, TOTAL_BUSINESSES long")
    v2 = spark.createDataFrame(
        [(p, y, z, s, Decimal("1.00"), None if land is None else Decimal(land), Decimal("2.00"), Decimal("3.50")) for p, y, z, s, land in taxes],
        "POSTAL_CODE string, REPORT_YEAR int, ZONING_CLASSIFICATION string, STREET_NAME string, "
        "TOTAL_PREVIOUS_LAND_VALUE decimal(28,2), TOTAL_CURRENT_LAND_VALUE decimal(28,2), "
        "TOTAL_PREVIOUS_IMPROVEMENT_VALUE decimal(28,2), TOTAL_CURRENT_IMPROVEMENT_VALUE decimal(28,2)")
    return v1, v2


def _groups(spark):
    return groups_fixture(spark, [
        ("A", 16, "Main", "North", 5, 1), ("A", 16, "Oak", "North", 7, 2),      # tie on the area
        ("A", 16, "Elm", "South", 1, 1), ("A", 17, "Main", "North", 3, 1),
        ("A", 19, "Main", None, 3, 1), ("A", 22, "Main", "North", None, 1),     # gap of 6 from 2016
        ("B", 16, "Elm", "East", 2, 1), ("B", 21, "Elm", "East", 2, 1), ("C", 16, "Elm", "East", 9, 9)],
        [("A", 2016, "R", "Main", "100"), ("A", 2016, "R", "Oak", "70"), ("A", 2016, "S", "Main", "90"),
         ("A", 2017, "R", "Main", "0"), ("A", 2019, "R", "Main", "120"), ("A", 2022, "R", "Main", "150"),
         ("B", 2016, "R", "Elm", "50"), ("B", 2021, None, "Elm", None), ("B", 2021, "R", "Elm", "75")])


@pytest.mark.parametrize("strategy", ["frame", "explode", "range"])
def test_r2_r3_equal_literal_window(spark, strategy):
    v1, v2 = _groups(spark)
    ref = followup.investment_land_value_followup_naive(joins.combined_by_postal_code(v1, v2))
    got = followup.investment_land_value_followup(v1, v2, strategy=strategy)
    assert same_bag(ref, got)
    pairs = sorted((r.POSTAL_CODE, r.INVESTMENT_YEAR, r.FOLLOWUP_YEAR) for r in got.collect())
    assert pairs == [("A", 2016, 2017), ("A", 2016, 2019), ("A", 2017, 2019), ("A", 2017, 2022),
                     ("A", 2019, 2022), ("B", 2016, 2021)]
    pct = {(r.POSTAL_CODE, r.INVESTMENT_YEAR, r.FOLLOWUP_YEAR): r.PERCENT_CHANGE_IN_LAND_VALUE
           for r in got.collect()}
    assert pct[("A", 2017, 2019)] is None               # zero base
    assert pct[("A", 2016, 2017)] == Decimal("-100.00")  # tie-break picked the first street (100)


def test_followup_strategies_on_test_tables(spark, smoke_dir):
    v1, v2 = views.v1(B.business_licenses(spark, smoke_dir)), views.v2(B.property_tax(spark, smoke_dir))
    ref = followup.investment_land_value_followup_naive(joins.combined_by_postal_code(v1, v2))
    for s in ("frame", "explode", "range"):
        assert same_bag(ref, followup.investment_land_value_followup(v1, v2, strategy=s)), s


@pytest.mark.parametrize("avg_double", [False, True])
def test_area_rollup_equals_roll_up_of_the_join(spark, smoke_dir, avg_double):
    on_tables = views.v1(B.business_licenses(spark, smoke_dir)), views.v2(B.property_tax(spark, smoke_dir))
    for v1, v2 in (_groups(spark), on_tables):
        a = aggregate.combined_by_local_area(v1, v2, avg_double)
        b = aggregate.combined_by_local_area_naive(joins.combined_by_postal_code(v1, v2), avg_double)
        assert a.count() > 0 and same_bag(a, b)


def test_r1_survives_a_hot_postal_code(spark):
    """Three million tax rows and two million permits of one postal code, as weights."""
    wt = spark.createDataFrame([(3_000_000, 2_000_000)], "__n long, __m long").select(fanout._weight("fanout").alias("w"))
    got = wt.select((fanout._weighted(F.lit(3_000_000), F.col("w"))).alias("c"),
                    (fanout._weighted(F.lit(Decimal("123456789012.34")), F.col("w"), 2)).alias("s")).first()
    assert got.c == 18 * 10**18 and got.s == Decimal("123456789012.34") * 6 * 10**12


def test_positional_rank_equals_row_number(spark, smoke_dir):
    o = B.table(spark, smoke_dir, "orders").select(F.year("o_orderdate").alias("y"), "o_orderkey")
    got = correlate.positional_rank(o, ["y"], ["o_orderkey"], num_partitions=5)
    ref = o.withColumn("rn", F.row_number().over(Window.partitionBy("y").orderBy("o_orderkey")).cast("bigint"))
    assert same_bag(got.select("y", "o_orderkey", "rn"), ref.select("y", "o_orderkey", "rn"))


def test_rank_correlation_matches_pandas_loop(spark):
    """R4 against the nested year loop with positional pairing, in pandas."""
    rnd = random.Random(7)
    recs = []
    for year, n in ((2019, 30), (2020, 25), (2021, 1), (2022, 12)):
        for k in range(n):
            recs.append((f"P{year}{k:03d}", year, rnd.uniform(0, 100), rnd.uniform(0, 100),
                         rnd.choice(["residential", "commercial", None])))
    recs.append(("Z0", 2022, 5.0, None, "residential"))        # null value drops out of the pair
    df = spark.createDataFrame(recs, "postal_code string, year int, total_project_value double, "
                                     "total_land_value double, property_use string")
    got = {(r.segment, r.investment_year, r.value_year): r.corr
           for r in correlate.rank_pair_correlation(df).collect()}
    pdf = pd.DataFrame(recs, columns=["postal_code", "year", "x", "y", "use"]).sort_values("postal_code")
    for seg in ("both", "residential", "non-residential"):
        f = pdf if seg == "both" else (pdf[pdf.use == "residential"] if seg == "residential"
                                       else pdf[pdf.use != "residential"])
        years = sorted(f.year.unique())
        for a in years:
            for b in years:
                if b < a:
                    continue
                xa = f[f.year == a].x.reset_index(drop=True)
                yb = f[f.year == b].y.reset_index(drop=True)
                want = xa.corr(yb)
                have = got[(seg, int(a), int(b))]
                if pd.isna(want):
                    assert have is None, (seg, a, b)
                else:
                    assert have == pytest.approx(want, abs=1e-9), (seg, a, b)


def test_correlation_matrix_is_upper_triangular(spark, smoke_dir):
    years = list(range(1990, 2005))
    m = correlate.correlation_matrix(correlate.rank_pair_correlation(B.postal_results(spark, smoke_dir)), years)
    assert m.columns == ["segment", "investment_year", *map(str, years)]
    rows = m.collect()
    assert {r.segment for r in rows} == {"both", "residential", "non-residential"}
    for r in rows:
        assert all(r[str(y)] is None for y in years if y < r.investment_year)
        assert r[str(r.investment_year)] is not None


def test_two_zoning_maps_disagree_on_purpose(spark):
    """Q7: 'Multiple Dwelling' is residential in the area roll-up (V7) but
    non-residential in the postal profile (V10); 'Comprehensive Development'
    is non-residential in V7 but 'mixed' in V10; V10 takes the lexicographic max."""
    tax = _tax(spark, [
        ("1", "A", "Multiple Dwelling", "Main", "1.00", "1.00", "1.00", 2020),
        ("2", "B", "Comprehensive Development", "Main", "1.00", "1.00", "1.00", 2020),
        ("3", "C", "Commercial", "Main", "1.00", "1.00", "1.00", 2020),
        ("4", "C", "Residential", "Main", "1.00", "1.00", "1.00", 2020),     # max -> 'Residential'
        ("5", "D", "Nowhere", "Main", "1.00", "1.00", "1.00", 2020)])
    permits = _permits(spark, [("A", "X"), ("B", "Y"), ("C", "Z"), ("D", "Z")])
    v7 = {r.LOCAL_AREA: (r.residential_zoning_count, r.non_residential_zoning_count)
          for r in views.v7(tax, permits).collect()}
    assert v7["X"] == (1, 0) and v7["Y"] == (0, 1)
    v10 = {r.PROPERTY_POSTAL_CODE: r.ZONING for r in views.v10(tax.withColumn(
        "TAX_ASSESSMENT_YEAR", F.lit(2020)).withColumn("YEAR_BUILT", F.lit(1990))
        .withColumn("BIG_IMPROVEMENT_YEAR", F.lit(2000))).collect()}
    assert v10 == {"A": "non-residential", "B": "mixed", "C": "residential", "D": "unknown"}


def test_gather_and_join_strategies_agree(spark, smoke_dir):
    pr = B.postal_results(spark, smoke_dir)
    a = correlate.rank_pair_correlation(pr, digits=9)
    b = correlate.rank_pair_correlation(pr, digits=9, strategy="join")
    assert a.count() == 84 and same_bag(a, b)


def test_segment_ranks_equal_row_numbers_in_both_groupings(spark, smoke_dir):
    df = B.postal_results(spark, smoke_dir).select("postal_code", "year", F.coalesce("property_use", F.lit("none")).alias("use")).repartition(7)
    got = correlate.segment_ranks(df, "year", ["postal_code"], "use", num_partitions=5)
    w = Window.orderBy("postal_code")
    want = df.select("*", F.row_number().over(w.partitionBy("year")).cast("bigint").alias("rn_all"), F.row_number().over(w.partitionBy("year", "use")).cast("bigint").alias("rn_own"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    held = got._jdf.queryExecution().toString()
    assert got.count() == df.count() and "Generate" not in held  # rows are checkpointed once


def test_segment_ranks_of_tied_keys_are_a_numbering(spark):
    df = spark.range(3000).select((F.col("id") % 3).cast("int").alias("y"), F.lit("k").alias("k"), (F.col("id") % 2).cast("string").alias("s"), "id")
    got = correlate.segment_ranks(df, "y", ["k"], "s", num_partitions=6).collect()
    for y in range(3):
        mine = [r for r in got if r.y == y]
        assert sorted(r.rn_all for r in mine) == list(range(1, 1001))
        for s in "01":
            own = sorted((r.rn_own, r.rn_all) for r in mine if r.s == s)
            assert [a for a, _ in own] == list(range(1, 501)) and [b for _, b in own] == sorted(b for _, b in own)  # one order for both
