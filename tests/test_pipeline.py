"""End to end: raw files -> cleaning jobs -> every named result, registered for SQL."""

import pytest
from pyspark.sql import functions as F

from landlens.contracts import PROPERTY_TAX
from landlens.plans import jobs, views
from landlens.session import scratch_path
from landlens.sources import declare_table, export_csv, write_table
from tests.test_clean import PERMIT_HEADER, _permit_line

@pytest.fixture(scope="module")
def cleaned(spark):
    root = scratch_path(spark, "pipeline")
    # property tax (Parquet, text columns): postal A in two years, B one year
    cols = PROPERTY_TAX.source_columns
    tax_rows = []
    for pid, postal, year, land, zoning in [("1", "V6E 3T1", "2016", "100", "Residential"),
                                            ("2", "V6E 3T1", "2016", "50", "Commercial"),
                                            ("1", "V6E 3T1", "2017", "110", "Residential"),
                                            ("3", "V5K 0A1", "2016", "70", "Other")]:
        r = dict.fromkeys(cols, "x")
        r.update(PID=pid, PROPERTY_POSTAL_CODE=postal, REPORT_YEAR=year, TAX_ASSESSMENT_YEAR=year,
                 CURRENT_LAND_VALUE=land, CURRENT_IMPROVEMENT_VALUE="5", PREVIOUS_LAND_VALUE="1",
                 PREVIOUS_IMPROVEMENT_VALUE="1", YEAR_BUILT="1990", BIG_IMPROVEMENT_YEAR="2000",
                 TAX_LEVY="2", ZONING_CLASSIFICATION=zoning, STREET_NAME="Main")
        tax_rows.append(tuple(r[c] for c in cols))
    spark.createDataFrame(tax_rows, ", ".join(f"{c} string" for c in cols)) \
        .write.parquet(f"{root}/tax")
    # licences (Parquet)
    lic = spark.createDataFrame(
        [("16", "Issued", "d", "Shop A", None, "t", "s", "V6E 3T1", "Main", "Downtown", "4"),
         ("16", "Issued", "d", "Shop B", None, "t", "s", "V6E 3T1", "Main", "Downtown", "6"),
         ("17", "Issued", "d", "Shop A", None, "t", "s", "V6E 3T1", "Main", "Downtown", "5"),
         ("16", "Issued", "d", "Shop C", None, "t", "s", "V5K 0A1", "Oak", "Westside", "2")],
        "folderyear string, status string, issueddate string, businessname string, "
        "businesstradename string, businesstype string, businesssubtype string, postalcode string, "
        "street string, localarea string, numberofemployees string")
    lic.write.parquet(f"{root}/lic")
    # permits (delimited)
    lines = [";".join(PERMIT_HEADER),
             _permit_line(PermitNumber="P1", IssueYear="2016", IssueDate="2016-02-01", GeoLocalArea="Downtown"),
             _permit_line(PermitNumber="P2", IssueYear="2016", IssueDate="2016-03-01", GeoLocalArea="Westside"),
             _permit_line(PermitNumber="P3", IssueYear="2017", IssueDate="2017-03-01", GeoLocalArea="Downtown",
                          Address="9 Oak St V5K 0A1", PropertyUse="Office Uses")]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.text(f"{root}/permits")
    out = jobs.run_cleaning(spark, tax_path=f"{root}/tax", permits_csv_path=f"{root}/permits",
                            licences_path=f"{root}/lic", target=f"{root}/clean")
    return out


def test_cleaning_writes_and_rereads(cleaned):
    assert cleaned["property_tax"].count() == 4
    assert cleaned["business_licenses"].count() == 4
    assert cleaned["building_permits"].count() == 3
    assert "POSTAL_CODE" in cleaned["building_permits"].columns


def test_registry_builds_every_result(spark, cleaned):
    reg = views.build_registry(spark, cleaned)
    names = reg.register()
    counts = {n: spark.sql(f"SELECT COUNT(*) AS n FROM {n}").first().n for n in names}
    assert counts["combined_by_postal_code"] == 4                  # (V6E,2016): 1 x 2, others 1 x 1
    assert counts["investment_land_value_followup"] == 1          # V6E 3T1: 2016 -> 2017
    assert counts["property_tax_by_report_year_local_area_view"] > 0
    assert counts["combined_building_permits_property_tax_view"] > 0
    fol = spark.sql("SELECT * FROM investment_land_value_followup").first()
    assert (fol.INVESTMENT_YEAR, fol.FOLLOWUP_YEAR) == (2016, 2017)
    # tie-break (area, then zoning): 'Commercial' < 'Residential' picks land 50 for 2016
    assert float(fol.PERCENT_CHANGE_IN_LAND_VALUE) == pytest.approx(120.0)      # 50 -> 110
    v9 = spark.sql("SELECT * FROM combined_building_permits_property_tax_view "
                   "WHERE YEAR = 2016 AND LOCAL_AREA = 'Downtown'").first()
    # V7 fan-out: postal V6E 3T1 has 3 tax rows and 1 Downtown permit -> weight 3;
    # V5K 0A1 ('Other') has 1 tax row and 1 Downtown permit -> weight 1
    assert v9.residential_zoning_count == 3 and v9.non_residential_zoning_count == 3 + 1


def test_postal_result_and_shares(spark, cleaned):
    reg = views.build_registry(spark, cleaned)
    v12 = reg.get("property_and_permits_grouped")
    rows = {r.postal_code: r for r in v12.collect()}
    assert rows["V6E 3T1"].latitude == pytest.approx(49.2)
    assert rows["V5K 0A1"].property_use == "non-residential"      # 'Office Uses'
    shares = reg.get("zoning_and_use_shares").collect()
    for r in shares:
        tot = (r.residential_zoning_share or 0) + (r.non_residential_zoning_share or 0)
        assert tot == pytest.approx(100.0, abs=0.11) or r.residential_zoning_share is None


def test_declare_and_write_table(spark, cleaned):
    name = "property_tax_t"
    loc = scratch_path(spark, "warehouse-table")
    declare_table(spark, name, PROPERTY_TAX, location=loc)
    assert spark.table(name).columns == PROPERTY_TAX.columns
    write_table(cleaned["property_tax"], name, mode="append")
    write_table(cleaned["property_tax"], name, mode="append")
    assert spark.table(name).count() == 8                          # append loads again
    write_table(cleaned["property_tax"], name + "_o", mode="overwrite")
    write_table(cleaned["property_tax"], name + "_o", mode="overwrite")
    assert spark.table(name + "_o").count() == 4                   # overwrite does not


def test_export_single_and_parallel(spark, cleaned):
    v = cleaned["business_licenses"]
    p1, p2 = scratch_path(spark, "exp1"), scratch_path(spark, "exp2")
    export_csv(v, p1, single_file=True)
    export_csv(v.repartition(3), p2, sep=";")
    files1 = [f for f in spark.sparkContext.wholeTextFiles(p1).keys().collect() if f.endswith(".csv")]
    assert len(files1) == 1
    back = spark.read.option("header", True).option("sep", ";").csv(p2)
    assert back.count() == 4 and back.where(F.col("BUSINESS_NAME") == "Shop C").count() == 1


def test_run_all_writes_every_result(spark, cleaned):
    import os
    from landlens.plans.run import run_all
    root = scratch_path(spark, "run-all")
    # reuse the cleaned tables as raw inputs of the same layout is not possible
    # (they are typed), so write the fixture's raw files again via the fixture root
    clean_root = os.path.dirname(cleaned["property_tax"].inputFiles()[0].replace("file:", "")).rsplit("/clean", 1)[0]
    written = run_all(spark, root, tax_path=f"{clean_root}/tax", licences_path=f"{clean_root}/lic",
                      permits_csv_path=f"{clean_root}/permits")
    assert "investment_vs_land_value" in written and "investment_vs_land_value.csv" in written
    back = spark.read.parquet(written["combined_building_permits_property_tax_view"])
    assert back.count() > 0
    bridge = {(r.POSTAL_CODE, r.LOCAL_AREA): int(r.n_rows) for r in spark.read.parquet(written["postal_code_local_area_view"]).collect()}
    assert bridge[("V6E 3T1", "Downtown")] == 3             # compressed: 3 tax rows x 1 permit
    assert {r.outcome: r.n_rows for r in spark.read.parquet(f"{root}/clean/outcomes/business_licenses").collect()} == {"kept": 4}
    assert jobs.rejected(spark, f"{root}/clean", "building_permits").count() == 0
    assert spark.read.parquet(f"{root}/clean/audit/property_tax").where("check = 'row_count'").first().violations == 4
    area_csv = spark.read.option("header", True).csv(written["investment_vs_land_value.csv"])
    assert set(area_csv.columns) >= {"local_area", "percent_change_in_land_value"}


def test_run_all_on_a_stored_layout(spark, cleaned):
    import os
    from landlens.plans.run import run_all
    raw = os.path.dirname(cleaned["property_tax"].inputFiles()[0].replace("file:", "")).rsplit("/clean", 1)[0]
    given = dict(tax_path=f"{raw}/tax", licences_path=f"{raw}/lic", permits_csv_path=f"{raw}/permits")
    plain = run_all(spark, scratch_path(spark, "run-plain"), **given)
    stored = run_all(spark, scratch_path(spark, "run-layout"), layout="run_layout", buckets=3, **given)
    for name in ("combined_by_postal_code", "property_and_permits_grouped", "investment_vs_land_value"):
        one, two = (sorted(map(repr, spark.read.parquet(p[name]).collect())) for p in (plain, stored))
        assert one == two
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition", "true") == "true"


def test_command_line(spark, cleaned, capsys):
    import os
    from landlens.plans.run import main
    raw = os.path.dirname(cleaned["property_tax"].inputFiles()[0].replace("file:", "")).rsplit("/clean", 1)[0]
    out = scratch_path(spark, "cli")
    main(["--out", out, "--tax", f"{raw}/tax", "--licences", f"{raw}/lic", "--permits-csv", f"{raw}/permits"])
    printed = capsys.readouterr().out
    assert "investment_vs_land_value.csv" in printed
    assert spark.read.parquet(f"{out}/results/investment_land_value_followup").count() == 1
