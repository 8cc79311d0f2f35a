"""Cleaning jobs and sources/sinks on literal rows (fixtures F1, F2, F4)."""

from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from landlens.contracts import BUILDING_PERMITS, BUSINESS_LICENSES, PROPERTY_TAX
from landlens.operators import clean
from landlens.plans import jobs
from landlens.session import scratch_path
from landlens.sources import export_csv, read_delimited, read_result


def _tax_raw(spark):
    cols = PROPERTY_TAX.source_columns
    base = {c: "x" for c in cols}
    base.update(PID="1", PROPERTY_POSTAL_CODE="V6E 3T1", CURRENT_LAND_VALUE="12",
                CURRENT_IMPROVEMENT_VALUE="5", TAX_ASSESSMENT_YEAR="2020", PREVIOUS_LAND_VALUE="10",
                PREVIOUS_IMPROVEMENT_VALUE="4", YEAR_BUILT="1990", BIG_IMPROVEMENT_YEAR="2000",
                TAX_LEVY="1.5", REPORT_YEAR="2020", ZONING_CLASSIFICATION="Residential")
    rows = [dict(base),                                   # kept
            dict(base),                                   # exact copy -> one stays
            {**base, "CURRENT_LAND_VALUE": "12.0"},       # equal only after the cast -> both stay
            {**base, "PID": "2", "LEGAL_TYPE": None},     # null in an optional column -> dropped
            {**base, "PID": "3", "YEAR_BUILT": "19x0"}]   # bad int -> null, row stays
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows],
                                 ", ".join(f"{c} string" for c in cols))


def test_property_tax_job(spark):
    out = jobs.clean_property_tax(_tax_raw(spark))
    assert out.columns == PROPERTY_TAX.columns
    assert dict(out.dtypes)["CURRENT_LAND_VALUE"] == "decimal(18,2)"
    got = sorted((r.PID, r.CURRENT_LAND_VALUE, r.YEAR_BUILT) for r in out.collect())
    assert got == [("1", Decimal("12.00"), 1990), ("1", Decimal("12.00"), 1990), ("3", Decimal("12.00"), None)]


def _licence_raw(spark):
    cols = BUSINESS_LICENSES.source_columns
    base = dict(zip(cols, ["16", "Issued", "2016-01-01", "Shop", None, "Retail", "Food",
                           "V6E 3T1", "Main", "Downtown", "3.9"]))
    rows = [dict(base), dict(base),                                  # copies both stay
            {**base, "folderyear": None}, {**base, "postalcode": None},
            {**base, "businessname": None},                          # dropped (required)
            {**base, "folderyear": "xx"},                            # dropped after the cast
            {**base, "businessname": "n" * 300, "numberofemployees": "x"},
            {**base, "businessname": "m" * 255, "numberofemployees": "3.0"}]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows],
                                 ", ".join(f"{c} string" for c in cols))


def test_business_licences_job(spark):
    raw = _licence_raw(spark)
    out = jobs.clean_business_licenses(raw)
    assert out.columns == BUSINESS_LICENSES.columns
    got = sorted(((len(r.BUSINESS_NAME), r.NUMBER_OF_EMPLOYEES, r.FOLDER_YEAR, r.BUSINESS_TRADE_NAME)
                  for r in out.collect()), key=repr)
    assert got == sorted([(4, 3, 16, None), (4, 3, 16, None), (255, 3, 16, None), (255, None, 16, None)],
                         key=repr)
    # every row read is kept or counted under its reason, and the rejected rows are at hand
    assert {r.outcome: r.n_rows for r in jobs.licence_outcomes(raw).collect()} == {
        "kept": 4, "missing:FOLDER_YEAR": 1, "missing:POSTAL_CODE": 1, "missing:BUSINESS_NAME": 1, "unparsable:FOLDER_YEAR": 1}
    assert sorted(r.reason for r in jobs.rejected_business_licenses(raw).collect())[-1] == "unparsable:FOLDER_YEAR"
    # audit on the conformed, unfiltered frame counts the rejected rows
    audit = {(r.check, r.subject): r.violations for r in
             clean.audit(clean.conform(clean.rename_columns(raw, BUSINESS_LICENSES.rename_map()),
                                       BUSINESS_LICENSES),
                         BUSINESS_LICENSES.required, BUSINESS_LICENSES.key).collect()}
    assert audit[("row_count", "*")] == 8
    assert audit[("not_null", "FOLDER_YEAR")] == 2
    assert audit[("not_null", "POSTAL_CODE")] == 1
    assert audit[("duplicate_key_groups", "POSTAL_CODE,BUSINESS_NAME")] == 1


PERMIT_HEADER = ["PermitNumber", "PermitNumberCreatedDate", "IssueDate", "PermitElapsedDays", "ProjectValue",
                 "TypeOfWork", "Address", "ProjectDescription", "PermitCategory", "Applicant",
                 "ApplicantAddress", "PropertyUse", "SpecificUseCategory", "BuildingContractor",
                 "BuildingContractorAddress", "IssueYear", "GeoLocalArea", "Geom", "YearMonth", "geo_point_2d"]


def _permit_line(**kw):
    base = dict.fromkeys(PERMIT_HEADER, "z")
    base.update(PermitNumber="BP-1", IssueDate="2021-03-04", ProjectValue="1000.5", TypeOfWork="New",
                Address="1 Main St, Centre City V6E 3T1", PermitCategory="C", PropertyUse="Dwelling Uses",
                SpecificUseCategory="House", IssueYear="2021", GeoLocalArea="Downtown",
                Geom='{"coordinates":[-123.1,49.2],"type":"Point"}', YearMonth="2021-03",
                geo_point_2d="49.2, -123.1")
    base.update(kw)
    out = []
    for h in PERMIT_HEADER:
        v = base[h]
        if v is None:
            out.append("")
        else:
            out.append('"' + v.replace("\\", "\\\\").replace('"', '\\"') + '"')
    return ";".join(out)


def test_permits_csv_job(spark, tmp_path):
    lines = [";".join(PERMIT_HEADER),
             _permit_line(),
             _permit_line(),                                              # exact copy
             _permit_line(PermitNumber="BP-2", Address="no code; here"),  # '' postal code, kept
             _permit_line(PermitNumber="BP-3", Address="line one\nV5K 0A1 line two"),
             _permit_line(PermitNumber="BP-4", Address=None),             # null address -> dropped
             _permit_line(PermitNumber="BP-5", IssueDate="not a date", ProjectValue="say \"5\"")]
    p = tmp_path / "permits.csv"
    p.write_text("\n".join(lines) + "\n")
    raw = read_delimited(spark, str(p), sep=";", multiline=True)
    out = jobs.clean_building_permits(raw)
    none = jobs.clean_building_permits(raw, no_code_as_null=True)
    assert {r.permit_number: r.postal_code for r in none.collect()}["BP-2"] is None and none.count() == 4
    assert out.columns == BUILDING_PERMITS.columns + ["postal_code"]
    got = {r.permit_number: (r.postal_code, r.issue_date, r.project_value) for r in out.collect()}
    assert sorted(got) == ["BP-1", "BP-2", "BP-3", "BP-5"]
    assert got["BP-1"][0] == "V6E 3T1" and got["BP-1"][2] == Decimal("1000.50")
    assert got["BP-2"][0] == ""
    assert got["BP-3"][0] == "V5K 0A1"
    assert got["BP-5"][1] is None and got["BP-5"][2] is None
    assert out.count() == 4


def test_csv_round_trip_keeps_separator_quotes_newlines(spark):
    df = spark.createDataFrame(
        [(1, 'a;b "quoted" \\ back', '{"type":"Point","coordinates":[-123.1,49.2]}', "two\nlines"),
         (2, "plain", None, "x")], "id int, t string, g string, m string")
    path = scratch_path(spark, "roundtrip")
    export_csv(df, path, sep=";", single_file=True)
    back = read_result(spark, path, df.schema, sep=";", multiline=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert len([f for f in spark.sparkContext.wholeTextFiles(path).keys().collect()
                if f.endswith(".csv")]) == 1


def test_columnar_permits_job(spark):
    cols = ["issueDate", "projectValue", "typeOfWork", "address", "permitCategory", "propertyUse",
            "specificUseCategory", "issueYear", "yearMonth", "geom", "geoLocalArea", "extra"]
    df = spark.createDataFrame([("2020-01-02", "10", "New", "V6E 3T1", "C", "Dwelling Uses", "H", "2020",
                                 "2020-01", "{}", "Downtown", "ignored")], ", ".join(f"{c} string" for c in cols))
    out = jobs.permits_view_table(jobs.clean_building_permits_columnar(df))
    r = out.first()
    assert r.POSTAL_CODE == "V6E 3T1" and r.ISSUE_YEAR == 2020 and r.PROJECT_VALUE == Decimal("10.00")
    assert "extra" not in out.columns


def test_segment_filter_keeps_nulls_in_other(spark):
    df = spark.createDataFrame([("residential",), ("commercial",), (None,)], "property_use string")
    n = {s: clean.segment_filter(df, s).count() for s in ("both", "residential", "non-residential")}
    assert n == {"both": 3, "residential": 1, "non-residential": 2}


def test_preview_is_ordered(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("k"))
    got = [r.id for r in clean.preview(df, 3, [F.col("k").desc(), F.col("id")]).collect()]
    assert got == [6, 13, 20]


def test_audit_reads_its_table_once(spark, smoke_dir):
    li = spark.read.parquet(f"{smoke_dir}/lineitem.parquet")
    p = clean.audit(li, ["l_orderkey", "l_partkey"], ["l_orderkey"])._jdf.queryExecution().executedPlan().toString()
    assert p.count("FileScan") == 1
    assert [tuple(r) for r in clean.audit(li.limit(0), ["l_orderkey"], ["l_orderkey"]).collect()] == [
        ("row_count", "*", 0), ("not_null", "l_orderkey", 0), ("duplicate_key_groups", "l_orderkey", 0), ("duplicate_key_rows", "l_orderkey", 0)]


def _geojson(kind, coordinates):
    return f'{{"type":"{kind}","coordinates":{coordinates}}}'


BOX = "[[0,0],[4,0],[4,2],[0,2],[0,0]]"
HOLE = "[[1,0.5],[2,0.5],[2,1.5],[1,1.5],[1,0.5]]"


def test_boundaries_and_centroids(spark):
    from landlens.operators.geometry import with_centroid
    from landlens.sources import boundaries_from_geojson
    rows = [("box", _geojson("Polygon", f"[{BOX}]")), ("hole", _geojson("Polygon", f"[{BOX},{HOLE}]")),
            ("two", _geojson("MultiPolygon", f"[[{BOX}],[[[10,0],[14,0],[14,2],[10,2]]]]")),
            ("empty ring", _geojson("Polygon", "[[]]")), ("no ring", _geojson("Polygon", "[]")), ("no polygon", _geojson("MultiPolygon", "[]")),
            ("short ring", _geojson("Polygon", "[[[0,0],[1,1]]]")), ("one number", _geojson("Polygon", "[[[0],[1,1],[2,0]]]")),
            ("line", _geojson("LineString", "[[0,0],[1,1]]")), ("broken", "not json"), ("null", None)]
    shapes = boundaries_from_geojson(spark.createDataFrame(rows, "name string, geojson string"))
    got = {r.name: (r.x, r.y) for r in with_centroid(shapes, project=False, x_col="x", y_col="y").collect()}
    assert got["box"] == pytest.approx((2, 1)) and got["two"] == pytest.approx((7, 1))
    assert got["hole"] == pytest.approx((2.0714, 1), abs=1e-4)
    assert all(got[n] == (None, None) for n in got if n not in ("box", "two", "hole")) and len(got) == 11
    assert {r.name for r in shapes.where("polygons IS NULL").collect()} == set(got) - {"box", "two", "hole"}      # what an audit counts


def test_delimited_empty_fields(spark, tmp_path):
    p = tmp_path / "e.csv"
    p.write_text('a;b;c\n1;;x\n2;"";y\n')
    default = [tuple(r) for r in read_delimited(spark, str(p)).collect()]
    keep = [tuple(r) for r in read_delimited(spark, str(p), empty_as_null=False).collect()]
    assert default == [("1", None, "x"), ("2", None, "y")]
    assert keep == [("1", None, "x"), ("2", "", "y")]     # only the quoted empty stays ''


def test_enforce_contract_matches_licence_job(spark):
    raw = _licence_raw(spark)
    renamed = clean.rename_columns(raw, BUSINESS_LICENSES.rename_map())
    a = clean.enforce_contract(renamed, BUSINESS_LICENSES)
    b = jobs.clean_business_licenses(raw)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert [f.nullable for f in BUSINESS_LICENSES.schema().fields][:1] == [False]


def test_sorted_followup_puts_null_area_last(spark):
    from landlens.operators.followup import sorted_followup
    df = spark.createDataFrame([(None, "A", 2016, 2017), ("North", "B", 2016, 2018), ("Alpha", "C", 2016, 2017)],
                               "LOCAL_AREA string, POSTAL_CODE string, INVESTMENT_YEAR int, FOLLOWUP_YEAR int")
    assert [r.LOCAL_AREA for r in sorted_followup(df).collect()] == ["Alpha", "North", None]
