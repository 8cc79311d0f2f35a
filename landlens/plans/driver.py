"""Driver-facing queries: each operator/result bound to the test tables, with its oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> DuckDB SQL``.
Spark results are *published* (money decimals -> DOUBLE, dates -> ISO text)
so both engines return the same column types; see :mod:`landlens.plans.oracle`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landlens.contracts import BUSINESS_LICENSES, Field, TableContract
from landlens.functions.classify import class_of, indicator
from landlens.operators.geometry import with_centroid, with_projected_point
from landlens.functions.text import normalise_names, point_part
from landlens.operators import aggregate, clean, correlate, fanout, joins
from landlens.operators.followup import investment_land_value_followup, sorted_followup
from landlens.functions.numeric import percent_change
from landlens.plans import bindings as B
from landlens.plans import jobs
from landlens.plans import views
from landlens.plans import oracle as O
from landlens.plans.oracle import money, with_ctes
from landlens.session import discard, scratch_path
from landlens.plans.run import ORDERED
from landlens.sources.publish import publish as publish_run
from landlens.sources import (
    AuditFailed, declare_table, export_csv, heat_map_feed, published, read_delimited, read_ordered, read_result, stage, write_ordered, write_table,
)

OPT = views.ViewOptions(zoning_area=B.ZONING_AREA_T, zoning_postal=B.ZONING_POSTAL_T,
                        use_area=B.USE_AREA_T, use_postal=B.USE_POSTAL_T, avg_double=True)
MONEY = replace(OPT, avg_double=False)     # averages as money, the default of the views


def publish(df: DataFrame) -> DataFrame:
    """Decimals -> DOUBLE (exact sums convert identically in any engine), dates -> text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


_tax, _permits, _lic, _postal = B.property_tax, B.building_permits, B.business_licenses, B.postal_results


def _v1(s: SparkSession, d: str) -> DataFrame:
    return views.v1(_lic(s, d))


def _v2(s: SparkSession, d: str) -> DataFrame:
    return views.v2(_tax(s, d))


def _v9(s: SparkSession, d: str) -> DataFrame:
    return views.v9(_tax(s, d), _permits(s, d), OPT)


def _v12(s: SparkSession, d: str) -> DataFrame:
    return views.v12(_tax(s, d), _permits(s, d), OPT)


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------
def q_entity_year_size(s, d):
    return publish(views.v1(_lic(s, d)))


def q_entity_year_value(s, d):
    return publish(views.v2(_tax(s, d)))


def q_two_digit_year_join(s, d):
    return publish(views.v3(_lic(s, d), _tax(s, d)))


def q_area_rollup(s, d):
    return publish(views.v4(_v1(s, d), _v2(s, d), OPT))


def q_area_rollup_money(s, d):
    return publish(views.v4(_v1(s, d), _v2(s, d), MONEY))


def q_followup_band(s, d):
    t = _tax(s, d).groupBy(F.col("PROPERTY_POSTAL_CODE").alias("POSTAL_CODE"),
                           F.col("REPORT_YEAR").alias("YEAR")) \
        .agg(F.sum("CURRENT_LAND_VALUE").alias("LAND"))
    i = t.select("POSTAL_CODE", F.col("YEAR").alias("INVESTMENT_YEAR"),
                 F.col("LAND").alias("LAND_VALUE_IN_INVESTMENT_YEAR"))
    f = t.select("POSTAL_CODE", F.col("YEAR").alias("FOLLOWUP_YEAR"),
                 F.col("LAND").alias("LAND_VALUE_IN_FOLLOWUP_YEAR"))
    j = joins.band_join(i, f, "POSTAL_CODE", "INVESTMENT_YEAR", "FOLLOWUP_YEAR", strategy="range")
    return publish(j.select("POSTAL_CODE", "INVESTMENT_YEAR", "FOLLOWUP_YEAR",
                            "LAND_VALUE_IN_INVESTMENT_YEAR", "LAND_VALUE_IN_FOLLOWUP_YEAR",
                            percent_change(F.col("LAND_VALUE_IN_INVESTMENT_YEAR"),
                                           F.col("LAND_VALUE_IN_FOLLOWUP_YEAR"))
                            .alias("PERCENT_CHANGE_IN_LAND_VALUE")))


def q_followup_first(s, d):
    return publish(investment_land_value_followup(_v1(s, d), _v2(s, d), strategy="frame"))


def q_followup_equi(s, d):
    return publish(investment_land_value_followup(_v1(s, d), _v2(s, d), strategy="explode"))


def q_followup_range(s, d):
    return publish(investment_land_value_followup(_v1(s, d), _v2(s, d), strategy="range"))


def q_followup_rollup(s, d):
    return publish(views.v13(investment_land_value_followup(_v1(s, d), _v2(s, d))))


def q_followup_sorted(s, d):
    return publish(sorted_followup(views.v5(_v1(s, d), _v2(s, d), OPT)))


def q_bridge_size(s, d):
    return fanout.bridge_row_count(_tax(s, d), _permits(s, d))


def q_bridge_pairs(s, d):
    return views.v6(_tax(s, d), _permits(s, d), views.ViewOptions(weighting="distinct"))


def q_point_parse(s, d):
    pt = F.col("GEO_POINT_2D")
    return _permits(s, d).select("POSTAL_CODE", pt.alias("geo_point_2d"),
                                 point_part(pt, 1).alias("latitude"), point_part(pt, 2).alias("longitude"))


def q_trend_one_area(s, d):
    return views.v17(_v9(s, d), area=TREND_AREA)


def q_bridge_fanout_avg(s, d):
    return publish(views.v7(_tax(s, d), _permits(s, d), OPT))


def q_bridge_distinct_avg(s, d):
    return publish(views.v7(_tax(s, d), _permits(s, d), replace(OPT, weighting="distinct")))


def q_bridge_fanout_avg_money(s, d):
    return publish(views.v7(_tax(s, d), _permits(s, d), MONEY))


def q_class_counts_money(s, d):
    return publish(views.v8(_permits(s, d), MONEY))


def q_value_profile_money(s, d):
    return publish(views.v10(_tax(s, d), MONEY))


def q_activity_profile_money(s, d):
    return publish(views.v11(_permits(s, d), MONEY))


def q_class_counts(s, d):
    return publish(views.v8(_permits(s, d), OPT))


def q_combined_area_year(s, d):
    return publish(_v9(s, d))


def q_value_profile(s, d):
    return publish(views.v10(_tax(s, d), OPT))


def q_activity_profile(s, d):
    return publish(views.v11(_permits(s, d), OPT))


def q_postal_join(s, d):
    return publish(_v12(s, d))


def q_heat_feed(s, d):
    return publish(heat_map_feed(_v12(s, d)))


def q_rank_correlation(s, d):
    return correlate.rank_pair_correlation(_postal(s, d), digits=6)


def q_postal_correlation(s, d):
    return views.v14(_v12(s, d), digits=6)


MATRIX_YEARS = list(range(1995, 2002))


def q_correlation_matrix(s, d):
    return correlate.correlation_matrix(correlate.rank_pair_correlation(_postal(s, d), digits=6), MATRIX_YEARS)


def q_shares(s, d):
    return views.v15(_v9(s, d))


def q_trend(s, d):
    return views.v17(_v9(s, d))


def q_year_bounds(s, d):
    return aggregate.value_bounds(_tax(s, d), "REPORT_YEAR")


def q_distinct_values(s, d):
    return aggregate.distinct_values(_permits(s, d), "GEO_LOCAL_AREA")


def q_row_count(s, d):
    return aggregate.row_count(_lic(s, d))


def q_top_preview(s, d):
    v4 = views.v4(_v1(s, d), _v2(s, d), OPT)
    return publish(clean.preview(v4, 10, [F.col("LOCAL_AREA").asc_nulls_last(), F.col("YEAR").asc()]))


def q_clean_dedupe(s, d):
    li = B.table(s, d, "lineitem")
    u = clean.dedupe(li.unionByName(li.where("l_linenumber = 1")))     # a second delivery of the first lines
    return u.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n_rows"))


def q_text_dedupe(s, d):
    docs = clean.select_columns(B.table(s, d, "documents"), ["lang", "source", "text"])
    return clean.dedupe(docs)


def q_clean_dropna(s, d):
    o = B.table(s, d, "orders").select(
        "o_orderkey", "o_custkey", F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"),
        F.expr("nullif(o_orderpriority, '5-LOW')").alias("o_orderpriority"), "o_totalprice")
    return clean.drop_incomplete(o)


RAW_ORDER_CONTRACT = TableContract("raw_orders", (
    Field("order_id", T.IntegerType(), source="o_orderkey", required=True),
    Field("customer", T.StringType(), source="o_custkey"),
    Field("price", T.DecimalType(18, 2), source="o_totalprice"),
    Field("price_units", T.IntegerType(), source="price_text"),
    Field("order_date", T.DateType(), source="o_orderdate"),
    Field("priority_rank", T.IntegerType(), source="o_orderpriority"),
    Field("status", T.StringType(), source="o_orderstatus", max_length=1),
    Field("just_below", T.IntegerType(), source="just_below"),
))


def q_conform_types(s, d):
    o = B.table(s, d, "orders")
    raw = o.select(*[F.col(c).cast("string").alias(c) for c in
                     ("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")],
                   F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"),
                   F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price_text"),
                   F.concat(F.col("o_custkey").cast("string"), F.lit(".9999999")).alias("just_below"))
    return publish(clean.conform(raw, RAW_ORDER_CONTRACT))


def q_truncate_text(s, d):
    p = B.table(s, d, "pages")
    return clean.truncate_columns(p.select("page_id", "html"), ["html"], 255)


def q_extract_code(s, d):
    p = B.table(s, d, "pages").select("page_id", "url")
    return clean.with_postal_code(p, "url", "code", pattern=r"page=([0-9]+)")


def q_extract_postal_code(s, d):
    docs = B.table(s, d, "documents")
    code = [F.concat(F.lit(f" V{n}B "), (F.col("doc_id") % 10).cast("string"), F.lit(f"C{n} ")) for n in (1, 2)]
    k = F.col("doc_id") % 3     # none, one or two codes, in the middle of the text
    text = F.concat(F.when(k > 0, code[0]).otherwise(""), "text", F.when(k > 1, code[1]).otherwise(""))
    return clean.with_postal_code(docs.select("doc_id", text.alias("text")), "text", "postal_code").select("doc_id", "postal_code")


PHONE_LIKE = r"\(?\d{3}\)?[-. ]\d{3}[-. ]\d{4}"


def q_extract_phone_like(s, d):
    docs = B.table(s, d, "documents").select("doc_id", "text")
    return clean.with_postal_code(docs, "text", "phone", pattern=PHONE_LIKE).select("doc_id", "phone")


def q_contract_audit(s, d):
    li = B.table(s, d, "lineitem")
    li = li.select("l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 50 != 0, F.col("l_partkey")).alias("l_partkey"), "l_suppkey",
                   F.when(F.col("l_linenumber") != 7, F.col("l_shipdate")).alias("l_shipdate"))
    li = li.unionByName(li.where("l_linenumber = 2"))
    return clean.audit(li, required=["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"],
                       key=["l_orderkey", "l_linenumber"])


def q_name_normalise(s, d):
    o = B.table(s, d, "orders")
    return o.select("o_orderkey", normalise_names(F.col("o_orderpriority"), ["1-URGENT", "2-HIGH"])
                    .alias("priority_name"))


def _export_rows(s, d):
    """Permits with empty and null texts, separators and quotes."""
    third = F.col("PERMIT_CATEGORY") == "C3"
    return _permits(s, d).withColumns({
        "ADDRESS": F.when(third, F.lit("")).otherwise(F.concat(F.col("ADDRESS"), F.lit('; "rear"'))),
        "TYPE_OF_WORK": F.nullif("TYPE_OF_WORK", F.lit("F"))})


def q_csv_roundtrip(s, d):
    rows = _export_rows(s, d)
    path = scratch_path(s, "csv-roundtrip")
    export_csv(rows, path, sep=";")
    return publish(read_result(s, path, rows.schema, sep=";"))


def q_ordered_followup(s, d):
    """V5 exported as CSV in its order and read again, each row with its position in the files."""
    v5 = publish(views.v5(_v1(s, d), _v2(s, d), OPT))
    path = scratch_path(s, "ordered-csv")
    write_ordered(v5, path, ORDERED["investment_land_value_followup"], fmt="csv", files=7)
    return read_ordered(s, path, v5.schema, fmt="csv")


def q_ordered_rollup(s, d):
    """V4 written as Parquet in its order and read again, each row with its position in the files."""
    v4 = publish(views.v4(_v1(s, d), _v2(s, d), OPT))
    path = scratch_path(s, "ordered-parquet")
    write_ordered(v4, path, ORDERED["combined_by_local_area"], files=5)
    return read_ordered(s, path, v4.schema)


def q_single_csv(s, d):
    v13 = publish(views.v13(views.v5(_v1(s, d), _v2(s, d), OPT)))
    path = scratch_path(s, "single-csv")
    export_csv(v13, path, single_file=True, null_text="null")
    back = read_delimited(s, path, sep=",", schema=v13.schema)
    return back.withColumn("local_area", F.nullif("local_area", F.lit("null")))


def q_table_load(s, d):
    """Declared from its contract, loaded, and loaded again with a part of the rows appended."""
    name = f"landlens_licences_{uuid.uuid4().hex}"
    declare_table(s, name, BUSINESS_LICENSES, location=scratch_path(s, "table-load"))
    lic = stage(_lic(s, d).select(*BUSINESS_LICENSES.columns), scratch_path(s, "table-load-rows"))
    write_table(lic, name, mode="append")
    write_table(lic.where("LOCAL_AREA IS NULL"), name, mode="append")
    return s.table(name)


def q_published_load(s, d):
    """Licences loaded by runs: one loaded twice, one replaced, one whose audit fails and that is not seen."""
    place = scratch_path(s, "published")
    lic = stage(_lic(s, d).select(*BUSINESS_LICENSES.columns), scratch_path(s, "published-rows"))

    def load(rows: DataFrame, run: str) -> None:
        publish_run(rows, place, run, lambda written: clean.audit(written, BUSINESS_LICENSES.required))

    load(lic.where("FOLDER_YEAR < -5"), "early")
    load(lic.where("FOLDER_YEAR >= -5"), "late")
    load(lic.where("FOLDER_YEAR >= -5"), "late")
    load(lic.where("FOLDER_YEAR < -5 AND LOCAL_AREA IS NOT NULL"), "early")
    try:
        load(lic.withColumn("POSTAL_CODE", F.nullif("POSTAL_CODE", F.lit("1"))), "broken")
    except AuditFailed:
        pass
    return published(s, place)


def q_named_views(s, d):
    reg = views.build_registry(s, {"property_tax": _tax(s, d), "building_permits": _permits(s, d), "business_licenses": _lic(s, d)}, OPT)
    reg.register()
    return publish(s.sql("""SELECT YEAR, LOCAL_AREA, total_permits_issued, residential_zoning_count, total_businesses
        FROM combined_building_permits_property_tax_view
        LEFT JOIN (SELECT investment_year AS YEAR, local_area AS LOCAL_AREA, max(total_businesses) AS total_businesses
                   FROM investment_vs_land_value GROUP BY ALL) USING (YEAR, LOCAL_AREA)"""))


def q_views_cascade(s, d):
    """V1 defined again without the large businesses: V3, V4 and a SQL view over V3 follow; V5 is dropped with its readers."""
    reg = views.build_registry(s, {"property_tax": _tax(s, d), "building_permits": _permits(s, d), "business_licenses": _lic(s, d)}, OPT)
    reg.define_sql("pair_counts", "SELECT LOCAL_AREA, YEAR, count(*) AS n_pairs, sum(TOTAL_EMPLOYEES) AS pair_employees FROM {combined_by_postal_code} GROUP BY ALL")
    reg.register("combined_by_postal_code", "combined_by_local_area", "pair_counts", "investment_vs_land_value")
    reg.define("business_size_by_postal_code", lambda g: views.v1(g.get("business_licenses").where("NUMBER_OF_EMPLOYEES <= 25")), ["business_licenses"])
    gone = reg.drop("investment_land_value_followup", cascade=True)
    out = s.sql("""SELECT a.LOCAL_AREA, a.YEAR, n_pairs, pair_employees, TOTAL_EMPLOYEES, TOTAL_BUSINESSES, NUM_OF_PROPERTIES
        FROM combined_by_local_area a JOIN pair_counts p ON a.LOCAL_AREA <=> p.LOCAL_AREA AND a.YEAR = p.YEAR""")
    return publish(out.withColumn("dropped", F.lit(",".join(gone))))


#: Raw files of the batch job, and what a task reads of them (compressed: about a file).
RAW_FILE_ROWS, RAW_SPLIT_BYTES = 500_000, 16 << 20


def q_batch_clean(s, d):
    """The cleaning jobs by their parameters, written and read back: rows, outcomes and contract audit of all four tables."""
    base = scratch_path(s, "batch-clean")
    for raw, rows in (("tax", B.raw_property_tax(s, d)), ("licences", B.raw_business_licenses(s, d))):
        rows.write.option("compression", "zstd").option("maxRecordsPerFile", RAW_FILE_ROWS).parquet(f"{base}/raw/{raw}")
    export_csv(B.raw_building_permits(s, d), f"{base}/raw/permits", sep=";", compression="gzip", file_rows=RAW_FILE_ROWS)
    tables = jobs.run_cleaning(s, tax_path=f"{base}/raw/tax", licences_path=f"{base}/raw/licences", permits_csv_path=f"{base}/raw/permits",
                               target=f"{base}/clean", boundaries=B.raw_boundaries(s, d), split_bytes=RAW_SPLIT_BYTES)
    out = []
    for n, rows in tables.items():
        gone = jobs.rejected(s, f"{base}/clean", n)
        out += [rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("result"), F.lit("rows").alias("subject"), "n"),
                gone.groupBy(F.col("reason").alias("subject")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"rejected/{n}").alias("result"), "subject", "n"),
                s.read.parquet(f"{base}/clean/outcomes/{n}").select(F.lit(f"outcomes/{n}").alias("result"), F.col("outcome").alias("subject"), F.col("n_rows").alias("n")),
                s.read.parquet(f"{base}/clean/audit/{n}").select(F.lit(f"audit/{n}").alias("result"), F.concat_ws(":", "check", "subject").alias("subject"), F.col("violations").alias("n"))]
    return reduce(DataFrame.unionByName, out)


def q_class_maps(s, d):
    """The city's own class maps."""
    o = views.DEFAULT
    return B.city_names(s, d).select(
        "o_orderkey", "zone", "use",
        indicator("zone", o.zoning_area["residential"]).alias("residential_zone"), indicator("zone", o.zoning_area["non-residential"]).alias("other_zone"),
        class_of("zone", o.zoning_postal, o.zoning_postal_default).alias("postal_zone"),
        indicator("use", o.use_area["residential"]).alias("residential_use"), indicator("use", o.use_area["non-residential"]).alias("other_use"),
        class_of("use", o.use_postal, o.use_postal_default).alias("postal_use"))


def q_licence_outcomes(s, d):
    return jobs.licence_outcomes(B.raw_business_licenses(s, d))


def q_clean_permits_columnar_job(s, d):
    return publish(jobs.clean_building_permits_columnar(B.raw_building_permits_columnar(s, d)))


def q_clean_tax_job(s, d):
    return publish(jobs.clean_property_tax(B.raw_property_tax(s, d)))


def q_clean_licences_job(s, d):
    return publish(jobs.clean_business_licenses(B.raw_business_licenses(s, d)))


def q_clean_permits_job(s, d):
    path = scratch_path(s, "raw-permits")
    export_csv(B.raw_building_permits(s, d), path, sep=";")
    return publish(jobs.clean_building_permits(read_delimited(s, path, sep=";")))


def q_clean_permits_multiline_job(s, d):
    """The permit job on one file whose addresses hold newlines, separators and quotes, read in pieces; its rows are kept and the file is not."""
    raw, path = B.raw_building_permits(s, d), scratch_path(s, "raw-permits-lines")
    second = F.concat("Address", F.lit('\nrear; "lane"\n'), "PermitNumber")
    export_csv(raw.withColumn("Address", F.when(F.col("PermitCategory") == "C4", second).otherwise(F.col("Address"))), path, sep=";", single_file=True)
    lines = stage(read_delimited(s, path, sep=";", multiline=True, malformed_col=jobs.MALFORMED), scratch_path(s, "permit-lines"))
    discard(s, path)
    return publish(jobs.clean_building_permits(lines))


AREA_MAP_YEAR = 1998
TREND_AREA = "NATION_3"


def q_area_map(s, d):
    m = views.v16(_v9(s, d), B.boundaries(s, d), year=AREA_MAP_YEAR)
    return publish(m.withColumn("centroid_x", F.round("centroid_x", 3))
                   .withColumn("centroid_y", F.round("centroid_y", 3)))


def q_centroid(s, d):
    c = with_centroid(B.boundaries(s, d), "polygons", project=False, x_col="cx", y_col="cy")
    return c.select("name", F.round("cx", 9).alias("cx"), F.round("cy", 9).alias("cy"))


def q_reproject(s, d):
    p = with_projected_point(_permits(s, d), geojson_col="GEOM")
    return p.select("POSTAL_CODE", "ISSUE_YEAR", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "entity_year_size": q_entity_year_size,
    "entity_year_value": q_entity_year_value,
    "two_digit_year_join": q_two_digit_year_join,
    "area_rollup": q_area_rollup,
    "followup_band": q_followup_band,
    "followup_first": q_followup_first,
    "followup_equi": q_followup_equi,
    "followup_range": q_followup_range,
    "followup_rollup": q_followup_rollup,
    "bridge_size": q_bridge_size,
    "bridge_pairs": q_bridge_pairs,
    "bridge_fanout_avg": q_bridge_fanout_avg,
    "bridge_distinct_avg": q_bridge_distinct_avg,
    "class_counts": q_class_counts,
    "combined_area_year": q_combined_area_year,
    "value_profile": q_value_profile,
    "activity_profile": q_activity_profile,
    "postal_join": q_postal_join,
    "heat_feed": q_heat_feed,
    "point_parse": q_point_parse,
    "rank_correlation": q_rank_correlation,
    "correlation_matrix": q_correlation_matrix,
    "shares": q_shares,
    "trend": q_trend,
    "trend_one_area": q_trend_one_area,
    "year_bounds": q_year_bounds,
    "distinct_values": q_distinct_values,
    "row_count": q_row_count,
    "top_preview": q_top_preview,
    "clean_dedupe": q_clean_dedupe,
    "text_dedupe": q_text_dedupe,
    "clean_dropna": q_clean_dropna,
    "conform_types": q_conform_types,
    "truncate_text": q_truncate_text,
    "extract_code": q_extract_code,
    "extract_postal_code": q_extract_postal_code,
    "extract_phone_like": q_extract_phone_like,
    "contract_audit": q_contract_audit,
    "name_normalise": q_name_normalise,
    "csv_roundtrip": q_csv_roundtrip,
    "clean_tax_job": q_clean_tax_job,
    "clean_licences_job": q_clean_licences_job,
    "clean_permits_job": q_clean_permits_job,
    "clean_permits_multiline_job": q_clean_permits_multiline_job,
    "area_map": q_area_map,
    "centroid": q_centroid,
    "reproject": q_reproject,
    "area_rollup_money": q_area_rollup_money,
    "followup_sorted": q_followup_sorted,
    "ordered_followup": q_ordered_followup,
    "ordered_rollup": q_ordered_rollup,
    "bridge_fanout_avg_money": q_bridge_fanout_avg_money,
    "class_counts_money": q_class_counts_money,
    "value_profile_money": q_value_profile_money,
    "activity_profile_money": q_activity_profile_money,
    "postal_correlation": q_postal_correlation,
    "single_csv": q_single_csv,
    "table_load": q_table_load,
    "published_load": q_published_load,
    "named_views": q_named_views,
    "views_cascade": q_views_cascade,
    "batch_clean": q_batch_clean,
    "licence_outcomes": q_licence_outcomes,
    "clean_permits_columnar_job": q_clean_permits_columnar_job,
    "class_maps": q_class_maps,
}


# SURVEY section 2 items exercised by each registered query.
COVERAGE: dict[str, str] = {
    "entity_year_size": "A1, V1, S1",
    "entity_year_value": "A2, V2",
    "two_digit_year_join": "J1, P5, V3",
    "area_rollup": "A3, V4",
    "followup_band": "J2 (range), P4",
    "followup_first": "V5: W1 via R2, J2 via window frame, P4",
    "followup_equi": "V5: R3 (band as equi join)",
    "followup_range": "V5: J2 band predicate",
    "followup_rollup": "A11, V13",
    "bridge_size": "J3, A8 (V6 row count without building it)",
    "bridge_pairs": "J3 / V6 distinct pairs",
    "bridge_fanout_avg": "J4, A4, P3, V7 via R1",
    "bridge_distinct_avg": "V7 with the distinct bridge (Q1 option)",
    "class_counts": "A5, P3, V8",
    "combined_area_year": "J5, V9",
    "value_profile": "A6, P1, P8, V10",
    "activity_profile": "A7, P2, V11",
    "postal_join": "J6, P6, P7, G1, V12",
    "heat_feed": "S10",
    "point_parse": "P6, P7, G1",
    "rank_correlation": "W2, J8, A10, C13 (Q11), V14",
    "correlation_matrix": "M1, three segments",
    "shares": "A12, V15",
    "trend": "A13, O3, V17",
    "trend_one_area": "C12, A13",
    "year_bounds": "A9 (min/max)",
    "distinct_values": "A9 (sorted distinct)",
    "row_count": "A8",
    "top_preview": "C15, O1, O4",
    "clean_dedupe": "C1, C5",
    "text_dedupe": "C1, C5 (whole texts)",
    "clean_dropna": "C3",
    "conform_types": "C2, C6, C7",
    "truncate_text": "C7",
    "extract_code": "C10",
    "extract_postal_code": "C10 (postal pattern, whole texts)",
    "extract_phone_like": "C10 (whole texts)",
    "contract_audit": "C9",
    "name_normalise": "P10",
    "csv_roundtrip": "S3, S6",
    "clean_tax_job": "C1, C3, C5, C6 (tax job)",
    "clean_licences_job": "C2, C4, C6, C7, C8 (licence job)",
    "clean_permits_multiline_job": "S2 (newlines in fields), C1-C6, C10 (permit job)",
    "clean_permits_job": "S2, C1, C2, C3, C5, C6, C10 (permit job)",
    "area_map": "C11, J7, G2, G3, S9, V16",
    "centroid": "G2, S9",
    "reproject": "G1, G3",
    "area_rollup_money": "A3, V4 with averages as money (the default)",
    "followup_sorted": "O2 (V5 in its declared order)",
    "ordered_followup": "O2, S6 (order of the exported files, by position)",
    "ordered_rollup": "O1 (order of the written files, by position)",
    "bridge_fanout_avg_money": "A4, V7 with averages as money",
    "class_counts_money": "A5, V8 with averages as money",
    "value_profile_money": "A6, V10 with averages as money",
    "activity_profile_money": "A7, V11 with averages as money",
    "postal_correlation": "V14 on V12, three segments",
    "single_csv": "S7",
    "table_load": "S4, S5",
    "published_load": "S5 (repeatable, audited loads), C9",
    "named_views": "S8",
    "views_cascade": "S8 (redefinition and drop with all readers), V3, V4",
    "batch_clean": "S11, S9 (ring validity), C8 (outcomes, rejects), C9 (all four tables), A8",
    "licence_outcomes": "C8 (kept + rejected = read)",
    "clean_permits_columnar_job": "older columnar permit job",
    "class_maps": "P1, P2, P3 with the city's own maps",
}


# ---------------------------------------------------------------------------
# Oracle side
# ---------------------------------------------------------------------------
_TOTALS = ("TOTAL_PREVIOUS_LAND_VALUE", "TOTAL_CURRENT_LAND_VALUE", "TOTAL_PREVIOUS_IMPROVEMENT_VALUE", "TOTAL_CURRENT_IMPROVEMENT_VALUE")


def _as_double(*columns: str) -> str:
    return "SELECT * REPLACE (" + ", ".join(f"{c}::DOUBLE AS {c}" for c in columns) + ")"


_FOLLOWUP = with_ctes(_as_double("LAND_VALUE_IN_INVESTMENT_YEAR", "LAND_VALUE_IN_FOLLOWUP_YEAR") + " FROM followup", "followup")
_TREND = """SELECT * FROM (FROM (SELECT LOCAL_AREA, YEAR, average_land_value::DOUBLE AS average_land_value,
        average_project_value::DOUBLE AS average_project_value, average_improvement_value::DOUBLE AS average_improvement_value FROM area_years)
    UNPIVOT INCLUDE NULLS (value FOR measure IN (average_land_value, average_project_value, average_improvement_value)))"""


def _share(a: str, b: str) -> str:
    return f"round(100 * {a}::DOUBLE / nullif({a} + {b}, 0), 1)"


# Raw stand-ins, cleaned by the definitions of the jobs; types are tried, text that does not fit is null.
_RAW_TAX = """
    SELECT o_orderkey::VARCHAR AS PID, nullif(o_orderstatus, 'P') AS LEGAL_TYPE, 'Z-' || o_orderpriority AS ZONING_DISTRICT,
           o_orderpriority AS ZONING_CLASSIFICATION, (o_orderkey % 1000)::VARCHAR AS TO_CIVIC_NUMBER, o_orderstatus AS STREET_NAME,
           o_custkey::VARCHAR AS PROPERTY_POSTAL_CODE, o_totalprice::DECIMAL(18,2)::DOUBLE AS CURRENT_LAND_VALUE,
           ((o_orderkey * 37) % 100000)::DOUBLE AS CURRENT_IMPROVEMENT_VALUE, year(o_orderdate)::INTEGER AS TAX_ASSESSMENT_YEAR,
           o_totalprice::DECIMAL(18,2)::DOUBLE AS PREVIOUS_LAND_VALUE, ((o_custkey * 13) % 50000)::DOUBLE AS PREVIOUS_IMPROVEMENT_VALUE,
           CASE WHEN o_orderpriority <> '3-MEDIUM' THEN (o_orderkey % 120 + 1900)::INTEGER END AS YEAR_BUILT,
           (o_custkey % 70 + 1950)::INTEGER AS BIG_IMPROVEMENT_YEAR, (o_orderkey % 2000)::DOUBLE AS TAX_LEVY,
           (o_custkey % 30)::VARCHAR AS NEIGHBOURHOOD_CODE, year(o_orderdate)::INTEGER AS REPORT_YEAR
    FROM orders"""
_CLEAN_TAX = f"SELECT * FROM ({_RAW_TAX}) WHERE LEGAL_TYPE IS NOT NULL"
_RAW_LIC = """
    SELECT CASE WHEN l_linenumber < 6 THEN (year(l_shipdate) - 2000)::INTEGER END AS FOLDER_YEAR, l_linestatus AS STATUS, l_shipdate::DATE::VARCHAR AS ISSUED_DATE,
           left('B' || l_orderkey || '-' || l_linenumber || repeat('x', l_linenumber * 50), 255) AS BUSINESS_NAME,
           nullif(l_returnflag, 'N') AS BUSINESS_TRADE_NAME, l_returnflag AS BUSINESS_TYPE, l_linestatus AS BUSINESS_SUBTYPE,
           o_custkey::VARCHAR AS POSTAL_CODE, o_orderstatus AS STREET_NAME, o_orderpriority AS LOCAL_AREA, trunc(l_quantity)::INTEGER AS NUMBER_OF_EMPLOYEES,
           CASE l_linenumber WHEN 7 THEN 'missing:FOLDER_YEAR' WHEN 6 THEN 'unparsable:FOLDER_YEAR' ELSE 'kept' END AS outcome
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""
_LAT0, _LON0 = "'49.' || (l_suppkey % 50 + 200)", "'-123.' || (l_suppkey % 90 + 100)"
_RAW_PERMITS = f"""
    SELECT 'BP-' || l_orderkey || '-' || l_linenumber AS permit_number, CASE WHEN l_returnflag <> 'A' THEN l_shipdate::DATE::VARCHAR END AS issue_date,
           l_extendedprice::DECIMAL(15,2)::DOUBLE AS project_value, l_linestatus AS type_of_work,
           CASE WHEN l_linenumber = 2 THEN 'Unit "' || l_suppkey || '"; no code'
                WHEN l_linenumber = 3 THEN code || ' was V1A 9Z9 before'
                WHEN l_linenumber > 3 THEN l_suppkey || ' Main St; Centre City ' || code END AS address,
           'C' || l_linenumber AS permit_category, l_returnflag AS property_use, l_returnflag || l_linestatus AS specific_use_category,
           year(l_shipdate)::INTEGER AS issue_year, n_name AS geo_local_area,
           '{{"type":"Point","coordinates":[' || {_LON0} || ',' || {_LAT0} || ']}}' AS geom, strftime(l_shipdate, '%Y-%m') AS year_month,
           {_LAT0} || ', ' || {_LON0} AS geo_point_2d, CASE WHEN l_linenumber > 2 THEN code ELSE '' END AS postal_code
    FROM (SELECT *, 'V' || (l_suppkey % 10) || 'E ' || l_linenumber || 'T' || (l_suppkey % 7) AS code0 FROM lineitem) l
    LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey,
    LATERAL (SELECT l.code0 AS code)"""
_CLEAN_PERMITS = f"""
    SELECT DISTINCT * REPLACE (regexp_extract(address, '[A-Za-z][0-9][A-Za-z] [0-9][A-Za-z][0-9]') AS postal_code)
    FROM ({_RAW_PERMITS}) WHERE address IS NOT NULL AND geo_local_area IS NOT NULL"""

_AUDITED = """WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 50 <> 0 THEN l_partkey END AS l_partkey, l_suppkey,
                               CASE WHEN l_linenumber <> 7 THEN l_shipdate END AS l_shipdate FROM lineitem),
    twice AS (FROM l UNION ALL FROM l WHERE l_linenumber = 2), n AS (SELECT count(*) AS n FROM twice GROUP BY l_orderkey, l_linenumber)"""

ORACLE: dict[str, str] = {
    "entity_year_size": with_ctes("FROM lic_groups", "lic_groups"),
    "entity_year_value": with_ctes(_as_double(*_TOTALS) + " FROM tax_groups", "tax_groups"),
    "two_digit_year_join": with_ctes(_as_double(*_TOTALS) + " FROM postal_pairs", "postal_pairs"),
    "area_rollup": with_ctes("FROM areas", "areas"),
    "area_rollup_money": with_ctes(O.area_year(money_type=True), "postal_pairs"),
    "followup_band": with_ctes(f"""
        SELECT POSTAL_CODE, a.year AS INVESTMENT_YEAR, z.year AS FOLLOWUP_YEAR, {money('a.land', 'LAND_VALUE_IN_INVESTMENT_YEAR')},
               {money('z.land', 'LAND_VALUE_IN_FOLLOWUP_YEAR')}, {O.pct('a.land', 'z.land')} AS PERCENT_CHANGE_IN_LAND_VALUE
        FROM totals a JOIN totals z USING (POSTAL_CODE) WHERE z.year - a.year BETWEEN 1 AND 5""".replace("totals", """(
            SELECT PROPERTY_POSTAL_CODE AS POSTAL_CODE, REPORT_YEAR AS year, sum(CURRENT_LAND_VALUE) AS land FROM tax GROUP BY ALL)"""), "tax"),
    "followup_first": _FOLLOWUP,
    "followup_equi": _FOLLOWUP,
    "followup_range": _FOLLOWUP,
    "followup_sorted": _FOLLOWUP,
    "ordered_followup": with_ctes(_as_double("LAND_VALUE_IN_INVESTMENT_YEAR", "LAND_VALUE_IN_FOLLOWUP_YEAR") + """,
        row_number() OVER (ORDER BY LOCAL_AREA NULLS LAST, POSTAL_CODE NULLS LAST, INVESTMENT_YEAR, FOLLOWUP_YEAR) AS position FROM followup""", "followup"),
    "ordered_rollup": with_ctes("SELECT *, row_number() OVER (ORDER BY LOCAL_AREA NULLS LAST, YEAR) AS position FROM areas", "areas"),
    "followup_rollup": with_ctes("FROM followup_areas", "followup_areas"),
    "single_csv": with_ctes("FROM followup_areas", "followup_areas"),
    "bridge_size": with_ctes("SELECT count(*) AS total_rows FROM tax JOIN permits ON POSTAL_CODE = PROPERTY_POSTAL_CODE", "tax", "permits"),
    "bridge_pairs": with_ctes("SELECT POSTAL_CODE, LOCAL_AREA FROM weights", "weights"),
    "bridge_fanout_avg": with_ctes("FROM by_tax", "by_tax"),
    "bridge_fanout_avg_money": with_ctes(O.tax_areas(money_type=True), "weights", "tax"),
    "bridge_distinct_avg": with_ctes(O.tax_areas(weight="1"), "weights", "tax"),
    "class_counts": with_ctes("FROM by_permits", "by_permits"),
    "class_counts_money": with_ctes(O.permit_areas(money_type=True), "permits"),
    "combined_area_year": with_ctes("FROM area_years", "area_years"),
    "value_profile": with_ctes("FROM postal_tax", "postal_tax"),
    "value_profile_money": with_ctes(O.tax_profile(money_type=True), "tax", "zoning_names"),
    "activity_profile": with_ctes(O.permit_profile(), "postal_permits"),
    "activity_profile_money": with_ctes(O.permit_profile(money_type=True), "postal_permits"),
    "postal_join": with_ctes("FROM postal_results", "postal_results"),
    "heat_feed": with_ctes("""
        SELECT postal_code, latitude, longitude, zoning, property_use, property_count, permit_count, total_land_value, total_project_value, year
        FROM postal_results WHERE latitude + longitude IS NOT NULL""", "postal_results"),
    "point_parse": with_ctes("SELECT * EXCLUDE (parts) FROM points", "points"),
    "rank_correlation": with_ctes("FROM order_correlations", "order_correlations"),
    "postal_correlation": with_ctes("FROM postal_correlations", "postal_correlations"),
    "correlation_matrix": with_ctes(
        "SELECT segment, investment_year, " + ", ".join(f'any_value(corr) FILTER (value_year = {y}) AS "{y}"' for y in MATRIX_YEARS)
        + " FROM order_correlations GROUP BY ALL", "order_correlations"),
    "shares": with_ctes(f"""
        SELECT LOCAL_AREA, YEAR, residential_zoning_count, non_residential_zoning_count,
               {_share('residential_zoning_count', 'non_residential_zoning_count')} AS residential_zoning_share,
               {_share('non_residential_zoning_count', 'residential_zoning_count')} AS non_residential_zoning_share,
               residential_property_use_count, non_residential_property_use_count,
               {_share('residential_property_use_count', 'non_residential_property_use_count')} AS residential_use_share,
               {_share('non_residential_property_use_count', 'residential_property_use_count')} AS non_residential_use_share
        FROM area_years""", "area_years"),
    "trend": with_ctes(_TREND, "area_years"),
    "trend_one_area": with_ctes(_TREND + f" WHERE LOCAL_AREA = '{TREND_AREA}'", "area_years"),
    "year_bounds": with_ctes("SELECT min(REPORT_YEAR) AS min_REPORT_YEAR, max(REPORT_YEAR) AS max_REPORT_YEAR FROM tax", "tax"),
    "distinct_values": with_ctes("SELECT DISTINCT GEO_LOCAL_AREA FROM permits", "permits"),
    "row_count": with_ctes("SELECT count(*) AS total_entries FROM lic", "lic"),
    "top_preview": with_ctes("FROM areas ORDER BY LOCAL_AREA NULLS LAST, YEAR LIMIT 10", "areas"),
    "clean_dedupe": "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM (SELECT DISTINCT * FROM lineitem) GROUP BY ALL",
    "text_dedupe": "SELECT DISTINCT lang, source, text FROM documents",
    "clean_dropna": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
        WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' AND o_orderkey + o_custkey + o_totalprice IS NOT NULL""",
    "conform_types": """
        SELECT o_orderkey::INTEGER AS order_id, o_custkey::VARCHAR AS customer, o_totalprice::DECIMAL(18,2)::DOUBLE AS price,
               trunc(o_totalprice::DECIMAL(18,2))::INTEGER AS price_units, o_orderdate::DATE::VARCHAR AS order_date,
               NULL::INTEGER AS priority_rank, left(o_orderstatus, 1) AS status, o_custkey::INTEGER AS just_below
        FROM orders""",
    "truncate_text": "SELECT page_id, left(html, 255) AS html FROM pages",
    "extract_code": "SELECT page_id, url, regexp_extract(url, 'page=[0-9]+') AS code FROM pages",
    "extract_postal_code": "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'V1B ' || (doc_id % 10) || 'C1' END AS postal_code FROM documents",
    "extract_phone_like": r"SELECT doc_id, regexp_extract(text, '[(]?[0-9]{3}[)]?[-. ][0-9]{3}[-. ][0-9]{4}') AS phone FROM documents",
    "contract_audit": _AUDITED + """
        SELECT 'row_count' AS "check", '*' AS subject, count(*) AS violations FROM twice
        UNION ALL SELECT 'not_null', c, count(*) - k FROM twice, (SELECT unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_shipdate']) AS c,
            unnest([count(l_orderkey), count(l_partkey), count(l_suppkey), count(l_shipdate)]) AS k FROM twice) GROUP BY c, k
        UNION ALL SELECT 'duplicate_key_groups', 'l_orderkey,l_linenumber', count(*) FROM n WHERE n > 1
        UNION ALL SELECT 'duplicate_key_rows', 'l_orderkey,l_linenumber', coalesce(sum(n), 0)::BIGINT FROM n WHERE n > 1""",
    "name_normalise": """
        SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '1 URGENT' WHEN '2-HIGH' THEN '2 HIGH' ELSE o_orderpriority END AS priority_name
        FROM orders""",
    "csv_roundtrip": with_ctes("""
        SELECT * REPLACE (ISSUE_DATE::VARCHAR AS ISSUE_DATE, PROJECT_VALUE::DOUBLE AS PROJECT_VALUE, nullif(TYPE_OF_WORK, 'F') AS TYPE_OF_WORK,
                          CASE WHEN PERMIT_CATEGORY = 'C3' THEN '' ELSE ADDRESS || '; "rear"' END AS ADDRESS) FROM permits""", "permits"),
    "table_load": with_ctes("FROM lic UNION ALL FROM lic WHERE LOCAL_AREA IS NULL", "lic"),
    "published_load": with_ctes("""
        SELECT *, CASE WHEN FOLDER_YEAR < -5 THEN 'early' ELSE 'late' END AS run_id FROM lic WHERE FOLDER_YEAR >= -5 OR LOCAL_AREA IS NOT NULL""", "lic"),
    "named_views": with_ctes("""
        SELECT YEAR, LOCAL_AREA, total_permits_issued, residential_zoning_count, most AS total_businesses
        FROM area_years LEFT JOIN (SELECT investment_year AS YEAR, local_area AS LOCAL_AREA, max(total_businesses) AS most FROM followup_areas GROUP BY ALL)
        USING (YEAR, LOCAL_AREA)""", "area_years", "followup_areas"),
    "views_cascade": with_ctes("""
        SELECT LOCAL_AREA, YEAR, count(*) AS n_pairs, sum(TOTAL_EMPLOYEES)::BIGINT AS pair_employees, sum(TOTAL_EMPLOYEES)::BIGINT AS TOTAL_EMPLOYEES,
               sum(TOTAL_BUSINESSES)::BIGINT AS TOTAL_BUSINESSES, count(DISTINCT POSTAL_CODE) AS NUM_OF_PROPERTIES,
               'investment_vs_land_value,investment_land_value_followup' AS dropped
        FROM (SELECT POSTAL_CODE, FOLDER_YEAR, STREET_NAME, LOCAL_AREA, sum(NUMBER_OF_EMPLOYEES) AS TOTAL_EMPLOYEES, count(BUSINESS_NAME) AS TOTAL_BUSINESSES
              FROM lic WHERE NUMBER_OF_EMPLOYEES <= 25 GROUP BY ALL) b
        JOIN (SELECT POSTAL_CODE, REPORT_YEAR AS YEAR FROM tax_groups) t USING (POSTAL_CODE)
        WHERE YEAR = FOLDER_YEAR + 2000 GROUP BY ALL""", "lic", "tax_groups"),
    "area_map": with_ctes(f"""
        SELECT LOCAL_AREA, YEAR, average_land_value, average_project_value, average_improvement_value, round(cx, 3) AS centroid_x, round(cy, 3) AS centroid_y
        FROM area_years JOIN nation ON n_name = LOCAL_AREA LEFT JOIN centres_utm ON name = LOCAL_AREA WHERE YEAR = {AREA_MAP_YEAR}""", "area_years", "centres_utm"),
    "centroid": with_ctes("SELECT n_name AS name, round(cx, 9) AS cx, round(cy, 9) AS cy FROM nation LEFT JOIN centres ON name = n_name", "centres"),
    "reproject": with_ctes(
        "SELECT POSTAL_CODE, ISSUE_YEAR, round({0}, 3) AS x, round({1}, 3) AS y FROM (SELECT POSTAL_CODE, ISSUE_YEAR, "
        "split_part(split_part(GEOM, '[', 2), ',', 1)::DOUBLE AS lon, split_part(split_part(GEOM, ',', 3), ']', 1)::DOUBLE AS lat FROM permits)"
        .format(*O.utm_sql("lon", "lat")), "permits"),
    "clean_tax_job": _CLEAN_TAX,
    "clean_licences_job": f"SELECT * EXCLUDE (outcome) FROM ({_RAW_LIC}) WHERE FOLDER_YEAR IS NOT NULL",
    "licence_outcomes": f"SELECT outcome, count(*) AS n_rows FROM ({_RAW_LIC}) GROUP BY outcome",
    "clean_permits_job": _CLEAN_PERMITS,
    "clean_permits_multiline_job": _CLEAN_PERMITS.replace(f"FROM ({_RAW_PERMITS})", f"""FROM (SELECT * REPLACE (
        CASE WHEN permit_category = 'C4' THEN address || chr(10) || 'rear; "lane"' || chr(10) || permit_number ELSE address END AS address) FROM ({_RAW_PERMITS}))"""),
    "class_maps": O.CLASSES,
    "clean_permits_columnar_job": f"SELECT DISTINCT * EXCLUDE (permit_number, geo_point_2d) FROM ({_CLEAN_PERMITS})",
    "batch_clean": f"""
        WITH tax AS ({_CLEAN_TAX}), lic AS ({_RAW_LIC}), kept_lic AS (FROM lic WHERE FOLDER_YEAR IS NOT NULL), permits AS ({_CLEAN_PERMITS}),
        raw_tax AS (SELECT CASE WHEN LEGAL_TYPE IS NULL THEN 'missing:LEGAL_TYPE' ELSE 'kept' END AS outcome
                    FROM (FROM ({_RAW_TAX}) UNION ALL FROM ({_RAW_TAX}) WHERE LEGAL_TYPE = 'F')),
        raw_permits AS (SELECT CASE WHEN address IS NULL THEN 'missing:Address' ELSE 'kept' END AS outcome FROM ({_RAW_PERMITS})),
        areas AS (SELECT n_name AS name, n_nationkey % 4 = 1 AS turned,
                         CASE WHEN n_nationkey % 8 = 7 THEN 'unreadable' WHEN n_nationkey % 6 = 5 THEN 'unclosed' WHEN n_nationkey % 7 = 3 THEN 'self_intersecting'
                              WHEN n_nationkey % 11 = 4 THEN 'too_few_points' ELSE 'kept' END AS outcome FROM nation),
        outcomes AS (SELECT 'property_tax' AS t, outcome FROM raw_tax UNION ALL SELECT 'business_licenses', outcome FROM lic
                     UNION ALL SELECT 'building_permits', outcome FROM raw_permits UNION ALL SELECT 'boundaries', outcome FROM areas),
        sizes AS (SELECT 'property_tax' AS t, count(*) AS n FROM tax UNION ALL SELECT 'business_licenses', count(*) FROM kept_lic
                  UNION ALL SELECT 'building_permits', count(*) FROM permits UNION ALL SELECT 'boundaries', count(*) FROM areas WHERE outcome = 'kept'),
        doubles AS (SELECT t, k, count(*) AS n FROM (
                        SELECT 'property_tax' AS t, 'PROPERTY_POSTAL_CODE,PID' AS k, PROPERTY_POSTAL_CODE || ' ' || PID AS v FROM tax
                        UNION ALL SELECT 'business_licenses', 'POSTAL_CODE,BUSINESS_NAME', POSTAL_CODE || ' ' || BUSINESS_NAME FROM kept_lic
                        UNION ALL SELECT 'boundaries', 'name', name FROM areas WHERE outcome = 'kept') GROUP BY t, k, v),
        clear(t, c) AS (VALUES
            ('property_tax', 'not_null:PID'), ('property_tax', 'not_null:PROPERTY_POSTAL_CODE'), ('property_tax', 'not_null:REPORT_YEAR'),
            ('property_tax', 'cast_failed:CURRENT_LAND_VALUE'), ('property_tax', 'cast_failed:CURRENT_IMPROVEMENT_VALUE'),
            ('property_tax', 'cast_failed:TAX_ASSESSMENT_YEAR'), ('property_tax', 'cast_failed:PREVIOUS_LAND_VALUE'),
            ('property_tax', 'cast_failed:PREVIOUS_IMPROVEMENT_VALUE'), ('property_tax', 'cast_failed:BIG_IMPROVEMENT_YEAR'),
            ('property_tax', 'cast_failed:TAX_LEVY'), ('property_tax', 'cast_failed:REPORT_YEAR'),
            ('business_licenses', 'not_null:FOLDER_YEAR'), ('business_licenses', 'not_null:BUSINESS_NAME'), ('business_licenses', 'not_null:POSTAL_CODE'),
            ('business_licenses', 'cast_failed:FOLDER_YEAR'), ('business_licenses', 'cast_failed:NUMBER_OF_EMPLOYEES'),
            ('building_permits', 'cast_failed:PROJECT_VALUE'), ('building_permits', 'cast_failed:ISSUE_YEAR'),
            ('building_permits', 'too_long:TYPE_OF_WORK'), ('building_permits', 'too_long:ADDRESS'), ('building_permits', 'too_long:POSTAL_CODE'),
            ('building_permits', 'too_long:PERMIT_CATEGORY'), ('building_permits', 'too_long:PROPERTY_USE'), ('building_permits', 'too_long:YEAR_MONTH'),
            ('building_permits', 'too_long:GEO_LOCAL_AREA'))
        SELECT t AS result, 'rows' AS subject, n FROM sizes
        UNION ALL SELECT 'outcomes/' || t, outcome, count(*) FROM outcomes GROUP BY ALL
        UNION ALL SELECT 'rejected/' || t, outcome, count(*) FROM outcomes WHERE outcome <> 'kept' GROUP BY ALL
        UNION ALL SELECT 'audit/' || t, 'row_count:*', n FROM sizes
        UNION ALL SELECT 'audit/' || t, c, 0 FROM clear
        UNION ALL SELECT 'audit/property_tax', 'cast_failed:YEAR_BUILT', count(*) FROM tax WHERE YEAR_BUILT IS NULL
        UNION ALL SELECT 'audit/building_permits', 'cast_failed:ISSUE_DATE', count(*) FROM permits WHERE issue_date IS NULL
        UNION ALL SELECT 'audit/boundaries', 'reversed_rings:polygons', count(*) FROM areas WHERE outcome = 'kept' AND turned
        UNION ALL SELECT 'audit/' || t, 'duplicate_key_groups:' || k, count(*) FILTER (n > 1) FROM doubles GROUP BY ALL
        UNION ALL SELECT 'audit/' || t, 'duplicate_key_rows:' || k, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT FROM doubles GROUP BY ALL""",
}
