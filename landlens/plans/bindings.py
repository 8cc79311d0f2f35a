"""Bindings of the clean-table contracts to the driver's test tables.

The test tables are a TPC-H-like star schema, not city data, so each clean
table gets a stand-in built by Spark from them (its size grows with theirs):

* ``property_tax``      <- ``orders``: postal code = customer, report year =
  order year, land value = total price, zoning = priority, street = status.
* ``building_permits``  <- ``lineitem`` (+ supplier, nation): postal code =
  supplier, issue date = ship date, project value = extended price, property
  use = return flag, work type = line status, area = supplier's nation, or the
  next one or none for some lines, so that a postal code lies in several areas
  and has several geometry and point texts.
* ``business_licenses`` <- ``lineitem`` JOIN ``orders`` (+ customer, nation):
  one licence per line, employees = quantity, postal code = customer, folder
  year = two-digit ship year, area = customer's nation.
* boundaries            <- ``nation``: a quadrilateral per nation near 123 W, some
  with a hole, some in two parts, some unreadable.

Values that operators must treat specially occur in all of them: zero and null
values, null areas, exact copies, texts that do not parse.

Every expression here has a twin in :mod:`landlens.plans.oracle` written in
DuckDB SQL; keep them in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landlens.sources.readers import boundaries_from_geojson, read_parquet

# Class maps for the stand-in values (priorities and return flags).
ZONING_AREA_T = {"residential": ["1-URGENT", "2-HIGH"],
                 "non-residential": ["4-NOT SPECIFIED", "5-LOW"]}
ZONING_POSTAL_T = {"residential": ["1-URGENT"], "mixed": ["3-MEDIUM"],
                   "non-residential": ["2-HIGH", "4-NOT SPECIFIED"]}
USE_AREA_T = {"residential": ["N"], "non-residential": ["R"]}
USE_POSTAL_T = {"residential": ["R"]}

# Zoning and use names as the city writes them, and one of each that it does not.
CITY_ZONES = ["One-Family Dwelling", "Multiple Dwelling", "Residential", "Residential Inclusive", "Two-Family Dwelling",
              "Residential Rental", "Commercial", "Industrial", "Historical Area", "Limited Agriculture", "Other",
              "Comprehensive Development", "Elsewhere"]
CITY_USES = ["Dwelling Uses", "Live-Work Uses", "Office Uses", "Retail Uses", "Service Uses", "Institutional Uses",
             "Cultural/Recreational Uses", "Manufacturing Uses", "Parking Uses", "Wholesale Uses",
             "Transportation and Storage Uses", "Utility and Communication Uses", "Agricultural Uses",
             "Deposition or Extraction Uses", "Mural", "Unused"]


def city_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zoning and a use name as the city writes them for every order (every 29th has none)."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")

    def pick(names):
        return F.when(k % 29 != 0, F.get(F.array(*map(F.lit, names)), (k % len(names)).cast("int")))

    return o.select("o_orderkey", pick(CITY_ZONES).alias("zone"), pick(CITY_USES).alias("use"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def property_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    land = F.when(k % 11 == 0, F.lit(0)).otherwise(F.col("o_totalprice")).cast("decimal(18,2)")   # zero bases
    return o.select(
        _s(k).alias("PID"),
        F.col("o_orderstatus").alias("LEGAL_TYPE"),
        F.concat(F.lit("Z-"), F.col("o_orderpriority")).alias("ZONING_DISTRICT"),
        F.col("o_orderpriority").alias("ZONING_CLASSIFICATION"),
        _s(k % 1000).alias("TO_CIVIC_NUMBER"),
        F.col("o_orderstatus").alias("STREET_NAME"),
        _s(c).alias("PROPERTY_POSTAL_CODE"),
        land.alias("CURRENT_LAND_VALUE"),
        F.when(k % 13 != 0, (k * 37) % 100000).cast("decimal(18,2)").alias("CURRENT_IMPROVEMENT_VALUE"),
        F.year("o_orderdate").alias("TAX_ASSESSMENT_YEAR"),
        (land - (k % 1000).cast("decimal(18,2)")).cast("decimal(18,2)").alias("PREVIOUS_LAND_VALUE"),
        ((c * 13) % 50000).cast("decimal(18,2)").alias("PREVIOUS_IMPROVEMENT_VALUE"),
        (F.lit(1900) + k % 120).cast("int").alias("YEAR_BUILT"),
        (F.lit(1950) + c % 70).cast("int").alias("BIG_IMPROVEMENT_YEAR"),
        (k % 2000).cast("decimal(18,2)").alias("TAX_LEVY"),
        _s(c % 30).alias("NEIGHBOURHOOD_CODE"),
        F.year("o_orderdate").alias("REPORT_YEAR"))


def _lat_lon_text(k: F.Column, step: F.Column | None = None) -> tuple[F.Column, F.Column]:
    """City-scale coordinates as text ('49.2xx', '-123.1xx'), built from the key."""
    north = k % 50 + 200 + (step if step is not None else 0)
    return (F.concat(F.lit("49."), _s(north)), F.concat(F.lit("-123."), _s(k % 90 + 100)))


def _point_text(k: F.Column, step: F.Column) -> F.Column:
    lat, lon = _lat_lon_text(k, step)
    d = k % 10
    return (F.when(d == 3, lat)                                             # no comma
            .when(d == 7, F.concat(lat, F.lit(", "), lon, F.lit(", 0")))    # two commas
            .when(d == 9, F.lit("x, y"))                                    # not numbers
            .otherwise(F.concat(lat, F.lit(", "), lon)))


def building_permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    ln = F.col("l_linenumber")
    j = li.join(s, li["l_suppkey"] == s["s_suppkey"], "left")
    # line 5 lies in the next area, line 6 of every fourth supplier in none
    nation = F.when((ln != 6) | (F.col("l_suppkey") % 4 != 0), (F.col("s_nationkey") + F.when(ln == 5, 1).otherwise(0)) % 25)
    j = j.join(n, nation == n["n_nationkey"], "left")
    k, step = F.col("l_suppkey"), ln % 3
    return j.select(
        F.to_date("l_shipdate").alias("ISSUE_DATE"),
        F.col("l_extendedprice").cast("decimal(15,2)").alias("PROJECT_VALUE"),
        F.col("l_linestatus").alias("TYPE_OF_WORK"),
        F.concat(F.lit("line "), _s("l_linenumber"), F.lit(", supplier "), _s(k)).alias("ADDRESS"),
        _s(k).alias("POSTAL_CODE"),
        F.concat(F.lit("C"), _s("l_linenumber")).alias("PERMIT_CATEGORY"),
        F.col("l_returnflag").alias("PROPERTY_USE"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("SPECIFIC_USE_CATEGORY"),
        F.year("l_shipdate").alias("ISSUE_YEAR"),
        F.date_format("l_shipdate", "yyyy-MM").alias("YEAR_MONTH"),
        F.concat(F.lit('{"type":"Point","coordinates":['), _lat_lon_text(k, step)[1], F.lit(","),
                 _lat_lon_text(k, step)[0], F.lit("]}")).alias("GEOM"),
        _point_text(k, step).alias("GEO_POINT_2D"),
        F.col("n_name").alias("GEO_LOCAL_AREA"))


def business_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    # one by one: Spark takes the size of a join as the product of its sides and would shuffle all lines for customers with their nation
    j = j.join(c, j["o_custkey"] == c["c_custkey"], "left").join(n, F.col("c_nationkey") == n["n_nationkey"], "left")
    return j.select(
        (F.year("l_shipdate") - 2000).cast("int").alias("FOLDER_YEAR"),
        F.col("l_linestatus").alias("STATUS"),
        _s(F.to_date("l_shipdate")).alias("ISSUED_DATE"),
        F.concat(F.lit("B"), _s("l_orderkey"), F.lit("-"), _s("l_linenumber")).alias("BUSINESS_NAME"),
        F.concat(F.lit("T"), _s("l_partkey")).alias("BUSINESS_TRADE_NAME"),
        F.col("l_returnflag").alias("BUSINESS_TYPE"),
        F.col("l_linestatus").alias("BUSINESS_SUBTYPE"),
        _s("o_custkey").alias("POSTAL_CODE"),
        F.col("o_orderstatus").alias("STREET_NAME"),
        F.when(F.col("l_linenumber") != 7, F.col("n_name")).alias("LOCAL_AREA"),     # some without an area
        F.col("l_quantity").cast("int").alias("NUMBER_OF_EMPLOYEES"))


def boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shape per nation, delivered as GeoJSON text and read through the boundary
    source (S9): a quadrilateral (open ring, counter-clockwise), every third with a
    square hole (closed ring), every fifth in two parts, every eighth with an empty
    ring, which no reader can use."""
    n = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    x0 = F.lit(-125.0) + key * 0.2
    y0 = F.lit(48.0) + F.col("n_regionkey") * 0.3

    def ring(points):
        return F.concat(F.lit("["), F.concat_ws(",", *[F.concat(F.lit("["), _s(x), F.lit(","), _s(y), F.lit("]")) for x, y in points]), F.lit("]"))

    outer = ring([(x0, y0), (x0 + 0.15, y0), (x0 + 0.2, y0 + 0.1), (x0, y0 + 0.25)])
    hole = ring([(x0 + 0.02, y0 + 0.02), (x0 + 0.02, y0 + 0.06), (x0 + 0.08, y0 + 0.06), (x0 + 0.08, y0 + 0.02), (x0 + 0.02, y0 + 0.02)])
    second = ring([(x0 + 0.3, y0), (x0 + 0.4, y0), (x0 + 0.4, y0 + 0.1)])
    polygon = F.concat(F.lit("["), outer, F.when(key % 3 == 0, F.concat(F.lit(","), hole)).otherwise(F.lit("")), F.lit("]"))
    text = (F.when(key % 8 == 7, F.lit('{"type":"Polygon","coordinates":[[]]}'))
            .when(key % 5 == 4, F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), polygon, F.lit(",["), second, F.lit("]]}")))
            .otherwise(F.concat(F.lit('{"type":"Polygon","coordinates":'), polygon, F.lit("}"))))
    return boundaries_from_geojson(n.select(F.col("n_name").alias("name"), text.alias("geojson")))


def raw_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name, geojson) of a closed ring per nation, every fourth clockwise; some unreadable, not closed, crossing themselves or of two points."""
    n = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    x, y = key * 2, F.col("n_regionkey") * 3
    corners = [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1)]

    def ring(*order):
        return F.concat(F.lit("["), F.concat_ws(",", *[F.concat(F.lit("["), _s(corners[i][0]), F.lit(","), _s(corners[i][1]), F.lit("]")) for i in order]), F.lit("]"))

    shape = (F.when(key % 6 == 5, ring(0, 1, 2, 3)).when(key % 7 == 3, ring(0, 2, 1, 3, 0)).when(key % 11 == 4, ring(0, 1, 0))
             .when(key % 4 == 1, ring(0, 3, 2, 1, 0)).otherwise(ring(0, 1, 2, 3, 0)))
    text = F.when(key % 8 == 7, F.lit('{"type":"Polygon","coordinates":[]}')).otherwise(F.concat(F.lit('{"type":"Polygon","coordinates":['), shape, F.lit("]}")))
    return n.select(F.col("n_name").alias("name"), text.alias("geojson"))


def postal_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for the postal result table that feeds the correlation:
    one row per order; year = order year, segment from the order status
    (status 'P' gives a null segment, which belongs to non-residential)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("postal_code"),
        F.year("o_orderdate").alias("year"),
        F.when(F.col("o_orderkey") % 17 != 0, F.col("o_totalprice")).alias("total_project_value"),
        F.when(F.col("o_orderkey") % 19 != 0, F.col("o_totalprice") - (F.col("o_custkey") % 1000) * 100.0).alias("total_land_value"),
        F.when(F.col("o_orderstatus") == "F", F.lit("residential"))
         .when(F.col("o_orderstatus") == "O", F.lit("commercial")).alias("property_use"))


# ---------------------------------------------------------------------------
# Raw (pre-cleaning) stand-ins: source column names, text values, with the
# defects the cleaning jobs exist for (nulls, exact copies, bad numbers and
# dates, over-long names, addresses with and without a postal code).
# ---------------------------------------------------------------------------
def raw_property_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    raw = o.select(
        _s(k).alias("PID"),
        F.expr("nullif(o_orderstatus, 'P')").alias("LEGAL_TYPE"),        # null -> row dropped
        F.concat(F.lit("Z-"), F.col("o_orderpriority")).alias("ZONING_DISTRICT"),
        F.col("o_orderpriority").alias("ZONING_CLASSIFICATION"),
        _s(k % 1000).alias("TO_CIVIC_NUMBER"),
        F.col("o_orderstatus").alias("STREET_NAME"),
        _s(c).alias("PROPERTY_POSTAL_CODE"),
        _s(F.col("o_totalprice").cast("decimal(18,2)")).alias("CURRENT_LAND_VALUE"),
        _s((k * 37) % 100000).alias("CURRENT_IMPROVEMENT_VALUE"),
        _s(F.year("o_orderdate")).alias("TAX_ASSESSMENT_YEAR"),
        _s(F.col("o_totalprice").cast("decimal(18,2)")).alias("PREVIOUS_LAND_VALUE"),
        _s((c * 13) % 50000).alias("PREVIOUS_IMPROVEMENT_VALUE"),
        F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("unknown"))       # bad int -> null, kept
         .otherwise(_s(k % 120 + 1900)).alias("YEAR_BUILT"),
        _s(c % 70 + 1950).alias("BIG_IMPROVEMENT_YEAR"),
        _s(k % 2000).alias("TAX_LEVY"),
        _s(c % 30).alias("NEIGHBOURHOOD_CODE"),
        _s(F.year("o_orderdate")).alias("REPORT_YEAR"))
    # a second delivery of the finished orders: exact copies for the de-duplication
    return raw.unionByName(raw.where(F.col("LEGAL_TYPE") == "F"))


def raw_business_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    ln = F.col("l_linenumber")
    return j.select(
        F.when(ln == 7, F.lit(None).cast("string")).when(ln == 6, F.lit("xx"))
         .otherwise(_s(F.year("l_shipdate") - 2000)).alias("folderyear"),
        F.col("l_linestatus").alias("status"),
        _s(F.to_date("l_shipdate")).alias("issueddate"),
        F.concat(F.lit("B"), _s("l_orderkey"), F.lit("-"), _s(ln),
                 F.expr("repeat('x', l_linenumber * 50)")).alias("businessname"),
        F.expr("nullif(l_returnflag, 'N')").alias("businesstradename"),
        F.col("l_returnflag").alias("businesstype"),
        F.col("l_linestatus").alias("businesssubtype"),
        _s("o_custkey").alias("postalcode"),
        F.col("o_orderstatus").alias("street"),
        F.col("o_orderpriority").alias("localarea"),
        _s("l_quantity").alias("numberofemployees"))


def raw_building_permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited-file layout (header names of the city export, all text)."""
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # one by one: Spark takes the size of a join as the product of its sides and would shuffle all lines for suppliers with their nation
    j = li.join(s, li["l_suppkey"] == s["s_suppkey"], "left").join(n, F.col("s_nationkey") == n["n_nationkey"], "left")
    k, ln = F.col("l_suppkey"), F.col("l_linenumber")
    code = F.concat(F.lit("V"), _s(k % 10), F.lit("E "), _s(ln), F.lit("T"), _s(k % 7))
    address = (F.when(ln == 1, F.lit(None).cast("string"))                       # dropped
               .when(ln == 2, F.concat(F.lit('Unit "'), _s(k), F.lit('"; no code')))
               .when(ln == 3, F.concat(code, F.lit(" was "), F.lit("V1A 9Z9 before")))    # two codes
               .otherwise(F.concat(_s(k), F.lit(" Main St; Centre City "), code)))
    lat, lon = _lat_lon_text(k)
    return j.select(
        F.concat(F.lit("BP-"), _s("l_orderkey"), F.lit("-"), _s(ln)).alias("PermitNumber"),
        F.when(F.col("l_returnflag") == "A", F.lit("not a date"))
         .otherwise(_s(F.to_date("l_shipdate"))).alias("IssueDate"),
        _s(F.col("l_extendedprice").cast("decimal(15,2)")).alias("ProjectValue"),
        F.col("l_linestatus").alias("TypeOfWork"),
        address.alias("Address"),
        F.lit("ignored").alias("ProjectDescription"),
        F.concat(F.lit("C"), _s(ln)).alias("PermitCategory"),
        F.col("l_returnflag").alias("PropertyUse"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("SpecificUseCategory"),
        _s(F.year("l_shipdate")).alias("IssueYear"),
        F.col("n_name").alias("GeoLocalArea"),
        F.concat(F.lit('{"type":"Point","coordinates":['), lon, F.lit(","), lat, F.lit("]}")).alias("Geom"),
        F.date_format("l_shipdate", "yyyy-MM").alias("YearMonth"),
        F.concat(lat, F.lit(", "), lon).alias("geo_point_2d"))


def raw_building_permits_columnar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same permits in the older columnar layout (other names, no permit number, no point), with copies."""
    raw = raw_building_permits(spark, sf_dir)
    raw = raw.select(*[F.col(c).alias("geom" if c == "Geom" else c[0].lower() + c[1:]) for c in (
        "IssueDate", "ProjectValue", "TypeOfWork", "Address", "PermitCategory", "PropertyUse", "SpecificUseCategory",
        "IssueYear", "YearMonth", "Geom", "GeoLocalArea")])
    return raw.unionByName(raw.where(F.col("typeOfWork") == "F"))
