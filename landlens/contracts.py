"""Typed table contracts and the fixed class maps.

A ``TableContract`` is an ordered list of fields (source name, target name,
Spark type, required?, max length).  One contract drives renaming, type
conformance, truncation and the audit of a cleaning job, so the three cleaning
styles of the source jobs (cast-after-read, all-string CSV, explicit schema)
collapse into one ``select``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    target: str
    dtype: T.DataType
    source: str | None = None        # raw column name; defaults to ``target``
    required: bool = False           # NOT NULL in the target table
    max_length: int | None = None    # truncate strings to this many characters

    @property
    def src(self) -> str:
        return self.source or self.target


@dataclass(frozen=True)
class TableContract:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = field(default_factory=tuple)   # declared key (informational)

    @property
    def columns(self) -> list[str]:
        return [f.target for f in self.fields]

    @property
    def source_columns(self) -> list[str]:
        return [f.src for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.target for f in self.fields if f.required]

    def rename_map(self) -> dict[str, str]:
        return {f.src: f.target for f in self.fields if f.src != f.target}

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.target, f.dtype, not f.required) for f in self.fields])

    def string_schema(self) -> T.StructType:
        """All-string schema over the *source* names (delimited raw files)."""
        return T.StructType([T.StructField(f.src, T.StringType(), True) for f in self.fields])

    def ddl(self) -> str:
        cols = ", ".join(f"`{f.target}` {f.dtype.simpleString()}"
                         + (" NOT NULL" if f.required else "") for f in self.fields)
        return cols


S, I = T.StringType(), T.IntegerType()
MONEY18 = T.DecimalType(18, 2)
MONEY15 = T.DecimalType(15, 2)

# ---------------------------------------------------------------------------
# Table layouts of the three city tables (names and types must
# equal the source tables for right results).
# ---------------------------------------------------------------------------
PROPERTY_TAX = TableContract(
    "property_tax",
    (
        Field("PID", S, required=True),
        Field("LEGAL_TYPE", S),
        Field("ZONING_DISTRICT", S),
        Field("ZONING_CLASSIFICATION", S),
        Field("TO_CIVIC_NUMBER", S),
        Field("STREET_NAME", S),
        Field("PROPERTY_POSTAL_CODE", S, required=True),
        Field("CURRENT_LAND_VALUE", MONEY18),
        Field("CURRENT_IMPROVEMENT_VALUE", MONEY18),
        Field("TAX_ASSESSMENT_YEAR", I),
        Field("PREVIOUS_LAND_VALUE", MONEY18),
        Field("PREVIOUS_IMPROVEMENT_VALUE", MONEY18),
        Field("YEAR_BUILT", I),
        Field("BIG_IMPROVEMENT_YEAR", I),
        Field("TAX_LEVY", MONEY18),
        Field("NEIGHBOURHOOD_CODE", S),
        Field("REPORT_YEAR", I, required=True),
    ),
    key=("PROPERTY_POSTAL_CODE", "PID"),
)

# Permits, delimited layout: source header names -> snake-case targets.
BUILDING_PERMITS = TableContract(
    "building_permits",
    (
        Field("permit_number", S, source="PermitNumber"),
        Field("issue_date", T.DateType(), source="IssueDate"),
        Field("project_value", MONEY15, source="ProjectValue"),
        Field("type_of_work", S, source="TypeOfWork"),
        Field("address", S, source="Address"),
        Field("permit_category", S, source="PermitCategory"),
        Field("property_use", S, source="PropertyUse"),
        Field("specific_use_category", S, source="SpecificUseCategory"),
        Field("issue_year", I, source="IssueYear"),
        Field("geo_local_area", S, source="GeoLocalArea"),
        Field("geom", S, source="Geom"),
        Field("year_month", S, source="YearMonth"),
        Field("geo_point_2d", S, source="geo_point_2d"),
    ),
)

# Permits, older columnar layout (no point column, no permit number).
BUILDING_PERMITS_COLUMNAR = TableContract(
    "building_permits_columnar",
    (
        Field("issue_date", T.DateType(), source="issueDate"),
        Field("project_value", MONEY15, source="projectValue"),
        Field("type_of_work", S, source="typeOfWork"),
        Field("address", S, source="address"),
        Field("permit_category", S, source="permitCategory"),
        Field("property_use", S, source="propertyUse"),
        Field("specific_use_category", S, source="specificUseCategory"),
        Field("issue_year", I, source="issueYear"),
        Field("year_month", S, source="yearMonth"),
        Field("geom", S, source="geom"),
        Field("geo_local_area", S, source="geoLocalArea"),
    ),
)

# Declared text lengths of the permit table; counted by the audit, never cut.
PERMIT_LENGTHS = {"TYPE_OF_WORK": 255, "ADDRESS": 255, "POSTAL_CODE": 20, "PERMIT_CATEGORY": 255, "PROPERTY_USE": 255,
                  "YEAR_MONTH": 7, "GEO_LOCAL_AREA": 255}

# Fixed value: string length limit of the licence table.
MAX_STRING_LENGTH = 255

BUSINESS_LICENSES = TableContract(
    "business_licenses",
    (
        Field("FOLDER_YEAR", I, source="folderyear", required=True),
        Field("STATUS", S, source="status", max_length=MAX_STRING_LENGTH),
        Field("ISSUED_DATE", S, source="issueddate", max_length=MAX_STRING_LENGTH),
        Field("BUSINESS_NAME", S, source="businessname", required=True, max_length=MAX_STRING_LENGTH),
        Field("BUSINESS_TRADE_NAME", S, source="businesstradename", max_length=MAX_STRING_LENGTH),
        Field("BUSINESS_TYPE", S, source="businesstype", max_length=MAX_STRING_LENGTH),
        Field("BUSINESS_SUBTYPE", S, source="businesssubtype", max_length=MAX_STRING_LENGTH),
        Field("POSTAL_CODE", S, source="postalcode", required=True, max_length=MAX_STRING_LENGTH),
        Field("STREET_NAME", S, source="street", max_length=MAX_STRING_LENGTH),
        Field("LOCAL_AREA", S, source="localarea", max_length=MAX_STRING_LENGTH),
        Field("NUMBER_OF_EMPLOYEES", I, source="numberofemployees"),
    ),
    key=("POSTAL_CODE", "BUSINESS_NAME"),
)

# Permit-table column names used by the views (upper-case, as in the SQL layer).
PERMIT_VIEW_RENAME = {name: name.upper() for name in (*BUILDING_PERMITS.columns, "postal_code")}

# ---------------------------------------------------------------------------
# Class maps.  Two zoning maps disagree on purpose (the area
# roll-up and the postal profile classify 'Multiple Dwelling' and
# 'Comprehensive Development' differently); they are never merged.
# ---------------------------------------------------------------------------
ZONING_AREA = {
    "residential": ["One-Family Dwelling", "Multiple Dwelling", "Residential",
                    "Residential Inclusive", "Two-Family Dwelling", "Residential Rental"],
    "non-residential": ["Commercial", "Industrial", "Historical Area",
                        "Limited Agriculture", "Other", "Comprehensive Development"],
}

ZONING_POSTAL = {
    "residential": ["One-Family Dwelling", "Residential Inclusive", "Residential",
                    "Two-Family Dwelling", "Residential Rental"],
    "mixed": ["Comprehensive Development"],
    "non-residential": ["Commercial", "Multiple Dwelling", "Industrial",
                        "Historical Area", "Other", "Limited Agriculture"],
}
ZONING_POSTAL_DEFAULT = "unknown"

USE_AREA = {
    "residential": ["Dwelling Uses", "Live-Work Uses"],
    "non-residential": ["Office Uses", "Retail Uses", "Service Uses", "Institutional Uses",
                        "Cultural/Recreational Uses", "Manufacturing Uses", "Parking Uses",
                        "Wholesale Uses", "Transportation and Storage Uses",
                        "Utility and Communication Uses", "Agricultural Uses",
                        "Deposition or Extraction Uses", "Mural"],
}

USE_POSTAL = {"residential": ["Dwelling Uses"]}
USE_POSTAL_DEFAULT = "non-residential"

# Fixed value: postal-code pattern searched in free-text addresses.
POSTAL_CODE_PATTERN = r"([A-Za-z]\d[A-Za-z] \d[A-Za-z]\d)"

# Fixed value: follow-up horizon in years.
FOLLOWUP_HORIZON = 5
