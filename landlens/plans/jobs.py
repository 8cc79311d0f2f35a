"""The four cleaning jobs (raw files -> typed tables), as DataFrame builders.

Each job is one lazy plan: scan -> project -> (extract) -> null drop ->
de-duplicate -> conform types.  There is no preview action before the write
(the source ran the plan twice: once to show rows, once to load).  The order
of steps is kept on purpose: nulls are dropped and rows de-duplicated
*before* casting, so a value that fails to cast leaves a null in a kept row,
and rows equal only after casting both stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landlens.contracts import (
    BUILDING_PERMITS, BUILDING_PERMITS_COLUMNAR, BUSINESS_LICENSES, PERMIT_VIEW_RENAME, PROPERTY_TAX,
)
from landlens.functions.casts import conform_column
from landlens.operators import clean
from landlens.operators.boundaries import check_boundaries
from landlens.plans import loads
from landlens.plans.loads import MALFORMED
from landlens.session import conf_for
from landlens.sources import readers


def clean_property_tax(raw: DataFrame) -> DataFrame:
    """Property tax: C1 -> C3 -> C5 -> C6."""
    df = clean.select_columns(raw, PROPERTY_TAX.source_columns)
    df = clean.drop_incomplete(df)
    df = clean.dedupe(df)
    return clean.conform(df, PROPERTY_TAX)


def clean_building_permits(raw: DataFrame, postal_pattern: str | None = None,
                           no_code_as_null: bool = False) -> DataFrame:
    """Permits, delimited layout: C1 -> C2 -> C10 -> C3 -> C5 -> C6.

    A permit whose address holds no postal code keeps ``postal_code = ''`` and
    survives the null drop (only a null address removes it).  With
    ``no_code_as_null`` it survives with a null code instead, which joins with
    nothing, so the permits without a code form no hot ``''`` key.  Malformed lines
    go if the file was read with ``malformed_col=MALFORMED``.
    """
    if MALFORMED in raw.columns:
        raw = raw.where(F.col(MALFORMED).isNull())
    df = clean.select_columns(raw, BUILDING_PERMITS.source_columns)
    df = clean.rename_columns(df, BUILDING_PERMITS.rename_map())
    df = clean.with_postal_code(df, "address", "postal_code",
                                **({"pattern": postal_pattern} if postal_pattern else {}))
    if no_code_as_null:
        df = df.withColumn("postal_code", F.nullif("postal_code", F.lit("")))
        return _with_postal(clean.dedupe(clean.drop_incomplete(df, BUILDING_PERMITS.columns)), BUILDING_PERMITS)
    df = clean.drop_incomplete(df)
    df = clean.dedupe(df)
    return _with_postal(df, BUILDING_PERMITS)


def _with_postal(df: DataFrame, contract) -> DataFrame:
    """Conform the contract columns and carry the extracted ``postal_code`` along."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    cols = [conform_column(F.col(f.target if f.target in schema else f.src), f.dtype,
                           schema.get(f.target, schema.get(f.src))).alias(f.target)
            for f in contract.fields]
    return df.select(*cols, F.col("postal_code").cast("string").alias("postal_code"))


def clean_building_permits_columnar(raw: DataFrame) -> DataFrame:
    """Permits, older columnar layout: C1 -> C10 -> C3 -> C5 -> C6 -> C2 (renamed last)."""
    df = clean.select_columns(raw, BUILDING_PERMITS_COLUMNAR.source_columns)
    df = clean.with_postal_code(df, "address", "postal_code")
    df = clean.drop_incomplete(df)
    df = clean.dedupe(df)
    return _with_postal(df, BUILDING_PERMITS_COLUMNAR)


def clean_business_licenses(raw: DataFrame) -> DataFrame:
    """Licences: C1/C2 -> C4 -> C6 -> C7 -> C8.  No de-duplication (exact copies stay)."""
    c = BUSINESS_LICENSES
    df = clean.select_columns(raw, c.source_columns)
    df = clean.rename_columns(df, c.rename_map())
    df = clean.require(df, c.required)                 # null check before the cast ...
    df = clean.conform(df, c)                          # ... cast + truncate to 255 ...
    return clean.require(df, c.required)               # ... and again after it (bad year text)


def rejected_business_licenses(raw: DataFrame) -> DataFrame:
    """Raw licence rows that the job drops, with their ``reason``."""
    rows = clean.select_columns(raw, BUSINESS_LICENSES.source_columns)
    return rows.withColumn("reason", clean.reject_reason(rows, BUSINESS_LICENSES)).where("reason IS NOT NULL")


def licence_outcomes(raw: DataFrame) -> DataFrame:
    """``(outcome, n_rows)``: licences kept, and dropped by reason; they sum up to the rows read."""
    rows = clean.select_columns(raw, BUSINESS_LICENSES.source_columns)
    return clean.outcomes(rows, clean.reject_reason(rows, BUSINESS_LICENSES))


def permit_reject_reason(raw: DataFrame) -> Column:
    """Why the permit job drops a raw row before it looks for copies: ``malformed`` line or ``missing:COLUMN``."""
    line = [F.when(F.col(MALFORMED).isNotNull(), F.lit("malformed"))] if MALFORMED in raw.columns else []
    return F.coalesce(*line, *[F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in BUILDING_PERMITS.source_columns])


def permit_outcomes(raw: DataFrame) -> DataFrame:
    """``(outcome, n_rows)`` of the delimited permit file read with ``malformed_col=MALFORMED``; kept rows still hold copies."""
    return clean.outcomes(raw, permit_reject_reason(raw))


def permits_view_table(permits: DataFrame) -> DataFrame:
    """Permit table with the upper-case names used by the SQL layer."""
    return clean.rename_columns(permits, PERMIT_VIEW_RENAME)


def run_cleaning(spark: SparkSession, tax_path: str | None = None, permits_csv_path: str | None = None,
                 permits_parquet_path: str | None = None, licences_path: str | None = None,
                 target: str | None = None, mode: str = "overwrite", multiline: bool = False,
                 boundaries: DataFrame | None = None, split_bytes: int | None = None) -> dict[str, DataFrame]:
    """Run the cleaning jobs whose inputs are given (S11: plain arguments).

    With ``target`` (a folder on shared storage) each table is written as
    Parquet under it and re-read, so later stages start from the written
    table (lineage cut, survives executor loss).  A raw table is scanned once
    (:mod:`landlens.plans.loads`): its clean rows are in ``outcome=kept``, its rejected
    ones beside them (``rejected``); the counted outcomes (``outcomes/``) and the
    contract audit (``audit/``) come from that write.  ``boundaries`` are (name, geojson).
    ``split_bytes`` limits what a task reads of raw files that are much smaller than their
    rows (compressed ones): copies are first collapsed in its memory.
    Otherwise lazy frames are returned.
    """
    raw: dict[str, tuple[DataFrame, str]] = {}
    if tax_path:
        raw["property_tax"] = readers.read_parquet(spark, tax_path), "property_tax"
    if permits_csv_path:
        lines = readers.read_delimited(spark, permits_csv_path, sep=";", malformed_col=MALFORMED, multiline=multiline)
        raw["building_permits"] = lines, "building_permits"
    elif permits_parquet_path:
        raw["building_permits"] = readers.read_parquet(spark, permits_parquet_path), "building_permits_columnar"
    if licences_path:
        raw["business_licenses"] = readers.read_parquet(spark, licences_path), "business_licenses"
    if not target:
        lazy = {"property_tax": clean_property_tax, "business_licenses": clean_business_licenses,
                "building_permits": lambda df: permits_view_table(clean_building_permits(df)),
                "building_permits_columnar": lambda df: permits_view_table(clean_building_permits_columnar(df))}
        out = {name: lazy[load](df) for name, (df, load) in raw.items()}
        if boundaries is not None:
            out["boundaries"] = check_boundaries(boundaries).where("reason IS NULL").select("name", "polygons")
        return out
    target, out = target.rstrip("/"), {}
    with conf_for(spark, {"spark.sql.files.maxPartitionBytes": str(split_bytes)} if split_bytes else {}):
        loaded = {name: loads.run_load(df, loads.LOADS[load], f"{target}/{name}", mode) for name, (df, load) in raw.items()}
    if boundaries is not None:
        loaded["boundaries"] = loads.run_boundaries(boundaries, f"{target}/boundaries", mode)
    for name, parts in loaded.items():
        out[name] = parts.clean
        parts.outcomes.write.mode(mode).parquet(f"{target}/outcomes/{name}")
        parts.audit.write.mode(mode).parquet(f"{target}/audit/{name}")
    return out


def rejected(spark: SparkSession, target: str, name: str) -> DataFrame:
    """The rejected rows that ``run_cleaning`` left below ``target``, with their reason."""
    path = f"{target.rstrip('/')}/{name}"
    written = spark.read.parquet(path)
    if name == "boundaries":
        return written.where("outcome = 'rejected'").select("name", "polygons", F.col("__reason").alias("reason"))
    return loads.rejected_rows(spark, path, written.schema)


__all__ = ["clean_property_tax", "clean_building_permits", "clean_building_permits_columnar",
           "clean_business_licenses", "permits_view_table", "run_cleaning"]
