"""Run everything: clean the raw files, build every named result, write the outputs.

``run_all`` is the batch entry point (job parameters are plain arguments, S11):

1. the cleaning jobs write typed Parquet tables under ``out/clean`` and the
   rest of the run reads them back (lineage cut at a written table);
2. every named result (V1-V17) is registered as a temporary view (S8) and
   written as Parquet under ``out/results/<name>``; results that others are built
   from are read back from there.  The bridge (V6) is written compressed, as its
   distinct (postal, area) pairs with the number of rows each stands for; the
   product itself is never written.  V4 and V5 are written in their declared
   order (O1, O2), as numbered ranges with a manifest;
3. the unloads of the source are written as CSV (S6/S7) from the written
   results: the area tables, whose size is bounded by areas x years, as one
   file; the others, which grow with the postal codes or the input, in parallel,
   V5 in its order (``sources.ordered``);
4. scratch tables are removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landlens.operators import fanout
from landlens.plans import jobs, views
from landlens.session import clear_scratch, scratch_mark
from landlens.sources import export_csv, write_ordered
from landlens.sources.layout import bucketed_session, bucketed_tables

# result name -> (separator, single file?, text for null)
CSV_UNLOADS = {
    "investment_land_value_followup": (",", False, None),
    "combined_building_permits_property_tax_view": (",", True, None),
    "property_and_permits_grouped": (";", False, None),
    "investment_vs_land_value": (",", True, "null"),
    "building_permits": (";", False, None),
    "property_tax": (";", False, None),
}

#: Results with a declared order (nulls last), kept by their files.
ORDERED = {
    "combined_by_local_area": ("LOCAL_AREA", "YEAR"),
    "investment_land_value_followup": ("LOCAL_AREA", "POSTAL_CODE", "INVESTMENT_YEAR", "FOLLOWUP_YEAR"),
}

BRIDGE = "postal_code_local_area_view"


def written_form(name: str, reg, options: views.ViewOptions) -> DataFrame:
    """What ``run_all`` writes for a named result: V6 compressed, the others as they are."""
    if name == BRIDGE:
        w = fanout.bridge_weights(reg.get("property_tax"), reg.get("building_permits"), options.weighting)
        return w.select(F.col("__postal").alias("POSTAL_CODE"), "LOCAL_AREA", F.col("__w").alias("n_rows"))
    return reg.get(name)


def run_all(spark: SparkSession, out: str, tax_path: str, licences_path: str,
            permits_csv_path: str | None = None, permits_parquet_path: str | None = None,
            boundaries: DataFrame | None = None,
            options: views.ViewOptions = views.DEFAULT, multiline: bool = False,
            layout: str | None = None, buckets: int = 0) -> dict[str, str]:
    """Clean, build and write everything; returns ``{name: output path}``.

    With ``layout`` (a prefix of table names in the catalog) and ``buckets`` the clean tables
    are stored by postal code first (:mod:`landlens.sources.layout`), which saves the
    results their shuffles of them.
    """
    if layout and buckets:
        with bucketed_session(spark):
            return _run_all(spark, out, tax_path, licences_path, permits_csv_path, permits_parquet_path, boundaries, options, multiline, layout, buckets)
    return _run_all(spark, out, tax_path, licences_path, permits_csv_path, permits_parquet_path, boundaries, options, multiline)


def _run_all(spark: SparkSession, out: str, tax_path: str, licences_path: str, permits_csv_path: str | None, permits_parquet_path: str | None,
             boundaries: DataFrame | None, options: views.ViewOptions, multiline: bool, layout: str | None = None, buckets: int = 0) -> dict[str, str]:
    out, mark = out.rstrip("/"), scratch_mark()
    unchecked = boundaries is not None and "geojson" in boundaries.columns  # (name, geojson), else (name, polygons)
    tables = jobs.run_cleaning(spark, tax_path=tax_path, permits_csv_path=permits_csv_path,
                               permits_parquet_path=permits_parquet_path,
                               licences_path=licences_path, target=f"{out}/clean", multiline=multiline,
                               boundaries=boundaries if unchecked else None)
    if boundaries is not None and not unchecked:
        tables["boundaries"] = boundaries
    if layout:
        tables = bucketed_tables(tables, layout, buckets)
    reg = views.build_registry(spark, tables, options)
    written: dict[str, str] = {}
    for name in reg.names():
        if name in tables:
            continue
        path = f"{out}/results/{name}"
        result = written_form(name, reg, options)
        if name in ORDERED:
            write_ordered(result, path, ORDERED[name])
        else:
            result.write.mode("overwrite").parquet(path)
        written[name] = path
        if name != BRIDGE:
            reg.replace(name, spark.read.parquet(path))
    reg.register()
    for name, (sep, single, null_text) in CSV_UNLOADS.items():
        path = f"{out}/csv/{name}"
        if name in ORDERED:
            write_ordered(reg.get(name), path, ORDERED[name], fmt="csv", sep=sep, null_text=null_text)
        else:
            export_csv(reg.get(name), path, sep=sep, single_file=single, null_text=null_text)
        written[f"{name}.csv"] = path
    clear_scratch(spark, since=mark)
    return written


def main(argv: list[str] | None = None) -> None:
    """Command line (S11): ``python -m landlens.plans.run --out DIR --tax P --licences P
    (--permits-csv P | --permits-parquet P) [--cores N] [--input-bytes N]``.

    With ``--cores`` shuffles and scans are sized to the input, also in a running
    session.  A cluster whose settings would make partitions of several GiB is
    refused before any work is done.
    """
    import argparse

    from landlens.session import apply_conf, build_session, input_size, scale_conf, too_few_partitions

    ap = argparse.ArgumentParser(description="clean the raw files, build and write every result")
    ap.add_argument("--out", required=True, help="shared output folder")
    ap.add_argument("--tax", required=True, help="raw property-tax Parquet path")
    ap.add_argument("--licences", required=True, help="raw business-licence Parquet path")
    g = ap.add_mutually_exclusive_group(required=True)
    g.add_argument("--permits-csv", help="raw building-permit delimited path (';')")
    g.add_argument("--permits-parquet", help="raw building-permit Parquet path (older layout)")
    ap.add_argument("--multiline", action="store_true", help="quoted permit fields hold newlines (the files are still read in pieces)")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    ap.add_argument("--input-bytes", type=int, default=None, help="input size, for partition sizing (default: from the file listing)")
    ap.add_argument("--cores", type=int, default=None, help="total executor cores, for partition sizing (default: the cluster's)")
    a = ap.parse_args(argv)
    from pyspark.sql import SparkSession
    existing = SparkSession.getActiveSession()
    spark = existing or build_session(a.master)
    size = a.input_bytes or input_size(spark, *[p for p in (a.tax, a.licences, a.permits_csv, a.permits_parquet) if p])
    if a.cores:
        apply_conf(spark, scale_conf(size, a.cores))
    if problem := too_few_partitions(spark, size):
        ap.error(problem)
    for name, path in sorted(run_all(spark, a.out, tax_path=a.tax, licences_path=a.licences,
                                     permits_csv_path=a.permits_csv,
                                     permits_parquet_path=a.permits_parquet,
                                     multiline=a.multiline).items()):
        print(f"{name}\t{path}")
    if existing is None:
        spark.stop()


if __name__ == "__main__":
    main()
