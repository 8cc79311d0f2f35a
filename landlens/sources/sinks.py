"""Sinks: typed tables, CSV exports and the heat-map feed."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from landlens.contracts import TableContract

#: Rows of a part of a single file: parts are joined one by one, so beside the file there is disk for one of them.
PART_ROWS = 500_000


def declare_table(spark: SparkSession, name: str, contract: TableContract,
                  location: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with the contract's columns (Parquet).

    NOT NULL is enforced by :func:`landlens.operators.clean.enforce_contract`
    and reported by ``audit``; the declared key is informational only.
    """
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({contract.ddl()}) USING parquet{loc}")


def write_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Load a cleaned frame into a named table.

    ``overwrite`` by default so a re-run does not double the data; ``append``
    reproduces the load-and-add behaviour.  Writes are task-atomic (output
    committer), so a lost executor only re-runs its tasks.
    """
    if mode == "append" and df.sparkSession.catalog.tableExists(name):
        df.select(*df.sparkSession.table(name).columns).write.mode("append").insertInto(name)
    else:
        df.write.mode(mode).format("parquet").saveAsTable(name)


def stage(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once below ``path`` (Parquet, zstd) and read from there: for a frame that several loads take rows from."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def csv_writer(df: DataFrame, sep: str = ",", header: bool = True, null_text: str | None = None) -> DataFrameWriter:
    """The writer of all CSV exports: quotes and escapes as in ``read_delimited``, an empty text as ``""``, a null as ``null_text`` or nothing."""
    w = (df.write.mode("overwrite").option("header", header).option("sep", sep)
         .option("quote", '"').option("escape", "\\").option("emptyValue", '""'))
    return w if null_text is None else w.option("nullValue", null_text)


def export_csv(df: DataFrame, path: str, sep: str = ",", single_file: bool = False,
               header: bool = True, null_text: str | None = None, compression: str | None = None,
               file_rows: int | None = None) -> None:
    """CSV export, parallel (one file per partition) or as a single file.

    ``single_file`` joins the files of all tasks to one: their bytes are copied in order
    and each is removed when it is copied, so no row is shuffled and the disk holds the
    file and a part of it (``PART_ROWS``).  One process copies; a compressed single file is
    still written by one task (``repartition(1)``).
    Quotes and escapes use the same settings as
    :func:`landlens.sources.readers.read_delimited`; an empty text is written as
    ``""`` and a null as nothing, so text holding the separator, quotes, newlines
    (with ``multiline``) or nothing reads back unchanged by ``read_result``.  A
    compressed file (``compression="gzip"``) is read by one task: ``file_rows`` limits its rows.
    """
    if single_file and compression is None:
        return _export_single(df, path.rstrip("/"), sep, header, null_text)
    w = csv_writer(df.repartition(1) if single_file else df, sep, header, null_text)
    for option, value in (("compression", compression), ("maxRecordsPerFile", file_rows)):
        w = w if value is None else w.option(option, value)
    w.csv(path)


def _export_single(df: DataFrame, path: str, sep: str, header: bool, null_text: str | None) -> None:
    """One file below ``path``: its header (Spark writes it for no rows), then the rows of all partitions in order."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(conf)

    def parts(folder: str) -> list[str]:
        names = [f.getPath().getName() for f in fs.listStatus(at(folder))]
        found = {name: re.fullmatch(r"part-(\d+)-.*-c(\d+)\.csv", name) for name in names}
        return sorted((name for name in names if found[name]), key=lambda name: tuple(map(int, found[name].groups())))

    csv_writer(df.limit(0), sep, header, null_text).csv(path)
    fs.delete(at(f"{path}/_SUCCESS"), False)
    for name in parts(path):
        fs.rename(at(f"{path}/{name}"), at(f"{path}/_header"))
    csv_writer(df, sep, False, null_text).option("maxRecordsPerFile", PART_ROWS).csv(f"{path}/_parts")
    out = fs.create(at(f"{path}/_single"), True)
    try:
        for name in ("_header", *(f"_parts/{name}" for name in parts(f"{path}/_parts"))):
            if fs.exists(at(f"{path}/{name}")):
                part = fs.open(at(f"{path}/{name}"))
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
                finally:
                    part.close()
                fs.delete(at(f"{path}/{name}"), False)
    finally:
        out.close()
    fs.delete(at(f"{path}/_parts"), True)
    if not fs.rename(at(f"{path}/_single"), at(f"{path}/part-00000.csv")):
        raise OSError(f"{path}/_single was not renamed")
    fs.create(at(f"{path}/_SUCCESS"), True).close()


def heat_map_feed(v12: DataFrame) -> DataFrame:
    """One row per postal code with a usable point and its measures."""
    return v12.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        "postal_code", "latitude", "longitude", "zoning", "property_use", "property_count",
        "permit_count", "total_land_value", "total_project_value", "year")
