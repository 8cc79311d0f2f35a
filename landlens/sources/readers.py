"""Sources: columnar files, delimited files, result re-reads and boundary tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landlens.contracts import TableContract
from landlens.sources.records import parse_records, read_records


def read_parquet(spark: SparkSession, path: str | Sequence[str],
                 columns: Sequence[str] | None = None,
                 schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; ``columns`` prunes the scan (ReadSchema) right away.

    The schema is read from the files each time (a rewritten folder may have
    another one) unless ``schema`` is given.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(*paths)
    return df.select(*columns) if columns else df


def delimited_reader(spark: SparkSession, sep: str = ";", quote: str = '"', escape: str = "\\", header: bool = True,
                     multiline: bool = False, empty_as_null: bool = True) -> DataFrameReader:
    """The reader of all delimited files."""
    r = (spark.read.option("header", header).option("sep", sep).option("quote", quote)
         .option("escape", escape).option("multiLine", multiline)
         .option("mode", "PERMISSIVE"))
    return r if empty_as_null else r.option("emptyValue", "").option("nullValue", "\u0000")


def read_delimited(spark: SparkSession, path: str | Sequence[str], sep: str = ";",
                   quote: str = '"', escape: str = "\\", header: bool = True,
                   multiline: bool = False, schema: T.StructType | None = None,
                   empty_as_null: bool = True, malformed_col: str | None = None) -> DataFrame:
    """Delimited text with a header; all columns strings unless ``schema`` is given.

    ``multiline=True`` lets quoted fields hold newlines (free-text addresses); the
    file is still read in pieces by many tasks (:mod:`landlens.sources.records`), at
    the price of reading it three times.  Empty fields decide how many
    rows a later null-drop removes (Q16): an unquoted empty field always reads as
    null in Spark's CSV source; a quoted empty field ``""`` reads as null too by
    default, or as ``''`` with ``empty_as_null=False``.  ``malformed_col`` adds a
    column that holds the line where it has another number of fields than the
    header (null otherwise); without it such lines read as far as they go.
    """
    r = delimited_reader(spark, sep, quote, escape, header, multiline, empty_as_null)
    paths = [path] if isinstance(path, str) else list(path)
    if (malformed_col or multiline) and schema is None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in r.option("inferSchema", False).csv(paths).columns])
    if multiline:
        return parse_records(read_records(spark, paths, sep, quote, escape, header), schema, sep, quote, escape, empty_as_null, malformed_col)
    if schema is None:
        return r.option("inferSchema", False).csv(paths)
    if malformed_col:
        schema = T.StructType([*schema.fields, T.StructField(malformed_col, T.StringType())])
        r = r.option("columnNameOfCorruptRecord", malformed_col)
    return r.schema(schema).csv(paths)


def read_result(spark: SparkSession, path: str, contract: TableContract | T.StructType,
                sep: str = ",", multiline: bool = False) -> DataFrame:
    """S3: re-read an exported result with its declared schema (no inference).

    Nulls and empty texts come back as they were written by ``export_csv``.
    """
    schema = contract.schema() if isinstance(contract, TableContract) else contract
    return read_delimited(spark, path, sep=sep, schema=schema, empty_as_null=False, multiline=multiline)


_POINT = "array<double>"
POLYGON_JSON = f"type string, coordinates array<array<{_POINT}>>"
MULTIPOLYGON_JSON = f"type string, coordinates array<array<array<{_POINT}>>>"


def parse_polygons(geojson: Column) -> Column:
    """GeoJSON text -> its polygons, each its outer ring and then its holes, as points (x, y); null for another geometry."""
    one, many = F.from_json(geojson, POLYGON_JSON), F.from_json(geojson, MULTIPOLYGON_JSON)
    shapes = F.when(one["type"] == "Polygon", F.array(one["coordinates"])).when(many["type"] == "MultiPolygon", many["coordinates"])
    return F.transform(shapes, lambda polygon: F.transform(polygon, lambda ring: F.transform(
        ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))))


def boundaries_from_geojson(df: DataFrame, name_col: str = "name",
                            geojson_col: str = "geojson") -> DataFrame:
    """``(name, GeoJSON text)`` -> ``(name, polygons)``.

    ``polygons`` is ``ARRAY<ARRAY<ARRAY<STRUCT<x=lon, y=lat>>>>``: the polygons of
    an area (one for a Polygon, all for a MultiPolygon), each its outer ring and
    then its holes.  A text that is no such geometry, or has a ring of fewer than
    three points or a point without two numbers, gives null; open rings are closed
    by what uses them.  ``operators.boundaries.check_boundaries`` says why a boundary
    is unfit, ``plans.loads.run_boundaries`` keeps the fit ones and counts the others.
    Re-aim of a shapefile read: any source that yields polygon text per area feeds it.
    """
    read = df.select(F.col(name_col).alias("name"), parse_polygons(F.col(geojson_col)).alias("polygons"))
    whole = (F.size("polygons") > 0) & F.forall("polygons", lambda polygon: (F.size(polygon) > 0) & F.forall(
        polygon, lambda ring: (F.size(ring) >= 3) & F.forall(ring, lambda p: p["x"].isNotNull() & p["y"].isNotNull())))
    return read.withColumn("polygons", F.when(whole, F.col("polygons")))
