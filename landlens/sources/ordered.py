"""Ordered export (O1, O2): a declared row order that survives the files.

A sorted frame loses its order when its files are read again: Spark packs files and
pieces of files into tasks by size.  Here the rows are dealt to ranges of the order,
each range is sorted and written by one task, and the number of the range is in the
name of its file, so files in the order of their numbers hold the rows in order.  A
manifest (``_manifest`` in the folder, which readers of the data pass over) lists the
files in order with the number of rows before each and the first and last key.
``read_ordered`` gives every row its position from where it stands, without a sort.

Nothing is collected: ranges come from a sample of the keys, the manifest has a row
a file.  A file is at most a range; rows with equal keys are in one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landlens.sources.readers import delimited_reader
from landlens.sources.sinks import csv_writer

MANIFEST = "_manifest"
POSITION = "position"


def as_key(c: str | Column) -> Column:
    """A sort key; a bare name sorts upwards with nulls last (Q3)."""
    return F.col(c).asc_nulls_last() if isinstance(c, str) else c


def _number(name: str | Column) -> tuple[Column, Column]:
    """Range and part of a range from a file's name (``part-00012-...-c001...``); as numbers, since names are not padded beyond five digits."""
    name = F.col(name) if isinstance(name, str) else name
    return (F.regexp_extract(name, r"part-(\d+)", 1).cast("bigint"), F.coalesce(F.regexp_extract(name, r"-c(\d+)", 1).try_cast("bigint"), F.lit(0).cast("bigint")))


def write_ordered(df: DataFrame, path: str, order: Sequence[str], fmt: str = "parquet", files: int | None = None, sep: str = ",",
                  null_text: str | None = None, multiline: bool = False) -> DataFrame:
    """Writes ``df`` in ``order`` (column names, nulls last) as Parquet or CSV with a manifest; returns the manifest.

    ``files`` is the number of ranges (default: the shuffle partitions, coalesced
    by AQE to its advisory size).  ``multiline`` says that texts hold newlines.
    """
    keys = [as_key(c) for c in order]
    dealt = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    dealt = dealt.sortWithinPartitions(*keys)
    if fmt == "csv":
        csv_writer(dealt, sep=sep, null_text=null_text).csv(path)
    elif fmt == "parquet":
        dealt.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"no ordered export as {fmt!r}")
    back = _scan(df.sparkSession, path, df.schema, fmt, sep, null_text, multiline)
    _manifest(_placed(back, fmt), order).write.mode("overwrite").json(f"{path}/{MANIFEST}")
    return read_manifest(df.sparkSession, path)


def _scan(spark: SparkSession, path: str, schema: T.StructType, fmt: str, sep: str, null_text: str | None, multiline: bool) -> DataFrame:
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    r = delimited_reader(spark, sep=sep, multiline=multiline, empty_as_null=False)
    if null_text is not None:
        r = r.option("nullValue", null_text)
    return r.schema(T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])).csv(path)


def _placed(df: DataFrame, fmt: str) -> DataFrame:
    """With __file, __range, __part, __block and __at: a row's place grows with __at inside its block."""
    name = F.col("_metadata.file_name")
    block, at = (F.lit(0).cast("bigint"), F.col("_metadata.row_index")) if fmt == "parquet" else (F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    number, part = _number(name)
    return df.select("*", name.alias("__file"), number.alias("__range"), part.alias("__part"), block.alias("__block"), at.alias("__at"))


_FILE = ["__range", "__part"]


def _starts(placed: DataFrame) -> DataFrame:
    """For each block the place of its first row and the number of rows before it; a row a block."""
    blocks = placed.groupBy(*_FILE, "__block").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy(*_FILE, "__block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))


def _manifest(placed: DataFrame, order: Sequence[str]) -> DataFrame:
    key = F.to_json(F.struct(*[F.col(c) for c in order]), {"ignoreNullFields": "false"})
    place = F.struct("__block", "__at")
    files = placed.groupBy("__file", *_FILE).agg(F.count(F.lit(1)).alias("n_rows"), F.min_by(key, place).alias("first_key"), F.max_by(key, place).alias("last_key"))
    earlier = Window.orderBy(*_FILE).rowsBetween(Window.unboundedPreceding, -1)
    return files.select(F.row_number().over(Window.orderBy(*_FILE)).alias("ordinal"), F.col("__file").alias("file"), "n_rows",
                        F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)).alias("rows_before"), "first_key", "last_key")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """ordinal, file, n_rows, rows_before, first_key, last_key of an ordered export, a row a file."""
    return spark.read.schema("ordinal int, file string, n_rows bigint, rows_before bigint, first_key string, last_key string").json(f"{path}/{MANIFEST}")


def read_ordered(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", sep: str = ",", null_text: str | None = None,
                 multiline: bool = False, position: str = POSITION) -> DataFrame:
    """The rows of an ordered export with their position from 1; read in parallel, pieces of a file by different tasks.

    Positions come from the files as they are: number of the file, piece of the file,
    place in the piece.
    """
    placed = _placed(_scan(spark, path, schema, fmt, sep, null_text, multiline), fmt)
    starts = _starts(placed)
    keys = [*_FILE, "__block"]
    out = placed.join(starts, keys).withColumn(position, F.col("__before") + F.col("__at") - F.col("__first") + 1)
    return out.select(*[f.name for f in schema.fields], position)
