"""O1, O2: the declared order of an export, kept by its files."""

import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from landlens.session import scratch_path
from landlens.sources import export_csv, read_manifest, read_ordered, write_ordered

ORDER = ("area", "code", "year")
SCHEMA = "area string, code string, year int, note string"


def rows(n=3000, seed=1):
    rng = random.Random(seed)
    out = [(rng.choice(["North", "south", "Éast", "", None]), rng.choice([f"V{k}" for k in range(40)] + [None]), rng.randint(0, 9), f'n{k} "x"; y\\') for k in range(n)]
    return out


def in_order(given):
    return sorted(given, key=lambda r: [(v is None, v if v is not None else 0) for v in r[:3]])


def frame(spark, given):
    return spark.createDataFrame(given, SCHEMA).repartition(6)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_positions_of_the_reread_rows_are_the_order(spark, fmt):
    given, path = rows(), scratch_path(spark, "ordered")
    df = frame(spark, given)
    listed = write_ordered(df, path, ORDER, fmt=fmt, files=9)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # pieces of files are read by different tasks
    back = read_ordered(spark, path, df.schema, fmt=fmt)
    assert fmt == "parquet" or back.rdd.getNumPartitions() > 9
    got = sorted(back.collect(), key=lambda r: r.position)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
    assert [r.position for r in got] == list(range(1, len(given) + 1))
    assert [tuple(r)[:3] for r in got] == [r[:3] for r in in_order(given)]
    assert sorted((tuple(r)[:4] for r in got), key=repr) == sorted(given, key=repr)
    files = listed.orderBy("ordinal").collect()
    assert len(files) == 9 and [f.ordinal for f in files] == list(range(1, 10)) and sum(f.n_rows for f in files) == len(given)
    for f in files:
        first, last = (tuple(json.loads(k)[c] for c in ORDER) for k in (f.first_key, f.last_key))
        assert first == tuple(got[f.rows_before])[:3] and last == tuple(got[f.rows_before + f.n_rows - 1])[:3]
    on_disk = sorted(os.path.basename(p) for p in glob.glob(f"{path.removeprefix('file:')}/part-*"))
    assert [f.file for f in files] == on_disk


def test_an_unordered_export_shows_in_the_positions(spark):
    given, path = rows(500), scratch_path(spark, "unordered")
    df = frame(spark, given)
    export_csv(df, path)
    got = sorted(read_ordered(spark, path, df.schema, fmt="csv").collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(1, 501)) and [tuple(r)[:3] for r in got] != [r[:3] for r in in_order(given)]


def test_texts_with_newlines_and_a_text_for_null(spark):
    given = [("a", "1", 1, "two\nlines"), ("b", None, 2, None), (None, "2", 3, "")]
    path, df = scratch_path(spark, "newlines"), frame(spark, given)
    write_ordered(df, path, ORDER, fmt="csv", files=2, null_text="null", multiline=True)
    got = read_ordered(spark, path, df.schema, fmt="csv", null_text="null", multiline=True).orderBy("position").collect()
    assert [tuple(r) for r in got] == [(*r, k + 1) for k, r in enumerate(given)]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_an_empty_export_reads_as_empty(spark, fmt):
    path, df = scratch_path(spark, "none"), frame(spark, rows(5)).where("year > 99")
    assert write_ordered(df, path, ORDER, fmt=fmt).collect() == []
    assert read_ordered(spark, path, df.schema, fmt=fmt).collect() == []


def test_file_numbers_order_as_numbers(spark):
    from landlens.sources.ordered import _number

    names = ["part-00009-u-c000.csv", "part-00010-u-c000.csv", "part-00010-u-c001.csv", "part-99999-u-c000.csv", "part-100000-u-c000.csv"]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "n string").select("n", *[c.alias(f"k{i}") for i, c in enumerate(_number(F.col("n")))])
    assert [r.n for r in df.orderBy("k0", "k1").collect()] == names
    with pytest.raises(ValueError):
        write_ordered(df, scratch_path(spark, "x"), ["n"], fmt="xml")
