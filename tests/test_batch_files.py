"""Batch cleaning: raw files are compressed and cut, outcomes are written side by side."""

import glob
import os

from pyspark.sql import functions as F

from landlens.plans import driver, jobs, loads
from landlens.session import conf_for
from landlens.sources import export_csv, read_delimited, sinks


def test_compressed_exports_are_cut_by_rows_and_read_back(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit('a; "b"').alias("t")).coalesce(1)
    export_csv(rows, str(tmp_path / "x"), sep=";", compression="gzip", file_rows=300)
    assert len(glob.glob(str(tmp_path / "x" / "*.csv.gz"))) == 4
    back = read_delimited(spark, str(tmp_path / "x"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_a_single_file_is_joined_from_parts_without_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "PART_ROWS", 300)
    rows = spark.range(0, 2500, 1, 3).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 2 == 0, F.lit('a; "b"\nc')).alias("t"))
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "part-00007.csv").write_text("from an earlier run")
    spark.sparkContext.setJobGroup("single", "single")
    try:
        export_csv(rows, str(tmp_path / "x"), sep=";", single_file=True)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    assert [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("single")] == [1, 1]
    assert sorted(f for f in os.listdir(tmp_path / "x") if not f.startswith(".")) == ["_SUCCESS", "part-00000.csv"]
    text = (tmp_path / "x" / "part-00000.csv").read_text()
    assert text == "k;t\n" + "".join(f'{i};' + ('"a; \\"b\\"\nc"' if i % 2 == 0 else "") + "\n" for i in range(2500))
    export_csv(rows.limit(0), str(tmp_path / "x"), single_file=True)
    assert (tmp_path / "x" / "part-00000.csv").read_text() == "k,t\n"
    export_csv(rows.limit(1), str(tmp_path / "x"), single_file=True, header=False, null_text="none")
    assert (tmp_path / "x" / "part-00000.csv").read_text() == '0,"a; \\"b\\"\nc"\n'


def test_the_multiline_job_keeps_rows_and_not_the_file(spark, tmp_path, monkeypatch):
    days = "TIMESTAMP'1998-02-03 00:00:00'"
    spark.sql(f"""SELECT id div 7 AS l_orderkey, id % 5 AS l_suppkey, CAST(id % 7 + 1 AS INT) AS l_linenumber, id * 1.25D AS l_extendedprice,
                  'N' AS l_returnflag, 'O' AS l_linestatus, {days} AS l_shipdate FROM range(700)""").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.sql("SELECT id AS s_suppkey, CAST(id % 2 AS INT) AS s_nationkey FROM range(4)").write.parquet(str(tmp_path / "supplier.parquet"))
    spark.sql("SELECT CAST(id AS INT) AS n_nationkey, concat('N', id) AS n_name FROM range(2)").write.parquet(str(tmp_path / "nation.parquet"))
    paths, real = [], driver.scratch_path
    monkeypatch.setattr(driver, "scratch_path", lambda s, name: paths.append(real(s, name)) or paths[-1])
    got = driver.QUERIES["clean_permits_multiline_job"](spark, str(tmp_path))
    raw, kept = (p.removeprefix("file:") for p in paths)
    assert not os.path.exists(raw) and all(kept in f for f in got.inputFiles())
    rows = got.collect()
    assert len(rows) == 480  # of 700: no address in 100, no area for a fifth of the others
    assert {r.address.count("\n") for r in rows if r.permit_category == "C4"} == {2} and {r.permit_category for r in rows} == {f"C{i}" for i in range(2, 8)}


def test_outcomes_are_written_without_a_sort_and_the_session_keeps_its_settings(spark, tmp_path):
    raw = spark.createDataFrame([(i, None if i % 3 == 0 else "x") for i in range(30)], "k int, t string")
    rows = raw.withColumn(loads.OUTCOME, F.when(F.col("t").isNull(), "rejected").otherwise("kept"))
    plans = []
    real = loads.conf_for

    def noted(session, conf):
        plans.append(dict(conf))
        return real(session, conf)

    loads.conf_for = noted
    try:
        counted, schema = loads._observed_write(rows, "t", {"n": F.count(F.lit(1))}, str(tmp_path / "t"), "overwrite")
    finally:
        loads.conf_for = real
    assert plans == [{"spark.sql.maxConcurrentOutputFileWriters": "2"}] and counted == {"n": 30}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert sorted(os.listdir(tmp_path / "t"))[-2:] == ["outcome=kept", "outcome=rejected"]
    assert spark.read.parquet(str(tmp_path / "t")).where("outcome = 'rejected'").count() == 10
    assert all(".zstd." in f for f in glob.glob(str(tmp_path / "t" / "outcome=*" / "*.parquet")))


def test_a_split_limit_holds_for_the_cleaning_only(spark, tmp_path, monkeypatch):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    raw = spark.range(20000).select(*[F.col("id").cast("string").alias(c) for c in loads.PROPERTY_TAX.source_columns])
    raw.coalesce(1).write.option("maxRecordsPerFile", 5000).parquet(str(tmp_path / "raw"))
    size = max(os.path.getsize(f) for f in glob.glob(str(tmp_path / "raw" / "*.parquet")))
    seen, real = [], loads.run_load

    def noted(df, *rest):
        seen.append(df.rdd.getNumPartitions())
        return real(df, *rest)

    monkeypatch.setattr(loads, "run_load", noted)
    with conf_for(spark, {"spark.sql.files.openCostInBytes": "0"}):
        out = jobs.run_cleaning(spark, tax_path=str(tmp_path / "raw"), target=str(tmp_path / "out"), split_bytes=size)
        jobs.run_cleaning(spark, tax_path=str(tmp_path / "raw"), target=str(tmp_path / "out2"))
    assert seen[0] >= 4 and out["property_tax"].count() == 20000
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
