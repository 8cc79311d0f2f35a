"""Source behaviour: schemas, malformed lines, round trips."""

from landlens.plans import jobs
from landlens.session import scratch_path
from landlens.sources import export_csv, read_delimited, read_result, readers


def test_a_rewritten_folder_is_read_with_its_new_schema(spark):
    path = scratch_path(spark, "rewritten")
    spark.createDataFrame([(1, "a")], "k int, old string").write.parquet(path)
    assert readers.read_parquet(spark, path).columns == ["k", "old"]
    spark.createDataFrame([(2, "b")], "k int, new string").write.mode("overwrite").parquet(path)
    assert [tuple(r) for r in readers.read_parquet(spark, path).select("new").collect()] == [("b",)]


def test_scan_reads_only_the_columns_asked_for(spark, smoke_dir):
    df = readers.read_parquet(spark, f"{smoke_dir}/lineitem.parquet", columns=["l_quantity"])
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double>" in p and "Exchange" not in p


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text("a;b;c\n1;2;3\n4;5\n6;7;8;9\n;;\n")
    raw = read_delimited(spark, str(p), malformed_col=jobs.MALFORMED)
    got = sorted((r.a, r[jobs.MALFORMED]) for r in raw.collect() if r[jobs.MALFORMED] is not None)
    assert got == [("4", "4;5"), ("6", "6;7;8;9")]
    assert sum(r[jobs.MALFORMED] is None for r in raw.collect()) == 2


def test_empty_and_null_texts_come_back_as_written(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "x;y")], "k int, t string")
    path = scratch_path(spark, "empty")
    export_csv(df, path, sep=";")
    assert sorted(tuple(r) for r in read_result(spark, path, df.schema, sep=";").collect()) == [(1, ""), (2, None), (3, "x;y")]
