"""Loads that can be repeated, audited before they are seen."""

import pytest
from pyspark.sql import functions as F

from landlens.operators import clean
from landlens.session import scratch_path
from landlens.sources import AuditFailed, publish, publish_view, published, vacuum
from landlens.sources.publish import runs, versions


def rows(spark, *values):
    return spark.createDataFrame([(v, f"t{v}") for v in values], "k int, t string")


def audit(df):
    return clean.audit(df, ["k"], ["k"])


def got(df):
    return sorted((r.run_id, r.k) for r in df.collect())


@pytest.fixture
def place(spark):
    return scratch_path(spark, "published")


def test_the_same_load_twice_is_one_run(spark, place):
    assert publish(rows(spark, 1, 2), place, "jan", audit) == 1
    assert publish(rows(spark, 3), place, "feb", audit) == 2
    want = [("feb", 3), ("jan", 1), ("jan", 2)]
    assert got(published(spark, place)) == want
    assert publish(rows(spark, 3), place, "feb", audit) == 3
    assert got(published(spark, place)) == want and got(published(spark, place, 1)) == want[1:]
    publish(rows(spark, 4), place, "feb")
    assert got(published(spark, place)) == [("feb", 4), *want[1:]]


def test_a_load_whose_audit_fails_is_not_seen(spark, place):
    publish(rows(spark, 1), place, "jan", audit)
    publish_view(spark, "loaded", place)
    with pytest.raises(AuditFailed, match="duplicate_key_rows k: 2") as failed:
        publish(rows(spark, 5, 5, None), place, "feb", audit)
    assert ("not_null", "k", 1) in failed.value.found
    with pytest.raises(AuditFailed):
        publish(rows(spark, None), place, "jan", audit, mode="overwrite")
    assert got(published(spark, place)) == [("jan", 1)] == got(spark.table("loaded")) and versions(spark, place) == [1]
    publish(rows(spark, 5, 5), place, "feb", audit, tolerated=("row_count", "duplicate_key_groups", "duplicate_key_rows"))
    assert got(published(spark, place)) == [("feb", 5), ("feb", 5), ("jan", 1)]
    spark.catalog.dropTempView("loaded")


def test_readers_keep_their_version_while_the_table_is_replaced(spark, place):
    publish(rows(spark, 1, 2), place, "jan")
    publish_view(spark, "loaded", place)
    reader = published(spark, place)
    publish(rows(spark, 9), place, "jan", mode="overwrite")
    assert got(reader) == [("jan", 1), ("jan", 2)] == got(spark.table("loaded"))
    publish_view(spark, "loaded", place)
    assert got(spark.table("loaded")) == [("jan", 9)]
    spark.catalog.dropTempView("loaded")


def test_a_list_without_its_success_mark_is_no_version(spark, place):
    publish(rows(spark, 1), place, "jan")
    publish(rows(spark, 2), place, "feb")
    from landlens.session import discard

    discard(spark, f"{place}/_published/version=2/_SUCCESS")  # as if the writer had died
    assert versions(spark, place) == [1] and got(published(spark, place)) == [("jan", 1)]
    assert publish(rows(spark, 3), place, "mar") == 2 and got(published(spark, place)) == [("jan", 1), ("mar", 3)]


def test_vacuum_removes_what_no_recent_version_lists(spark, place):
    for k in range(4):
        publish(rows(spark, k), place, "jan")
    publish(rows(spark, 7), place, "feb")
    assert vacuum(spark, place) == 3 + 3  # three lists, three attempts
    assert got(published(spark, place)) == [("feb", 7), ("jan", 3)] and got(published(spark, place, 4)) == [("jan", 3)]
    assert vacuum(spark, place) == 0


def test_runs_with_other_columns_and_no_runs(spark, place):
    with pytest.raises(FileNotFoundError):
        published(spark, place)
    empty = published(spark, place, schema=rows(spark).schema)
    assert empty.columns == ["k", "t", "run_id"] and empty.collect() == []
    publish(rows(spark, 1), place, "2016")
    publish(rows(spark, 2).withColumn("more", F.lit(True)), place, "01")
    assert [(r.run_id, r.k, r.more) for r in published(spark, place).orderBy("k").collect()] == [("2016", 1, None), ("01", 2, True)]
    assert set(runs(spark, place)) == {"2016", "01"}
    for bad in ("a/b", "", "a b"):
        with pytest.raises(ValueError):
            publish(rows(spark, 1), place, bad)
    with pytest.raises(ValueError):
        publish(rows(spark, 1), place, "x", mode="merge")
