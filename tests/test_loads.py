"""Outcomes and audits out of the pass that writes."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from landlens.operators import clean
from landlens.plans import bindings as B
from landlens.plans import jobs, loads
from landlens.session import scratch_path


@pytest.fixture(scope="module")
def raws(spark, smoke_dir):
    malformed = F.when(F.rand(5) < 0.02, F.lit("a;b")).alias(jobs.MALFORMED)
    permits = B.raw_building_permits(spark, smoke_dir)
    path = scratch_path(spark, "raw-permits")
    permits.unionAll(permits.where("PropertyUse = 'R'")).select("*", malformed).write.parquet(path)
    return {"property_tax": B.raw_property_tax(spark, smoke_dir), "business_licenses": B.raw_business_licenses(spark, smoke_dir),
            "building_permits": spark.read.parquet(path), "building_permits_columnar": B.raw_building_permits_columnar(spark, smoke_dir)}


JOBS = {"property_tax": jobs.clean_property_tax, "business_licenses": jobs.clean_business_licenses,
        "building_permits": lambda df: jobs.permits_view_table(jobs.clean_building_permits(df)),
        "building_permits_columnar": lambda df: jobs.permits_view_table(jobs.clean_building_permits_columnar(df))}


def bag(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("name", JOBS)
def test_a_load_writes_what_the_job_gives(spark, raws, name):
    raw, load = raws[name], loads.LOADS[name]
    done = loads.run_load(raw, load, scratch_path(spark, f"load-{name}"))
    want = JOBS[name](raw)
    assert done.clean.columns == want.columns and [t for _, t in done.clean.dtypes] == [t for _, t in want.dtypes]
    assert bag(done.clean) == bag(want)
    reasons = Counter(r.reason for r in done.rejected.collect())
    outcomes = {r.outcome: r.n_rows for r in done.outcomes.collect()}
    assert {k: n for k, n in outcomes.items() if k != "kept"} == reasons and sum(outcomes.values()) == raw.count()
    audit = {(r.check, r.subject): r.violations for r in done.audit.collect()}
    n = want.count()
    assert audit["row_count", "*"] == n and (load.dedupe or outcomes["kept"] == n)
    if load.contract.key:
        old = {(r.check, r.subject): r.violations for r in clean.audit(want, load.contract.required, load.contract.key).collect()}
        assert old == {k: audit[k] for k in old}


def test_refused_values_and_long_texts_are_counted(spark, raws):
    done = loads.run_load(raws["building_permits"], loads.LOADS["building_permits"], scratch_path(spark, "load-p"))
    audit = {(r.check, r.subject): r.violations for r in done.audit.collect()}
    assert audit["cast_failed", "ISSUE_DATE"] == done.clean.where("ISSUE_DATE IS NULL").count() > 0  # 'not a date'
    assert audit["cast_failed", "PROJECT_VALUE"] == 0 and audit["too_long", "ADDRESS"] == 0
    long = raws["building_permits"].withColumn("Address", F.repeat("Address", 20))
    again = loads.run_load(long, loads.LOADS["building_permits"], scratch_path(spark, "load-l"))
    assert {(r.check, r.subject): r.violations for r in again.audit.collect()}["too_long", "ADDRESS"] == again.clean.where("length(ADDRESS) > 255").count() > 0


@pytest.mark.parametrize("name", ["property_tax", "building_permits", "business_licenses"])
def test_the_raw_table_is_scanned_once(spark, smoke_dir, raws, name):
    path = scratch_path(spark, f"scan-{name}")
    raws[name].write.parquet(path)
    raw, group = spark.read.parquet(path), f"scan {name}"
    assert loads.staged(raw, loads.LOADS[name])._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    spark.sparkContext.setJobGroup(group, group)
    done = loads.run_load(raw, loads.LOADS[name], scratch_path(spark, f"scan-out-{name}"))
    jobs_run = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs_run) <= 2  # the write (a job for its shuffle, one for its result); nothing is counted apart
    assert done.outcomes.count() > 0


def test_no_rows(spark, raws):
    raw = raws["property_tax"].limit(0)
    done = loads.run_load(raw, loads.LOADS["property_tax"], scratch_path(spark, "load-none"))
    assert done.clean.collect() == [] == done.rejected.collect() == done.outcomes.collect()
    assert {r.violations for r in done.audit.collect()} == {0}


@pytest.mark.parametrize("n, distinct", [(0, 1), (1, 1), (500, 7), (3000, 100_000), (3000, 3000)])
def test_key_audit_is_exact(spark, n, distinct):
    rng = random.Random(n + distinct)
    rows = [(rng.choice([None, f"k{rng.randrange(distinct)}"]) if k % 50 == 0 else f"k{rng.randrange(distinct)}", rng.randrange(2)) for k in range(n)]
    df = spark.createDataFrame(rows, "a string, b int").repartition(5)
    counts = Counter(rows)
    got = {r.check: r.violations for r in loads.audit_keys(df, ["a", "b"], n).collect()}
    many = [c for c in counts.values() if c > 1]
    assert got == {"duplicate_key_groups": len(many), "duplicate_key_rows": sum(many)}


def test_the_key_sketch_leaves_most_rows_out(spark):
    n = 20_000
    df = spark.range(n).select(F.col("id").cast("string").alias("k"))
    twice = df.unionAll(df.where("CAST(k AS BIGINT) % 1000 = 0"))
    left = loads.key_suspects(twice, ["k"], n)
    assert 40 <= left.count() < n // 5 and {str(1000 * i) for i in range(20)} <= {r.k for r in left.collect()}


def test_boundaries_are_loaded_and_counted_by_reason(spark):
    ring = "[[0,0],[4,0],[4,4],[0,4],[0,0]]"
    rows = [("a", f'{{"type":"Polygon","coordinates":[{ring}]}}'), ("b", '{"type":"Polygon","coordinates":[[[0,0],[0,4],[4,4],[0,0]]]}'),
            ("c", '{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4]]]}'), ("d", '{"type":"Polygon","coordinates":[[[0,0],[4,4],[4,0],[0,4],[0,0]]]}'),
            ("e", None), ("a", f'{{"type":"Polygon","coordinates":[{ring}]}}')]
    path = scratch_path(spark, "load-b")
    out = jobs.run_cleaning(spark, target=path, boundaries=spark.createDataFrame(rows, "name string, geojson string"))
    assert sorted(r.name for r in out["boundaries"].collect()) == ["a", "a", "b"]
    assert {r.outcome: r.n_rows for r in spark.read.parquet(f"{path}/outcomes/boundaries").collect()} == {"kept": 3, "unclosed": 1, "self_intersecting": 1, "unreadable": 1}
    assert {(r.check, r.violations) for r in spark.read.parquet(f"{path}/audit/boundaries").collect()} == {
        ("row_count", 3), ("reversed_rings", 1), ("duplicate_key_groups", 1), ("duplicate_key_rows", 2)}
    assert sorted((r.name, r.reason) for r in jobs.rejected(spark, path, "boundaries").collect()) == [("c", "unclosed"), ("d", "self_intersecting"), ("e", "unreadable")]
