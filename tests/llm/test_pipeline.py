"""Registered queries against their SQL, and the pipeline's stages against brute force."""

import corpus_pipeline
import pytest

from landlens.llm import queries
from tests.llm import test_corpus, test_pages_and_rules
from tests.llm.helpers import bag, hard_docs


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, smoke_dir, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{smoke_dir}/{t}.parquet')")
    out = queries.QUERIES[name](spark, smoke_dir)
    got = con.execute(queries.ORACLE[name])
    at = [[d[0] for d in got.description].index(c) for c in out.columns]
    assert bag(tuple(r) for r in out.collect()) == bag(tuple(r[i] for i in at) for r in got.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_other_queries_return_every_row(spark, smoke_dir, name):
    out = queries.QUERIES[name](spark, smoke_dir)
    table, each = ("pages", 1) if "page_id" in out.columns else ("embeddings", 32) if "vec_id" in out.columns else ("documents", 1)
    assert out.count() == each * spark.read.parquet(f"{smoke_dir}/{table}.parquet").count()


def test_stage_order_and_schema(spark, smoke_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dup", "substring_dedup", "decontamination", "sentencepiece"]
    out = corpus_pipeline.run(spark, smoke_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < out.count() < spark.read.parquet(f"{smoke_dir}/documents.parquet").count()


def test_stages_on_hard_rows(spark, smoke_dir):
    docs, rows = hard_docs(spark)
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["language_id"](spark, docs, smoke_dir)
    assert kept.columns == docs.columns
    noise = "w" * 5000  # far from every language
    assert bag((r.doc_id, r.text) for r in kept.collect()) == bag((i, t) for i, t in rows if any(c.isalpha() for c in t or "") and t != noise)

    near = stage["near_dup"](spark, docs, smoke_dir)
    assert near.columns == docs.columns
    ids = {g[0] for g in test_corpus.brute_groups(rows, 5) if g[3]}
    worded = {(i, t) for i, t in rows if i in ids and test_corpus.spaced(t)}  # repeated rows once
    assert bag((r.doc_id, r.text) for r in near.collect()) == bag([*worded, *((i, t) for i, t in rows if i in ids and not test_corpus.spaced(t))])

    whole = stage["substring_dedup"](spark, docs, smoke_dir)
    assert whole.columns == docs.columns
    want = {}
    for i, n, gone, _ in test_corpus.brute_repeats(rows, 35):
        if gone < n or not n:
            want[i] = n - gone
    for r in whole.collect():
        assert r.n_chars == len(r.text)
        if r.doc_id is not None:
            assert len(test_corpus.spaced(r.text)) == want[r.doc_id]

    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{smoke_dir}/benchmark.parquet").collect()]
    leak = docs.limit(1).selectExpr("9999L AS doc_id", f"'x {bench[0][1].replace(chr(39), ' ')} y' AS text", *docs.columns[2:])
    both = docs.unionByName(leak)
    clean = stage["decontamination"](spark, both, smoke_dir)
    assert clean.columns == docs.columns
    judged = test_pages_and_rules.brute_contamination(rows, bench, 10)
    assert bag((r.doc_id, r.text) for r in clean.collect()) == bag((i, t) for (i, t), j in zip(rows, judged) if not j[5])

    assert stage["sentencepiece"](spark, docs, smoke_dir).count() == len(rows)


def test_language_stage_without_labels_keeps_what_has_letters(spark, smoke_dir):
    docs, rows = hard_docs(spark)
    from pyspark.sql import functions as F

    kept = corpus_pipeline.language(spark, docs.withColumn("lang", F.lit(None).cast("string")), smoke_dir)
    assert kept.columns == docs.columns
    assert bag((r.doc_id, r.text) for r in kept.collect()) == bag((i, t) for i, t in rows if any(c.isalpha() for c in t or ""))


def test_language_stage_drops_what_is_in_no_language(spark, smoke_dir):
    import random

    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet")
    rng = random.Random(2)
    noise = [(10**6 + k, "".join(rng.choice("qxzjkvwyðþłčšžабвгд") for _ in range(600)), None, "s0", 600) for k in range(5)]
    kept = corpus_pipeline.language(spark, docs.unionAll(spark.createDataFrame(noise, docs.schema)), smoke_dir).collect()
    with_letters = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert {r.doc_id for r in kept} == with_letters


def test_stages_give_empty_tables_for_empty_ones(spark, smoke_dir):
    docs = spark.read.parquet(f"{smoke_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, smoke_dir).collect() == [], name


def test_near_duplicate_stage_keeps_one_of_repeated_rows(spark, smoke_dir):
    text = "one two three four five six seven eight"
    rows = [(1, text), (1, text), (1, text), (2, text), (3, "other words altogether in this one here"), (3, "and the same id again with another text"), (4, ""), (4, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = bag(map(tuple, corpus_pipeline.near_duplicates(spark, docs, smoke_dir).collect()))
    assert got == bag([rows[0], *rows[4:]])
