"""Corpus pipeline: language ID, near-duplicate removal, substring dedup, benchmark decontamination, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, written as Parquet below ``spark.checkpoint.dir`` and read
again as the next one's ``docs``.  All but the last return the columns of
``documents`` for the rows that stay, with the text as the stage left it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landlens.llm import decontaminate, lang_id, near_dup, sentencepiece_bpe, substring_dedup
from landlens.llm.queries import PIECE_BPE, tokenizer_path
from landlens.session import clear_scratch, discard, scratch_mark, scratch_path


#: Bits by which a text must exceed the entropy bound in all, so that short texts, whose rate is rough, are not judged by a few characters.
EVIDENCE_BITS = 200
#: Words of a shingle of the near-duplicate stage.
SHINGLE = 5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the labelled rows.

    What goes: texts without a letter (null and empty ones too), and texts whose
    entropy under every language is so far above what the languages' own held-out
    text has that ``EVIDENCE_BITS`` are exceeded.  Where no language could be learned,
    only texts without a letter go.  Repeated rows are judged alike; an empty table
    gives an empty one.
    """
    samples = lang_id.learn_samples(docs, "doc_id", "text", "lang", 5)
    bound = lang_id.entropy_bound(samples)
    if not samples:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    out = lang_id.identify(docs, samples=samples, rest=True).where(F.col("lang_pred") != lang_id.UNKNOWN)
    if bound is not None:
        out = out.where((F.col("bits") - bound) * F.length("text") <= EVIDENCE_BITS)
    return out.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"rest.`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (``SHINGLE``-word shingles, similarity 0.8): the one with the smallest id.

    Of repeated rows (equal id and text) one stays; rows of one id with different
    texts are documents of their own.  Documents without words are in no group and
    all stay.  An empty table gives an empty one.
    """
    path = scratch_path(spark, "near-dup-kept")
    near_dup.group(docs, size=SHINGLE).where("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    kept, rows = spark.read.parquet(path), docs.alias("docs")

    def of(ids: DataFrame) -> DataFrame:
        return rows.join(ids.select("doc_id").alias("kept"), F.col("docs.doc_id").eqNullSafe(F.col("kept.doc_id")), "left_semi")

    often = kept.where("n > 1")
    if often.isEmpty():
        return of(kept)
    again, worded = of(often), F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return of(kept.where("n = 1")).unionByName(again.where(~worded)).unionByName(again.where(worded).dropDuplicates(["doc_id", "text"]))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the words of repeated windows; a document of which nothing stays goes."""
    out = substring_dedup.remove_repeats(docs, spacing=True, rest=True).where("n_removed < n_words or n_words = 0")
    new = {"doc_id": F.col("id"), "text": F.col("kept"), "n_chars": F.length("kept").cast("bigint")}
    return out.select(*[new.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaks = found.where("contaminated").select("row").distinct().alias("leaks")
    key = decontaminate.row_key("docs.doc_id", "docs.text")
    return docs.alias("docs").join(leaks, key == F.col("leaks.row"), "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text."""
    return sentencepiece_bpe.encode_decode(docs, tokenizer_path(PIECE_BPE), digests=True)


STAGES = [
    ("language_id", language),
    ("near_dup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark_free),
    ("sentencepiece", tokens),
]

#: SQL can't express language ID, minhash and the tokenizer; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        mark = scratch_mark()
        stage(spark, docs, sf_dir).write.parquet(path)
        clear_scratch(spark, since=mark)  # what the stage's operator wrote for itself
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
