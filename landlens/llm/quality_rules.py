"""Quality rules with host verdicts (operator 10), DataFrame operations only.

Each document is measured and judged by two rules (too few words; too large a share
of words in repeated three-word windows).  Rule failures are summed by host; a
host's failure rate is shrunk by an empirical beta prior, fitted by moments to the
rates of all hosts, and a host whose shrunken rate exceeds ``HOST_LIMIT`` is
rejected with all its documents.  The verdict is joined back to the documents.

Prior: with n hosts of weight 1, rates p, sizes m, mean a = avg(p) and variance v
beyond chance, v = var(p) - avg(a (1 - a) / m), the prior's strength is
s = a (1 - a) / v - 1 (at least ``LEAST_STRENGTH``; ``MOST_STRENGTH`` if the rates vary by no more than
chance), the shrunken rate (failures + a s) / (m + s).

Defined results: a null text has no words and fails; documents without a host form
one host of their own; repeated rows count as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landlens.session import scratch_path

LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
HOST_LIMIT = 0.5
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 10_000.0

_WHITE = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]"


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed of every row; no shuffle."""
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{host_col}`").cast("string").alias("host"),
                    F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = d.select("doc_id", "host", F.array_remove(F.split("text", _WHITE), "").alias("w"), F.regexp_count("text", F.lit(_SYMBOLS)).alias("n_symbols"), lines.alias("l"))
    d = d.select("doc_id", "host", F.size("w").alias("n_words"), F.length(F.array_join("w", "")).alias("word_chars"), "n_symbols",
                 (F.size("l") - F.size(F.array_distinct("l"))).alias("n_dup_lines"), F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    # three-word windows by hash and place, sorted: equal windows are neighbours
    window = F.transform(F.slice("h", F.lit(1), F.greatest(F.size("h") - 2, F.lit(0))),
                         lambda x, i: F.struct(F.xxhash64(x, F.get("h", i + 1), F.get("h", i + 2)).alias("k"), i.alias("i")))
    d = d.withColumn("s", F.sort_array(window)).drop("h")
    d = d.withColumn("r", F.filter("s", lambda x, i: x.k.eqNullSafe(F.get("s", i - 1).k) | x.k.eqNullSafe(F.get("s", i + 1).k))).drop("s")
    covered = F.array_distinct(F.flatten(F.transform("r", lambda x: F.array(x.i, x.i + 1, x.i + 2))))
    d = d.withColumn("n_repeat_words", F.size(covered)).drop("r")
    number = {c: F.col(c).cast("bigint") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    return d.withColumns(number).withColumn("base_failed", failed())


def failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def host_verdicts(measured: DataFrame) -> DataFrame:
    """host, documents, failures, rate (shrunken), rejected of every host."""
    hosts = measured.groupBy("host").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("base_failed").cast("bigint")).alias("failures"))
    hosts = hosts.withColumn("raw", F.col("failures") / F.col("documents"))
    fit = hosts.agg(F.avg("raw").alias("a"), F.var_pop("raw").alias("v"), F.avg(1 / F.col("documents")).alias("inverse")).first()  # one row, three numbers
    a = fit.a or 0.0
    beyond = (fit.v or 0.0) - a * (1 - a) * (fit.inverse or 0.0)
    strength = min(max(a * (1 - a) / beyond - 1, LEAST_STRENGTH), MOST_STRENGTH) if beyond > 0 else MOST_STRENGTH
    hosts = hosts.withColumn("rate", (F.col("failures") + F.lit(a * strength)) / (F.col("documents") + F.lit(strength)))
    return hosts.select("host", "documents", "failures", "rate", (F.col("rate") > HOST_LIMIT).alias("rejected"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The measures, the host's shrunken rate (host_rate) and kept of every row."""
    spark = docs.sparkSession
    path = scratch_path(spark, "quality")
    measures(docs, id_col, text_col, host_col).write.parquet(path)  # texts are measured once
    measured = spark.read.parquet(path)
    hosts = host_verdicts(measured).select(F.col("host").alias("of"), F.col("rate").alias("host_rate"), "rejected")
    out = measured.join(hosts, F.col("host").eqNullSafe(F.col("of")))
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("rejected")).drop("of", "rejected")
