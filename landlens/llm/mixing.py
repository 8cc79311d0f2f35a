"""Mixing sources to target weights (operator 11): systematic sampling, DataFrame operations only.

1. Targets.  A document's size is its number of words.  The sources, by code point,
   null last, share all words in proportion to their weights; a target stops at
   ``cap`` times its source's size and the excess is shared again by weight.  The
   level L with sum(min(cap * size, weight * L)) = all words is found by Newton's
   method on that concave, piecewise linear sum: exact integers, a few aggregates
   of the table of sources, each capping more sources than the one before.
2. Sampling.  Every document of a source is expected target / source_size times.
   The documents of a source are ordered by size (then id), their expected copies
   are prefix-summed, one offset in [0, 1) drawn from a hash of seed and source is
   added, and a document is emitted once for every integer that its stretch of the
   sum crosses.  Neighbours in the order have nearly the same size, so the words
   taken differ from the target by less than the source's largest document.

The prefix sum is ``numbering``'s row number times a rational rate, in 38-digit
decimals: exact, alike in every run and after a lost executor, and no source is in
one task.

Defined results: a null text has size 0 and is taken as 0 words, whatever its copies;
documents without a source are one source, the last; a source without words has
target 0; copies are between the floor and the ceiling of target / source_size, so
never more than ``cap``; repeated rows are documents of their own; an empty table
gives no rows.  Very long texts count whole.  ``rest`` keeps other columns apart,
so their names clash with none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landlens.session import scratch_path

from .blocks import rest_of_row
from .numbering import runs, same, write_ordered

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = 11
#: Offsets are multiples of 2^-32.
_UNIT = 1 << 32
_WHOLE = "decimal(38,0)"
_WHITE = r"[\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of runs of characters other than white space; null: 0."""
    words = F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), _WHITE), "")
    return F.size(words).cast("bigint")


def targets(sources: DataFrame, path: str, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, source_size, target and the rate of copies as rate_over / rate_under, of every row (source, source_size).

    The k-th source (by code point, null last) weighs ``weights[k % len(weights)]``.
    """
    spark = sources.sparkSession
    listed = write_ordered(sources, [], ["source"], f"{path}/listed")
    place = (F.col("s.at") + F.col("r.shift") - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place + 1).cast("int")).cast(_WHOLE)
    weighed = listed.alias("s").join(runs(listed, []).alias("r"), same("s", "r", ["part"]))
    weighed.select("s.source", F.col("s.source_size").cast(_WHOLE).alias("size"), weight.alias("weight")).write.parquet(f"{path}/weighed")
    table = spark.read.parquet(f"{path}/weighed")

    def capped(free: int, share: int) -> Column:
        return F.col("weight") * F.lit(free).cast(_WHOLE) >= cap * F.col("size") * F.lit(share).cast(_WHOLE)

    first = table.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    everything, free, share = int(first.size or 0), int(first.size or 0), int(first.weight or 0)
    while everything and share:  # a step caps at least one more source or is the last
        at_cap = capped(free, share)
        got = table.agg(F.sum(F.when(at_cap, cap * F.col("size"))).alias("held"), F.sum(F.when(~at_cap, F.col("weight"))).alias("weight")).first()
        step = everything - int(got.held or 0), int(got.weight or 0)
        if step == (free, share):
            break
        free, share = step
    at_cap = capped(free, share)
    over = F.when(at_cap, F.lit(cap).cast(_WHOLE)).otherwise(F.col("weight") * F.lit(free).cast(_WHOLE))
    under = F.when(at_cap, F.lit(1).cast(_WHOLE)).otherwise(F.col("size") * F.lit(share).cast(_WHOLE))
    target = F.when(at_cap, (cap * F.col("size")).cast("double")).otherwise((F.col("weight") * F.lit(free).cast(_WHOLE)).cast("double") / F.lit(float(share or 1)))
    return table.select("source", F.col("size").cast("bigint").alias("source_size"), target.alias("target"), over.alias("rate_over"), under.alias("rate_under"))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS,
         cap: int = CAP, seed: int = SEED, rest: bool = False) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every row; with ``rest`` also text and rest (a struct of the other columns)."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "mixing")
    text = F.col(f"`{text_col}`")
    columns = [F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), n_words(text).alias("size"),
               F.xxhash64(text.cast("string")).alias("tie"), F.monotonically_increasing_id().alias("salt")]
    if rest:
        columns += [text.alias("text"), rest_of_row(docs, id_col, text_col, source_col).alias("rest")]
    docs.select(*columns).write.parquet(f"{path}/measured")  # texts are counted once; the range bounds are sampled from this
    measured = spark.read.parquet(f"{path}/measured")
    ordered = write_ordered(measured, ["source"], ["size", "doc_id", "tie", "salt"], f"{path}/ordered")

    sources = targets(measured.groupBy("source").agg(F.sum("size").alias("source_size")), f"{path}/sources", weights, cap)
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("r.source")))
    offset = F.conv(F.substring(digest, 1, 8), 16, 10).cast(_WHOLE)
    known = (runs(ordered, ["source"]).alias("r").join(sources.alias("t"), same("r", "t", ["source"]))
             .select("r.part", "r.source", "r.shift", "t.source_size", "t.target", "t.rate_over", "t.rate_under", offset.alias("offset")))
    out = ordered.alias("o").join(known.alias("k"), same("o", "k", ["part", "source"]))
    out = out.select("o.*", "k.shift", "k.source_size", "k.target", "k.rate_over", "k.rate_under", "k.offset")

    def crossed(number: str) -> str:
        """Integers up to the offset expected copies of the first ``number`` documents."""
        unit = f"CAST({_UNIT} AS {_WHOLE})"
        return f"((CAST({number} AS {_WHOLE}) * rate_over * {unit} + offset * rate_under) div (rate_under * {unit}))"

    out = out.withColumn("copies", F.expr(f"{crossed('at + shift')} - {crossed('at + shift - 1')}").cast("bigint"))
    keep = ["text", "rest"] if rest else []
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *keep)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS,
        cap: int = CAP, seed: int = SEED) -> DataFrame:
    """The mixture itself: the rows of ``docs``, each as often as it is taken."""
    p = plan(docs, id_col, text_col, source_col, weights, cap, seed, rest=True).where("copies > 0")
    p = p.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    own = {id_col: "doc_id", text_col: "text", source_col: "source"}
    return p.select(*[F.col(own.get(c, f"rest.`{c}`")).alias(c) for c in docs.columns])
