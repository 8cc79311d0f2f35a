"""Benchmark decontamination (operator 8): distributed positional inverted index, DataFrame operations only.

1. Index.  One pass over the documents writes the postings (term, row, position) of
   every term that the benchmark uses to the shared folder, and a row a document
   with its number of words.
2. Rarest terms.  The postings give each term's frequency in the corpus; every
   window of the benchmark is looked up by its two rarest terms.
3. Intersection.  The rarest term's postings, shifted by the term's offset in the
   window, are intersected with those of the second rarest.
4. Confirmation.  What is left is compared word by word in the document (phrase
   match).  ``within`` words of slack are allowed by ``proximity``.

Terms are compared by 64-bit hashes until step 4, which is exact.  What is
broadcast is a set of term hashes of at most ``VOCABULARY_BLOCK`` rows of 8 bytes; a
larger benchmark is taken in several blocks, a pass each.

Defined results: null texts have no words; an item without words occurs nowhere; an
item without id hits words but is not counted; equal rows get equal results; a
document's identity is the hash of its id and text, so repeated ids do no harm.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landlens.session import scratch_path

LENGTH = 10
#: Hashes of benchmark terms that are broadcast at once, 8 bytes each.
VOCABULARY_BLOCK = 200_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Everything in ASCII that is not a letter or digit ends a word.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_MARK = ""  # stands for "this document" in the index; no term is empty


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased (other letters as they are); null: none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.array_remove(F.split(low, _SEPARATORS), "")


def row_key(id_col: str, text_col: str) -> Column:
    """Identity of a row: hash of its id and text, each with whether it is null (a null adds nothing to the hash)."""
    ident, text = F.col(id_col).cast("string"), F.col(text_col).cast("string")
    return F.xxhash64(ident.isNull(), ident, text.isNull(), text)


def windows(items: DataFrame, item_col: str, text_col: str, length: int) -> DataFrame:
    """item, key (the window's words joined by a space), size, wid (hash of key) of every window, repeated ones too."""
    w = items.select(F.col(f"`{item_col}`").cast("string").alias("item"), words(F.col(f"`{text_col}`")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - length + 1, F.lit(1)))
    w = w.select("item", "w", F.explode(starts).alias("s")).select("item", F.slice("w", F.col("s"), F.lit(length)).alias("p"))
    return w.select("item", F.array_join("p", " ").alias("key"), F.size("p").alias("size")).withColumn("wid", F.xxhash64("key"))


def _semi(frame: DataFrame, terms: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``frame`` whose ``h`` is in ``terms``, by broadcasts of bounded size."""
    parts = [frame.join(F.broadcast(terms.where(F.pmod("h", F.lit(blocks)) == b) if blocks > 1 else terms), "h", "left_semi") for b in range(blocks)]
    return reduce(DataFrame.unionAll, parts)


def build_index(docs: DataFrame, terms: DataFrame, id_col: str, text_col: str, path: str, blocks: int = 1) -> DataFrame:
    """Writes and returns the postings h, row, pos (from 1) of the ``terms`` (column h); pos 0 is the document itself, with n words."""
    w = docs.select(row_key(id_col, text_col).alias("row"), F.col(f"`{id_col}`").alias("id"), words(F.col(f"`{text_col}`")).alias("w"))
    w = w.select("row", "id", F.size("w").alias("n"), F.posexplode(F.concat(F.array(F.lit(_MARK)), "w")).alias("pos", "word"))
    mark = F.col("pos") == 0
    rows = w.select("row", "pos", F.xxhash64("word").alias("h"), F.when(mark, F.col("id")).alias("id"), F.when(mark, F.col("n")).alias("n"))
    _semi(rows, terms, blocks).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", length: int = LENGTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: row, id, n; occurrences: row, start (from 1), size, wid; windows: item, key, size, wid)."""
    spark = docs.sparkSession
    base = scratch_path(spark, "decontaminate")
    windows(items, item_col, item_text_col, length).write.parquet(f"{base}/windows")
    win = spark.read.parquet(f"{base}/windows")
    distinct = win.select("wid", "key", "size").distinct()
    term = distinct.select("wid", "key", "size", F.posexplode(F.split("key", " ")).alias("off", "t")).withColumn("h", F.xxhash64("t"))
    vocabulary = term.select("h").distinct()
    blocks = max(1, -(-vocabulary.count() // VOCABULARY_BLOCK))
    index = build_index(docs, vocabulary.unionAll(spark.range(1).select(F.xxhash64(F.lit(_MARK)).alias("h"))), id_col, text_col, f"{base}/index", blocks)
    postings = index.where(F.col("pos") > 0).select("h", "row", "pos")

    frequency = postings.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    probes = (term.join(frequency, "h").groupBy("wid", "key", "size")
              .agg(F.sort_array(F.collect_list(F.struct("n", "off", "h"))).alias("p"))  # at most ``length`` entries
              .where(F.size("p") == F.col("size"))  # a term without postings: the window occurs nowhere
              .select("wid", "key", "size", F.col("p")[0].off.alias("off1"), F.col("p")[0].h.alias("h1"),
                      F.get("p", F.lit(1)).off.alias("off2"), F.get("p", F.lit(1)).h.alias("h2")))
    probes.write.parquet(f"{base}/probes")
    probes = spark.read.parquet(f"{base}/probes")

    rarest = _semi(postings, probes.select(F.col("h1").alias("h")).distinct(), blocks)
    first = (rarest.join(probes, F.col("h") == F.col("h1"))
             .select("wid", "key", "size", "row", (F.col("pos") - F.col("off1")).alias("start"), "h2", "off2").where(F.col("start") > 0).distinct())
    first.write.parquet(f"{base}/first")
    first = spark.read.parquet(f"{base}/first")
    second = _semi(postings, probes.where(F.col("h2").isNotNull()).select(F.col("h2").alias("h")).distinct(), blocks)
    both = (first.where(F.col("h2").isNotNull()).withColumns({"h": F.col("h2"), "pos": F.col("start") + F.col("off2")})
            .join(second.distinct(), ["h", "row", "pos"], "left_semi"))
    found = both.select("wid", "key", "size", "row", "start").unionByName(first.where(F.col("h2").isNull()).select("wid", "key", "size", "row", "start"))

    candidates = found.groupBy("row").agg(F.collect_list(F.struct("start", "size", "wid", "key")).alias("c"))
    text = docs.select(row_key(id_col, text_col).alias("row"), F.col(f"`{text_col}`").alias("text"))
    checked = text.join(candidates, "row").select("row", "c", words(F.col("text")).alias("w"))
    checked = checked.select("row", F.filter("c", lambda c: F.array_join(F.slice("w", c.start, c.size), " ") == c.key).alias("c"))
    checked.where(F.size("c") > 0).dropDuplicates(["row"]).write.parquet(f"{base}/checked")
    occurrences = spark.read.parquet(f"{base}/checked").select("row", F.explode("c").alias("c")).select("row", "c.start", "c.size", "c.wid")
    return index.where(F.col("pos") == 0).select("row", "id", "n"), occurrences, win


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted ids as strings), contaminated and row (``row_key``) of every document."""
    documents, occurrences, win = matches(docs, items, id_col, text_col, item_col, item_text_col, length)
    hit = (occurrences.groupBy("row").agg(F.collect_list(F.struct("start", "size")).alias("c"))
           .select("row", F.size(F.array_distinct(F.flatten(F.transform("c", lambda c: F.sequence(c.start, c.start + c.size - 1))))).alias("n_hit")))
    named = (occurrences.select("row", "wid").distinct().join(win.select("wid", "item").where(F.col("item").isNotNull()).distinct(), "wid")
             .groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items")))
    found = hit.join(named, "row", "left")
    none = F.array().cast("array<string>")
    return (documents.join(found, "row", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").cast("bigint").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                    F.coalesce("items", none).alias("items"), "row")
            .select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"), "row"))


def proximity(docs: DataFrame, items: DataFrame, within: int, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
              item_text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, item, wid, start of windows whose words occur in a document in their order, neighbours at most ``within`` + 1 places apart.

    The occurrence that starts earliest is returned for each document and window.
    """
    spark = docs.sparkSession
    base = scratch_path(spark, "proximity")
    win = windows(items, item_col, item_text_col, length)
    term = win.select("wid", "key", "size").distinct().select("wid", "size", F.posexplode(F.split("key", " ")).alias("off", "t")).withColumn("h", F.xxhash64("t"))
    vocabulary = term.select("h").distinct()
    blocks = max(1, -(-vocabulary.count() // VOCABULARY_BLOCK))
    index = build_index(docs, vocabulary.unionAll(spark.range(1).select(F.xxhash64(F.lit(_MARK)).alias("h"))), id_col, text_col, f"{base}/index", blocks)
    postings = index.where(F.col("pos") > 0).select("h", "row", "pos").distinct()
    at = term.where(F.col("off") == 0).join(postings, "h").select("wid", "size", "row", F.col("pos").alias("start"), F.col("pos").alias("last"))
    for k in range(1, length):  # chains grow by one word; of the chains with one start and end one is kept
        step = term.where(F.col("off") == k).select("wid", "h").join(postings, "h").select("wid", "row", "pos")
        longer = (at.where(F.col("size") > k).join(step, ["wid", "row"]).where((F.col("pos") > F.col("last")) & (F.col("pos") <= F.col("last") + within + 1))
                  .groupBy("wid", "size", "row", "start").agg(F.collect_set("pos").alias("l")).select("wid", "size", "row", "start", F.explode("l").alias("last")))
        at = at.where(F.col("size") <= k).unionByName(longer)
    first = at.groupBy("wid", "row").agg(F.min("start").alias("start"))
    documents = index.where(F.col("pos") == 0).select("row", F.col("id").alias("doc_id"))
    return first.join(win.select("wid", "item").distinct(), "wid").join(documents, "row").select("doc_id", "item", "wid", "start")
