"""Question and answer between blocks of documents and shards of keys.

Several operators need, for every document, a fact about keys (windows, words,
n-grams) that other documents may hold too.  Shuffling one row a key would
multiply the input.  Here the documents are dealt to blocks of a few MB by a hash
of their id; each block asks each shard once, in one packed row, about its
*distinct* keys (so a key that a third of the rows hold costs one entry a block),
each shard answers each block in one packed row, and the block's documents meet the
answers.  The exchange of the documents serves both the asking and the finishing.

Recovery: everything is a Spark plan; a lost block or shard is computed again from
its inputs.  Blocks sort their documents before use, so both computations agree.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landlens.session import ship_package

from .words import release

#: Blocks for each shuffle partition: a block holds a quarter of a partition's documents.
BLOCKS_A_PARTITION = 4


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def rest_of_row(docs: DataFrame, *without: str) -> Column:
    """All other columns of a row as one struct, to be unpacked at the end."""
    names = [c for c in docs.columns if c not in without]
    return F.struct(*[F.col(f"`{c}`") for c in names] or [F.lit(None).cast("boolean").alias("none")])


def in_blocks(docs: DataFrame, id_col: str, text_col: str, keep_rest: bool = False) -> DataFrame:
    """Columns block, id, text (null: empty) and, with ``keep_rest``, rest (a struct of the other columns)."""
    ship_package(docs.sparkSession)
    n = partitions(docs.sparkSession) * BLOCKS_A_PARTITION
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), text)
    out = [F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias("block"), F.col(f"`{id_col}`").alias("id"), text.alias("text")]
    if keep_rest:
        out.append(rest_of_row(docs, id_col, text_col).alias("rest"))
    return docs.select(*out)


def ordered(table: pa.Table) -> pa.Table:
    """A block's documents in an order that does not depend on how they arrived."""
    return table.sort_by([("id", "ascending"), ("text", "ascending")])


def exchange(blocks: DataFrame, ask: Callable, answer: Callable, finish: Callable, schema: str) -> DataFrame:
    """``ask(table) -> [(shard, bytes)]``, ``answer([(block, bytes)]) -> [(block, bytes)]``,
    ``finish(table, {shard: bytes}) -> table`` with ``schema``; tables are a block's documents, ordered."""

    def asks(table: pa.Table) -> pa.Table:
        release()
        block = table["block"][0]
        rows = ask(ordered(table))
        return pa.table({"shard": pa.array([s for s, _ in rows], pa.int32()), "block": pa.array([block.as_py()] * len(rows), pa.int32()),
                         "data": pa.array([d for _, d in rows], pa.binary())})

    def answers(table: pa.Table) -> pa.Table:
        release()
        shard = table["shard"][0].as_py()
        got = answer(list(zip(table["block"].to_pylist(), table["data"].to_pylist())))
        return pa.table({"block": pa.array([b for b, _ in got], pa.int32()), "shard": pa.array([shard] * len(got), pa.int32()),
                         "data": pa.array([d for _, d in got], pa.binary())})

    def finishes(documents: pa.Table, replies: pa.Table) -> pa.Table:
        release()
        return finish(ordered(documents), dict(zip(replies["shard"].to_pylist(), replies["data"].to_pylist())))

    replies = (blocks.groupBy("block").applyInArrow(asks, "shard int, block int, data binary")
               .groupBy("shard").applyInArrow(answers, "block int, shard int, data binary"))
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(finishes, schema)
