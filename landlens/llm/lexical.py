"""Ranked lexical search (operator 12): exact top documents by per-term geometric blocking.

1. Items.  The searching items are written with the distinct terms of each and dealt to
   groups of about ``GROUP_TERMS`` terms by a running sum, so that what a pass sends to
   the tasks (a group's vocabulary and items) is bounded; each group is one pass.
2. Forward rows.  One pass over the whole texts writes, for each document, its number
   of terms and its terms of the vocabulary with their counts.  N, L and every term's
   df are sums over these rows.
3. Index.  Documents are range-partitioned by the smallest hashes of their terms, so
   that like documents are neighbours, and cut into segments of at most ``SEGMENT``.
   In a segment each term has its own posting list, clustered by the documents'
   similarity: pivots out of the list, every document to the pivot of largest cosine
   over the terms that some item asks together with the list's.  A cluster is cut
   into blocks; a block's summary is the coordinatewise maximum of its documents'
   impacts on those terms.  A segment is one row of a table in the shared folder.
4. Search.  A block's bound for an item is the product of the item's weights and the
   block's summary: no document in the block scores more.  A block whose bound is
   below the item's ``k``-th best score so far is skipped; a document is scored only if no
   list has it in a skipped block.  Bounds and scores are whole numbers below 2^53,
   so both are exact.  Each task keeps the ``k`` best for an item over its segments and
   Spark merges those.

A long posting list is spread over the segments, so no term or document is hot.

Defined results: null and empty texts have no terms; an item without terms, or whose
terms no document holds, has no rows; repeated documents are documents of their own
and repeated items are answered each; equal scores go by ascending id, null ids last;
a term's weight is 0 if all documents hold it, and scores of 0 are left out; texts
of any length are read whole, a piece at a time.  Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landlens.session import scratch_path, ship_package

from .words import release, slices

BEST = 10
#: Terms of the items of one pass; the last item of a group may exceed it.
GROUP_TERMS = 20_000
#: Documents of a segment, at most; fewer where documents x terms or documents x items pass ``ENTRIES``.
SEGMENT, ENTRIES = 2048, 8 << 20
#: Documents of a block, on average (twice as many at most), and pivots of a list at most.
BLOCK, PIVOTS = 32, 32
#: Bytes of a text that are cut into terms at once.
PIECE = 1 << 20

_TERM, _NO_TERM = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9a-z\x80-\xff]")


def pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces that part no term."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            gap = _NO_TERM.search(text, end)
            end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, A-Z lower-cased, in lists of bounded size."""
    return map(_TERM.findall, pieces(text.lower()))


def texts(column: pa.Array) -> list[bytes]:
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


@dataclass
class Group:
    """The items of a pass: their keys and, for each, its terms as numbers of the sorted vocabulary."""

    vocabulary: list[bytes]
    keys: list[int]
    asked: list[np.ndarray]
    #: Set when the corpus is known: documents, terms, weight of each term of the vocabulary.
    n_docs: int = 0
    n_terms: int = 0
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("number", "items_of", "beside", "order")}

    @cached_property
    def number(self) -> dict[bytes, int]:
        return {t: i for i, t in enumerate(self.vocabulary)}

    @cached_property
    def items_of(self) -> list[np.ndarray]:
        """For each term the items that ask for it."""
        term, item = np.concatenate([*self.asked, np.zeros(0, int)]).astype(int), np.repeat(np.arange(len(self.asked)), [len(a) for a in self.asked])
        order = np.argsort(term, kind="stable")
        return np.split(item[order], np.cumsum(np.bincount(term, minlength=len(self.vocabulary)))[:-1])

    @cached_property
    def beside(self) -> list[np.ndarray]:
        """For each term the terms that some item asks together with it, itself included."""
        return [np.unique(np.concatenate([self.asked[i] for i in items])) for items in self.items_of]

    @cached_property
    def order(self) -> np.ndarray:
        """Three random orders of the vocabulary; documents with like terms have like smallest places."""
        rng = np.random.default_rng(12)
        return np.stack([rng.permutation(len(self.vocabulary)) for _ in range(3)])

    @property
    def segment(self) -> int:
        return max(1, min(SEGMENT, ENTRIES // max(1, len(self.vocabulary)), ENTRIES // max(1, len(self.keys))))

    def weigh(self, n_docs: int, n_terms: int, df: dict[int, int]) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(self.vocabulary))], np.int64)

    def impact(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What a term that occurs ``tf`` times adds to the score of a document of ``n`` terms, for weight 1."""
        wide = n.astype(object) if 90 * int(n.max(initial=0)) * self.n_docs >= 1 << 63 else n
        m = 10 + (90 * wide * self.n_docs) // max(1, self.n_terms)
        return ((1_000_000_000 * tf) // (1000 * tf + 8 * m)).astype(np.int64)


def deal_items(items: DataFrame, item_col: str, text_col: str, path: str) -> tuple[DataFrame, int]:
    """Writes key, item_id, terms, group of every item; returns them and the number of groups."""

    def split(batches):
        for batch in batches:
            found = [sorted(set().union(*terms(t))) for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("key"), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "key", "terms"])

    spark = items.sparkSession
    named = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.monotonically_increasing_id().alias("key"))
    schema = T.StructType([named.schema["item_id"], T.StructField("key", T.LongType()), T.StructField("terms", T.ArrayType(T.BinaryType()))])
    named.mapInArrow(split, schema).withColumn("part", F.shiftright("key", 33)).write.parquet(f"{path}/split")
    listed = spark.read.parquet(f"{path}/split")
    # running sum of the terms: inside a part, and of the parts before
    totals = listed.groupBy("part").agg(F.sum(F.size("terms")).alias("all"))
    before = totals.select("part", F.coalesce(F.sum("all").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.sum(F.size("terms")).over(Window.partitionBy("part").orderBy("key")) - F.size("terms")
    dealt = listed.withColumn("inside", inside).join(before, "part").withColumn("group", F.expr(f"CAST((before + inside) div {GROUP_TERMS} AS INT)"))
    dealt.select("key", "item_id", "terms", "group").write.parquet(f"{path}/items")
    dealt = spark.read.parquet(f"{path}/items")
    return dealt, (dealt.agg(F.max("group")).first()[0] or 0) + 1


def group_of(dealt: DataFrame, number: int) -> Group:
    rows = dealt.where((F.col("group") == number) & (F.size("terms") > 0)).select("key", "terms").orderBy("key").collect()  # GROUP_TERMS terms and an item
    vocabulary = sorted({bytes(t) for r in rows for t in r.terms})
    at = {t: i for i, t in enumerate(vocabulary)}
    return Group(vocabulary, [r.key for r in rows], [np.array([at[bytes(t)] for t in r.terms], np.int64) for r in rows])


def forward(docs: DataFrame, group: Group, path: str) -> DataFrame:
    """Writes doc_id, n, terms, counts, likeness (three hashes) and salt of every document; terms and counts are of the group's vocabulary."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.LongType())),
                           *[T.StructField(c, T.IntegerType()) for c in ("s0", "s1", "s2", "salt")]])

    def task(batches):
        known, order, row = group.number, group.order, 0
        for batch in batches:
            for part in slices(batch, "text"):
                n, ptr, found, counts, like = [], [0], [], [], []
                for text in texts(part.column("text")):
                    held, size = Counter(), 0
                    for some in terms(text):
                        size += len(some)
                        held.update(filter(known.__contains__, some))
                    mine = sorted((known[t], c) for t, c in held.items())
                    n.append(size)
                    found += [t for t, _ in mine]
                    counts += [c for _, c in mine]
                    ptr.append(len(found))
                    like.append(order[:, [t for t, _ in mine]].min(axis=1) if mine else np.zeros(3, int))
                like = np.array(like, np.int32).reshape(-1, 3)
                lists = [pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(v, kind)) for v, kind in ((found, pa.int32()), (counts, pa.int64()))]
                salt = np.arange(row, row + len(n), dtype=np.int32)
                row += len(n)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), *lists, *[pa.array(like[:, i]) for i in range(3)], pa.array(salt)], names=schema.names)

    docs.mapInArrow(task, schema).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


@dataclass
class Segment:
    """Documents of the index: impacts by document, and for each posting list its blocks and their summaries."""

    ptr: np.ndarray  # documents -> entries
    term: np.ndarray
    impact: np.ndarray
    lists: np.ndarray  # terms that have a list
    docs_ptr: np.ndarray  # list -> docs
    docs: np.ndarray  # documents of a list, block after block
    ends_ptr: np.ndarray  # list -> ends
    ends: np.ndarray  # where a block ends in its list
    sums_ptr: np.ndarray  # list -> sums
    place: np.ndarray  # block times terms asked beside the list's, plus the place of the term there
    top: np.ndarray  # the largest impact there in the block

    FIELDS = ("ptr", "term", "impact", "lists", "docs_ptr", "docs", "ends_ptr", "ends", "sums_ptr", "place", "top")

    def pack(self) -> list[bytes]:
        return [getattr(self, f).astype(np.int32).tobytes() for f in self.FIELDS]

    @classmethod
    def unpack(cls, data: list[bytes]) -> Segment:
        return cls(*[np.frombuffer(d, np.int32) for d in data])


def impacts(ptr: np.ndarray, term: np.ndarray, impact: np.ndarray, width: int) -> np.ndarray:
    """Documents x vocabulary; impacts are below 10^6, exact in these floats."""
    out = np.zeros((len(ptr) - 1, width), np.float32)
    out[np.repeat(np.arange(len(ptr) - 1), np.diff(ptr)), term] = impact
    return out


def cluster(like: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows in the order of their blocks, end of each block) of the rows of a list."""
    n = len(like)
    if n <= BLOCK:
        return np.arange(n), np.array([n])
    pivots = like[np.linspace(0, n - 1, min(-(-n // BLOCK), PIVOTS)).astype(int)]
    length = np.sqrt(np.einsum("ij,ij->i", pivots, pivots))
    nearest = np.argmax(like @ (pivots / np.maximum(length, 1)[:, None]).T, axis=1)
    order = np.argsort(nearest, kind="stable")
    size = np.bincount(nearest)
    ends = [np.append(np.arange(a + 2 * BLOCK, a + s, 2 * BLOCK), a + s) for a, s in zip(np.cumsum(size) - size, size) if s]
    return order, np.concatenate(ends)


def build_segment(group: Group, n: np.ndarray, ptr: np.ndarray, term: np.ndarray, tf: np.ndarray) -> Segment:
    impact = group.impact(tf, np.repeat(n, np.diff(ptr)))
    x = impacts(ptr, term, impact, len(group.vocabulary))
    by_term = np.argsort(term, kind="stable")
    doc = np.repeat(np.arange(len(n)), np.diff(ptr))[by_term]
    lists, first = np.unique(term[by_term], return_index=True)
    docs, ends, places, tops = [], [], [], []
    for t, members in zip(lists, np.split(doc, first[1:])):
        beside = group.beside[t]
        like = x[np.ix_(members, beside)]
        order, end = cluster(like)
        top = np.maximum.reduceat(like[order], np.append(0, end[:-1]), axis=0).ravel()
        place = np.flatnonzero(top)
        docs.append(members[order])
        ends.append(end)
        places.append(place)
        tops.append(top[place])

    def joined(parts):
        return np.append(0, np.cumsum([len(p) for p in parts])), np.concatenate([*parts, np.zeros(0, int)])

    (docs_ptr, docs), (ends_ptr, ends), (sums_ptr, place) = joined(docs), joined(ends), joined(places)
    return Segment(ptr, term, impact, lists, docs_ptr, docs, ends_ptr, ends, sums_ptr, place, np.concatenate([*tops, np.zeros(0)]))


def build_index(rows: DataFrame, group: Group, path: str) -> DataFrame:
    """Writes the segments of the forward rows (doc_ids and a segment's fields) and returns them."""
    like = [F.col(c) for c in ("s0", "s1", "s2", "salt")]
    dealt = rows.where(F.size("terms") > 0).repartitionByRange(*like).sortWithinPartitions(*like).select("doc_id", "n", "terms", "counts")
    schema = T.StructType([T.StructField("doc_ids", T.ArrayType(rows.schema["doc_id"].dataType)), *[T.StructField(f, T.BinaryType()) for f in Segment.FIELDS]])

    def written(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        ids, lists, counts = (table.column(c).combine_chunks() for c in ("doc_id", "terms", "counts"))
        ptr = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))).astype(np.int64)
        term, tf = (v.flatten().to_numpy(zero_copy_only=False) for v in (lists, counts))
        data = build_segment(group, table.column("n").to_numpy(), ptr, term, tf).pack()
        whole = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.RecordBatch.from_arrays([whole, *[pa.array([d], pa.binary()) for d in data]], names=schema.names)

    def task(batches):
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, group.segment - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == group.segment:
                    yield written(pa.Table.from_batches(held))
                    held, n = [], 0
                    release()
        if held:
            yield written(pa.Table.from_batches(held))

    dealt.mapInArrow(task, schema).write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.parquet(path)


def bounds(group: Group, segment: Segment, n: int) -> np.ndarray:
    """Documents x items: the smallest bound of the blocks that hold the document, in the lists of the item's terms (-1: in none)."""
    out = np.full((n, len(group.keys)), np.inf)
    seen = np.zeros(out.shape, bool)
    for k, t in enumerate(segment.lists):
        items, beside = group.items_of[t], group.beside[t]
        ends = segment.ends[segment.ends_ptr[k]:segment.ends_ptr[k + 1]]
        place, top = (v[segment.sums_ptr[k]:segment.sums_ptr[k + 1]] for v in (segment.place, segment.top))
        summary = np.zeros(len(ends) * len(beside))
        summary[place] = top
        ask = np.zeros((len(beside), len(items)))
        for j, i in enumerate(items):
            ask[np.searchsorted(beside, group.asked[i]), j] = group.weight[group.asked[i]]
        bound = np.repeat(summary.reshape(len(ends), -1) @ ask, np.diff(np.append(0, ends)), axis=0)
        at = np.ix_(segment.docs[segment.docs_ptr[k]:segment.docs_ptr[k + 1]], items)
        out[at] = np.minimum(out[at], bound)
        seen[at] = True
    out[~seen] = -1
    return out


def search_segment(group: Group, segment: Segment, id_rank: np.ndarray, floor: np.ndarray, best: int) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], int]:
    """([(item, documents, scores)] of at most ``best`` documents each that score ``floor[item]`` or more, number of documents scored)."""
    bound = bounds(group, segment, len(id_rank))
    x = impacts(segment.ptr, segment.term, segment.impact, len(group.vocabulary))
    found, scored = [], 0
    for i, asked in enumerate(group.asked):
        least, weight = max(1, int(floor[i])), group.weight[asked].astype(float)
        at = np.flatnonzero(bound[:, i] >= least)
        at = at[np.argsort(-bound[at, i], kind="stable")]
        docs, scores = np.zeros(0, int), np.zeros(0, np.int64)
        while len(at) and bound[at[0], i] >= least:  # the best blocks first; what is left is below the least score that counts
            some, at = at[:4 * best], at[4 * best:]
            got = (x[np.ix_(some, asked)].astype(float) @ weight).astype(np.int64)
            scored += len(some)
            docs, scores = np.append(docs, some[got >= least]), np.append(scores, got[got >= least])
            order = np.lexsort((id_rank[docs], -scores))[:best]
            docs, scores = docs[order], scores[order]
            if len(docs) == best:
                least = max(least, int(scores[-1]))
        if len(docs):
            found.append((i, docs, scores))
    return found, scored


def search_index(index: DataFrame, group: Group, best: int) -> DataFrame:
    """key, doc_id, score: of each item the ``best`` documents of every task."""
    id_type = index.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])

    def task(batches):
        kept: list[list] = [[] for _ in group.keys]  # (-score, id is null, id)
        floor = np.zeros(len(group.keys), np.int64)
        id_kind = None
        for batch in batches:
            for r in range(batch.num_rows):
                ids = batch.column("doc_ids").slice(r, 1).flatten()
                id_kind = ids.type
                segment = Segment.unpack([batch.column(f)[r].as_py() for f in Segment.FIELDS])
                rank = np.empty(len(ids), np.int64)
                rank[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
                for i, docs, scores in search_segment(group, segment, rank, floor, best)[0]:
                    mine = [(-s, d is None, 0 if d is None else d) for d, s in zip(ids.take(pa.array(docs)).to_pylist(), scores.tolist())]
                    kept[i] = sorted(kept[i] + mine)[:best]
                    if len(kept[i]) == best:
                        floor[i] = -kept[i][-1][0]
            release()
        flat = [(group.keys[i], None if none else d, -s) for i, some in enumerate(kept) for s, none, d in some]
        if flat:
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in flat], pa.int64()), pa.array([f[1] for f in flat], id_kind), pa.array([f[2] for f in flat], pa.int64())], names=schema.names)

    return index.mapInArrow(task, schema)


def search(docs: DataFrame, items: DataFrame, best: int = BEST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the ``best`` documents of every item."""
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "lexical")
    ship_package(spark)
    dealt, groups = deal_items(items, item_col, item_text_col, path)
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = []
    for number in range(groups):
        group = group_of(dealt, number)
        rows = forward(docs, group, f"{path}/forward-{number}")
        corpus = rows.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("terms")).first()
        df = rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"))
        group.weigh(corpus.n, corpus.terms or 0, {r.t: r.n for r in df.collect()})  # a row a term of the group
        found.append(search_index(build_index(rows, group, f"{path}/index-{number}"), group, best))
    places = Window.partitionBy("key").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = reduce(DataFrame.unionAll, found).withColumn("rank", F.row_number().over(places)).where(F.col("rank") <= best)
    return dealt.select("key", "item_id").join(top, "key").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
