"""Language-model scoring (operator 5): a bigram model of the training rows in Elias-Fano tries.

Model.  P(w | h) = a(h, w) + m / (c(h) + m) * P(w) with a(h, w) = c(h, w) / (c(h) + m) and
P(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)); h is the word before, or the beginning of the text.
a is quantised to one byte (steps of equal size in the logarithm; 0: unseen pair).

Where.  The trie is sharded by the context h, so it grows with the corpus without
growing any task.  A shard's trie has two levels: the contexts, and under each its
successors, both Elias-Fano sequences (a successor is searched relative to its
context's number), and the bytes of the smoothed probabilities.  Levels are flat
words, see ``Trie.to_bytes``.

How.  A first pass counts words (N, V, and the words that make up more than 1 / ``HOT`` of
all tokens, at most HOT of them).  Then documents are dealt to blocks; each block sends
each shard its distinct pairs with their training counts in one packed row; the shard
sums the rows to its trie and answers each block with a byte a pair and the count of
each context; the block scores its documents.  The successors of hot words are dealt
to several shards, in proportion to their count.

Words are 64-bit hashes, successors 40-bit hashes below their context.

Defined results: a null text is empty and has only its end token; training rows are
those that are not held out; without any training row all counts are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landlens.session import scratch_path

from . import blocks as B
from .elias_fano import EliasFano
from .lang_id import held_out
from .substring_dedup import ranges
from .words import find_words, hash_words, mix, signed, slices, text_buffer

#: m of the model: pseudo-counts of the word distribution in each context.
PRIOR = 10.0
#: A word with more than 1 / HOT of all tokens has its successors dealt to several shards.
HOT = 1_000
#: Step of the quantised probabilities, in powers of ten, and their number.
STEP, CODES = 0.03, 255

BEGIN, END = (np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344))
_LOW = np.uint64((1 << 40) - 1)


def quantise(a: np.ndarray) -> np.ndarray:
    """Codes 1 (the least) to CODES (probability 1)."""
    return np.clip(CODES + np.rint(np.log10(a) / STEP), 1, CODES).astype(np.uint8)


def dequantise(code: np.ndarray) -> np.ndarray:
    table = np.concatenate([[0.0], 10.0 ** ((np.arange(1, CODES + 1) - CODES) * STEP)])
    return table[code]


class Trie:
    """Contexts (hashes), their successors (number of the context, then the word's 40 bits) and the codes of a."""

    def __init__(self, contexts: EliasFano, successors: EliasFano, codes: np.ndarray, counts: np.ndarray):
        self.contexts, self.successors, self.codes, self.counts = contexts, successors, codes, counts

    @classmethod
    def build(cls, context: np.ndarray, word: np.ndarray, count: np.ndarray, total: dict[int, int]) -> Trie:
        """Of distinct pairs sorted by context and word; ``total``: counts of contexts of which the shard has only a part."""
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, np.int64)
        own = context[first]
        number = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(context)]])))
        counts = np.add.reduceat(count, first) if len(first) else np.zeros(0, np.int64)
        for h, n in total.items():
            at = int(np.searchsorted(own, np.uint64(h)))
            if at < len(own) and own[at] == np.uint64(h):
                counts[at] = n
        return cls(EliasFano.build(own), EliasFano.build((number.astype(np.uint64) << np.uint64(40)) | word),
                   quantise(count / (counts[number] + PRIOR)), counts)

    def to_bytes(self) -> bytes:
        return self.contexts.to_bytes() + self.successors.to_bytes() + self.counts.astype(np.int64).tobytes() + self.codes.tobytes()

    @classmethod
    def from_bytes(cls, data) -> Trie:
        contexts, at = EliasFano.from_bytes(data)
        successors, at = EliasFano.from_bytes(data, at)
        counts = np.frombuffer(data, np.int64, contexts.n, at)
        return cls(contexts, successors, np.frombuffer(data, np.uint8, successors.n, at + 8 * contexts.n), counts)

    def lookup(self, context: np.ndarray, size: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count of each context, code of each pair); ``size`` words belong to each context."""
        at = self.contexts.find(context)
        counts = np.where(at >= 0, self.counts[np.maximum(at, 0)] if len(self.counts) else 0, 0)
        number = np.repeat(at, size)
        place = self.successors.find((np.maximum(number, 0).astype(np.uint64) << np.uint64(40)) | word)
        found = (number >= 0) & (place >= 0)
        return counts, np.where(found, self.codes[np.maximum(place, 0)] if len(self.codes) else 0, 0).astype(np.uint8)


def _five(words: np.ndarray) -> bytes:
    """40-bit values, 5 bytes each."""
    return words.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_five(data: bytes, at: int, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8, 5 * n, at).reshape(n, 5)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def pack(context: np.ndarray, size: np.ndarray, word: np.ndarray, count: np.ndarray) -> bytes:
    return (np.array([len(context), len(word)], np.int64).tobytes() + context.tobytes() + size.astype(np.uint32).tobytes()
            + count.astype(np.uint32).tobytes() + _five(word))


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n, m = (int(x) for x in np.frombuffer(data, np.int64, 2))
    at = 16
    context = np.frombuffer(data, np.uint64, n, at)
    size = np.frombuffer(data, np.uint32, n, at + 8 * n).astype(np.int64)
    count = np.frombuffer(data, np.uint32, m, at + 12 * n).astype(np.int64)
    return context, size, _from_five(data, at + 12 * n + 4 * m, m), count


class Pairs:
    """The tokens of a block's documents as (context, word) pairs, and the distinct ones dealt to shards."""

    def __init__(self, table: pa.Table, shards: int, hot: dict[int, int]):
        data, offsets = text_buffer(table["text"])
        w = find_words(data, offsets)
        h = hash_words(w, lower=True)
        n = len(offsets) - 1
        # tokens: the words of each document, then END; contexts: BEGIN, then the words
        self.first = w.first + np.arange(n + 1)
        self.token = np.insert(h, w.first[1:], END)
        self.context = np.insert(h, w.first[:-1], BEGIN)
        self.row = np.repeat(np.arange(n), np.diff(self.first))
        train = ~np.array(table["held_out"].to_pylist(), bool)[self.row]
        key, names, order = _sorted_pairs(self.context, self.token & _LOW)
        new = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
        start = np.flatnonzero(new)
        c, k = names[(key[start] >> np.uint64(40)).astype(np.int64)], key[start] & _LOW
        count = np.add.reduceat(train[order].astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
        shard = (c % np.uint64(shards)).astype(np.int64)
        if hot:
            names = np.array(sorted(hot), np.uint64)
            parts = np.array([hot[x] for x in sorted(hot)], np.uint64)
            at = np.minimum(np.searchsorted(names, c), len(names) - 1)
            many = np.where(names[at] == c, parts[at], np.uint64(1))
            shard = (shard + (mix(k) % many).astype(np.int64)) % shards
        by = np.argsort(shard.astype(np.uint16) if shards < 1 << 16 else shard, kind="stable")
        self.distinct = np.empty(len(order), np.int64)  # of each token: the place of its pair in the dealt order
        back = np.empty(len(by), np.int64)
        back[by] = np.arange(len(by))
        self.distinct[order] = back[np.cumsum(new) - 1]
        self.pair_context, self.pair_word, self.pair_count = c[by], k[by], count[by]
        ends = np.searchsorted(shard[by], np.arange(shards + 1))
        self.parts = [(s, slice(int(a), int(b))) for s, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]

    def asks(self) -> list[tuple[int, bytes]]:
        out = []
        for s, part in self.parts:
            context, size = _runs(self.pair_context[part])
            out.append((s, pack(context, size, self.pair_word[part], self.pair_count[part])))
        return out

    def answers(self, replies: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code of each token's pair, contexts, their counts)."""
        codes = np.zeros(len(self.pair_context), np.uint8)
        contexts, counts = [], []
        for s, part in self.parts:
            context, _ = _runs(self.pair_context[part])
            counts.append(np.frombuffer(replies[s], np.int64, len(context)))
            codes[part] = np.frombuffer(replies[s], np.uint8, part.stop - part.start, 8 * len(context))
            contexts.append(context)
        context, count = np.concatenate(contexts), np.concatenate(counts)
        context, at = np.unique(context, return_index=True)
        return codes[self.distinct], context, count[at]


def _sorted_pairs(context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted keys: number of the context and 40 bits of the word, the contexts by number, where each key came from)."""
    names, number = np.unique(context, return_inverse=True)
    if len(names) >= 1 << 24:
        raise ValueError("more than 16 million contexts at once: use more shuffle partitions")
    key = (number.astype(np.uint64) << np.uint64(40)) | word
    order = np.argsort(key)
    return key[order], names, order


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start = np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
    return sorted_values[start], np.diff(np.concatenate([start, [len(sorted_values)]]))


def answer(asked: list[tuple[int, bytes]], hot_counts: dict[int, int]) -> list[tuple[int, bytes]]:
    """Builds the shard's trie from all blocks' counts and answers each block's pairs."""
    got = [(block, unpack(data)) for block, data in asked]
    context = np.concatenate([np.repeat(c, s) for _, (c, s, _, _) in got])
    word = np.concatenate([w for _, (_, _, w, _) in got])
    count = np.concatenate([n for _, (_, _, _, n) in got])
    seen = count > 0
    context, word, count = context[seen], word[seen], count[seen]
    key, names, order = _sorted_pairs(context, word)
    if len(key):
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.add.reduceat(count[order], start)
        context, word = names[(key[start] >> np.uint64(40)).astype(np.int64)], key[start] & _LOW
    trie = Trie.from_bytes(Trie.build(context, word, count, hot_counts).to_bytes())
    out = []
    for block, (c, s, w, _) in got:
        counts, codes = trie.lookup(c, s, w)
        for h, n in hot_counts.items():  # a part of a hot context may have no trained pair here
            at = int(np.searchsorted(c, np.uint64(h)))
            if at < len(c) and c[at] == np.uint64(h):
                counts[at] = n
        out.append((block, counts.astype(np.int64).tobytes() + codes.tobytes()))
    return out


def vocabulary(rows: DataFrame, path: str) -> tuple[int, int, int, dict[int, int]]:
    """(N, V, training rows, counts of hot words and BEGIN) of rows with held_out false; at most HOT + 1 words reach the driver."""
    spark = rows.sparkSession
    shards = B.partitions(spark)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, n = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        waiting: list[np.ndarray] = []
        size = 0

        def merge():
            nonlocal words, counts, waiting, size
            new = np.concatenate([words, *waiting])
            weight = np.concatenate([counts, np.ones(size, np.int64)])
            words, at = np.unique(new, return_inverse=True)
            counts = np.bincount(at, weight, len(words)).astype(np.int64)
            waiting, size = [], 0

        for batch in batches:
            for part in slices(batch, "text"):
                n += part.num_rows
                data, offsets = text_buffer(part.column("text"))
                h = hash_words(find_words(data, offsets), lower=True)
                waiting.append(h)
                size += len(h)
                if size > 2_000_000:
                    merge()
        merge()
        cut = [(s, words[p].tobytes() + counts[p].tobytes()) for s, p in ranges(words, shards)]
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in cut] + [0], pa.int32()), pa.array([d for _, d in cut] + [b""], pa.binary()), pa.array([0] * len(cut) + [n], pa.int64())],
                                         names=["shard", "data", "rows"])

    def total(table: pa.Table) -> pa.Table:
        parts = [(np.frombuffer(d, np.uint64, len(d) // 16), np.frombuffer(d, np.int64, len(d) // 16, len(d) // 2)) for d in table["data"].to_pylist()]
        words, at = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([c for _, c in parts]), len(words)).astype(np.int64)
        top = np.argsort(-counts)[:HOT]
        k = len(top)
        return pa.table({"word": pa.array([None, *signed(words[top]).tolist()], pa.int64()), "c": pa.array([int(counts.sum()), *counts[top].tolist()], pa.int64()),
                         "v": pa.array([len(words)] + [0] * k, pa.int64()), "rows": pa.array([sum(table["rows"].to_pylist())] + [0] * k, pa.int64())})

    train = rows.where(~F.col("held_out")).select("text")
    (train.mapInArrow(count, "shard int, data binary, rows bigint").groupBy("shard").applyInArrow(total, "word bigint, c bigint, v bigint, rows bigint")
     .write.parquet(path))
    found = spark.read.parquet(path)
    s = found.where("word is null").agg(F.sum("c").alias("n"), F.sum("v").alias("v"), F.sum("rows").alias("rows")).first()
    n, v, trained = s.n or 0, s.v or 0, s.rows or 0
    tokens = n + trained
    hot = {r.word & 0xFFFFFFFFFFFFFFFF: r.c for r in found.where(F.col("word").isNotNull() & (F.col("c") * HOT > tokens)).select("word", "c").collect()}
    if trained:
        hot[int(BEGIN)] = trained
    return tokens, v + (1 if trained else 0), trained, hot


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), held_out(id_col, folds).alias("held_out"))
    rows = B.in_blocks(rows, "id", "text", keep_rest=True).select("block", "id", "text", "rest.held_out")
    tokens, distinct, trained, hot_counts = vocabulary(rows, scratch_path(spark, "lm-words"))
    shards = B.partitions(spark)
    hot = {h: min(shards, -(-n * HOT // max(tokens, 1))) for h, n in hot_counts.items()}

    def ask(table: pa.Table):
        return Pairs(table, shards, hot).asks()

    def respond(asked):
        return answer(asked, hot_counts)

    def finish(table: pa.Table, replies: dict[int, bytes]) -> pa.Table:
        p = Pairs(table, shards, hot)
        code, context, count = p.answers(replies)
        at = np.minimum(np.searchsorted(context, p.token), len(context) - 1)
        c = np.where(p.token == END, trained, np.where(context[at] == p.token, count[at], 0))
        base = (c + 0.1) / (tokens + 0.1 * (distinct + 1))
        ch = count[np.searchsorted(context, p.context)]
        probability = dequantise(code) + PRIOR / (ch + PRIOR) * base
        n = table.num_rows
        return pa.table({"doc_id": table["id"], "held_out": table["held_out"], "n_tokens": pa.array(np.diff(p.first).astype(np.int64)),
                         "n_known": pa.array(np.bincount(p.row, c > 0, n).astype(np.int64)), "train_tokens": pa.array(np.full(n, tokens, np.int64)),
                         "base_score": pa.array(np.bincount(p.row, np.log10(base), n)), "score": pa.array(np.bincount(p.row, np.log10(probability), n))})

    kind = dict(rows.dtypes)["id"]
    return B.exchange(rows, ask, respond, finish,
                      f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
