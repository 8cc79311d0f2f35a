"""Substring dedup (operator 7): Rabin-Karp hashes of every window of ``length`` words, counted in Spark.

Every window's 64-bit rolling hash goes to the shard of its range of hash values
(once a block of documents, see ``blocks``); a window is repeated if it starts at
more than one place of the whole table, its own document included.  Repeated
windows merge into maximal intervals of words, which are removed.  Nothing is kept
of a repeated passage: all its occurrences go, as the windows are judged on the
input.

Hash values are sums of 64-bit word hashes times powers of an odd base, modulo 2^64,
then mixed; two different windows agree with probability 2^-64.

Defined results: a null text has no words; a text of fewer words than a window
keeps all of them; repeated rows repeat all their windows.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks as B
from .words import find_words, hash_words, mix, text_buffer

LENGTH = 35

_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def window_hashes(words: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every window that lies inside one document; ``first`` as in ``Words``."""
    n = len(words)
    counts = np.maximum(np.diff(first) - length + 1, 0)
    if not counts.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts = np.repeat(first[:-1], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    down = np.full(n, _INVERSE)
    down[0] = 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words * np.cumprod(down, dtype=np.uint64), out=total[1:])
    up = np.full(n, _BASE)
    up[0] = 1
    return starts, mix((total[starts + length] - total[starts]) * np.cumprod(up, dtype=np.uint64)[starts])


def ranges(keys: np.ndarray, shards: int) -> list[tuple[int, slice]]:
    """The shards, each a range of 64-bit values, and where their part of the sorted keys lies."""
    width = (1 << 64) // shards + 1
    ends = [*np.searchsorted(keys, np.array([i * width for i in range(1, shards)], np.uint64)).tolist(), len(keys)]
    return [(s, slice(a, b)) for s, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]


def answer_repeats(asked: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
    """For each block the bits of its keys: set if another block asked for the key too."""
    parts = [np.frombuffer(d, np.uint64) for _, d in asked]
    every = np.sort(np.concatenate(parts))
    repeated = every[1:][every[1:] == every[:-1]]
    out = []
    for (block, _), keys in zip(asked, parts):
        at = np.searchsorted(repeated, keys)
        found = repeated[np.minimum(at, len(repeated) - 1)] == keys if len(repeated) else np.zeros(len(keys), bool)
        if found.any():
            out.append((block, np.packbits(found).tobytes()))
    return out


def _windows(table: pa.Table, length: int):
    data, offsets = text_buffer(table["text"])
    words = find_words(data, offsets)
    starts, hashes = window_hashes(hash_words(words), words.first, length)
    keys, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    return words, starts, keys, inverse, counts > 1


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, spacing: bool = False,
                   rest: bool = False) -> DataFrame:
    """id, kept (text of the kept words), n_words, n_removed of every row, and with ``rest`` the struct of its other columns.

    ``kept`` joins the kept words by one space; with ``spacing`` it is the text
    without the removed words and the white space behind each, all else as it was.
    """
    rows = B.in_blocks(docs, id_col, text_col, rest)
    shards = B.partitions(docs.sparkSession)

    def ask(table: pa.Table):
        _, _, keys, _, _ = _windows(table, length)
        return [(s, keys[part].tobytes()) for s, part in ranges(keys, shards)]

    def finish(table: pa.Table, replies: dict[int, bytes]) -> pa.Table:
        words, starts, keys, inverse, repeated = _windows(table, length)
        for s, part in ranges(keys, shards):
            if s in replies:
                repeated[part] |= np.unpackbits(np.frombuffer(replies[s], np.uint8), count=part.stop - part.start).astype(bool)
        hit = starts[repeated[inverse]] if len(starts) else starts
        cover = np.zeros(len(words.starts) + 1, np.int32)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + length, -1)
        gone = np.cumsum(cover[:-1]) > 0
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[words.first[1:]] - total[words.first[:-1]]
        kept = []
        for i, text in enumerate(table["text"].to_pylist()):
            a, b = words.first[i], words.first[i + 1]
            if spacing:
                kept.append(_cut(text, words, a, b, gone) if removed[i] else text)
            else:
                parts = text.encode().split()  # bytes.split() splits at x20 and x09 to x0D, no other
                kept.append(b" ".join(compress(parts, ~gone[a:b]) if removed[i] else parts).decode())
        out = {"id": table["id"], "kept": pa.array(kept, pa.string()), "n_words": pa.array(np.diff(words.first).astype(np.int64)), "n_removed": pa.array(removed.astype(np.int64))}
        return pa.table(out | ({"rest": table["rest"]} if rest else {}))

    kind = dict(rows.dtypes)
    schema = f"id {kind['id']}, kept string, n_words bigint, n_removed bigint" + (f", rest {kind['rest']}" if rest else "")
    return B.exchange(rows, ask, answer_repeats, finish, schema)


def _cut(text: str, words, a: int, b: int, gone: np.ndarray) -> str:
    """The text of words a:b without the gone ones and the white space behind each."""
    raw = text.encode()
    base = int(words.starts[a]) - (len(raw) - len(raw.lstrip()))  # where the row's text begins in the batch
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone[a:b], [False]]).astype(np.int8)))
    out, at = [], 0
    for s, e in zip(edges[::2], edges[1::2]):
        out.append(raw[at:int(words.starts[a + s]) - base])
        at = int(words.starts[a + e]) - base if a + e < b else len(raw)
    return (b"".join(out) + raw[at:]).decode()
