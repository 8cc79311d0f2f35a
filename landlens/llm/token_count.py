"""Token counts (operator 4): overlap resynchronisation.

A huge text is encoded as chunks that overlap.  Two neighbouring chunks are
spliced at a place inside their overlap where both encodings have a token
boundary *and* the pre-tokeniser must cut: before a space that follows a
character other than white space (no pre-token of this byte-level vocabulary has
white space after something else, and no special string contains a space).  Left
of such a place nothing depends on what follows, right of it nothing depends on
what precedes, so the spliced encoding is the encoding of the whole text.  If an
overlap has no such place, it is widened (doubled) until one is found or the
text ends.

Texts of at most one chunk are cut at the same proven places, and each cut's
count is kept in a dictionary of bounded size, because corpora repeat their words.

Defined results: a null text counts as empty; an empty text has 0 tokens.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landlens.session import ship_package

#: Characters a chunk holds and by which it overlaps the next.
CHUNK, OVERLAP = 32_768, 256
#: Words whose counts a worker remembers at most.
REMEMBERED = 400_000

#: White space by any reading of the pre-tokeniser's pattern; a cut never follows one of these.
_SPACE = r"\s᠎​﻿"
_CUT = re.compile(rf"(?<=[^{_SPACE}]) ")
_NO_CUT = re.compile(rf"[{_SPACE}] ")


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def encode_spans(path: str) -> Callable[[str], list[int]]:
    """text -> the start of every token, in characters of the text."""
    t = _tokenizer(path)
    return lambda text: [s for s, _ in t.encode(text, add_special_tokens=False).offsets]


def resync_count(text: str, starts: Callable[[str], list[int]], chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text`` from overlapping chunks spliced at stable boundaries.

    ``starts`` encodes a text and returns the tokens' start offsets; the chunk's
    tokens between its own splice places are counted, the others dropped.
    """
    total, a = 0, 0  # a: proven place up to which tokens are counted
    b = min(len(text), chunk)
    left = starts(text[a:b]) if text else []
    while b < len(text):
        width = overlap
        while True:
            lo = max(a + 1, b - width)
            hi = min(len(text), b + chunk)
            own = {a + s for s in left}
            right = starts(text[lo:hi])
            theirs = {lo + s for s in right}
            # a place must not be an artefact of the cut at lo: it lies behind it
            place = next((m.start() for m in _CUT.finditer(text, lo, b) if m.start() > lo and m.start() in own and m.start() in theirs), None)
            if place is not None:
                break
            if lo == a + 1:  # no place in the whole chunk: lengthen the chunk itself
                b = min(len(text), b + max(chunk, b - a))
                left = starts(text[a:b])
                if b == len(text):
                    return total + len(left)
                width = overlap
                continue
            width *= 2
        total += sum(1 for s in left if a + s < place)
        left = [lo + s - place for s in right if lo + s >= place]
        a, b = place, hi
    return total + len(left)


def pieces(text: str) -> list[str]:
    """``text`` cut at the proven places."""
    if text[0] != " " and not _NO_CUT.search(text):
        first, *rest = text.split(" ")
        return [first, *[" " + p for p in rest]]
    cuts = [0, *(m.start() for m in _CUT.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]


class Counter:
    """Counts of whole texts; remembers counts of pieces between proven places."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.tokenizer, self.spans, self.known, self.remembered = _tokenizer(path), encode_spans(path), {}, remembered

    def count(self, texts: list[str]) -> list[int]:
        cut = [None if len(t) > CHUNK else pieces(t) if t else [] for t in texts]
        known = self.known
        if len(known) > self.remembered:
            known.clear()
        new = list({p for c in cut if c for p in c if p not in known})
        for a in range(0, len(new), 20_000):
            part = new[a:a + 20_000]
            known.update(zip(part, (len(e) for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False))))
        get = known.__getitem__
        return [resync_count(t, self.spans) if c is None else sum(map(get, c)) for t, c in zip(texts, cut)]


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; one pass, no shuffle."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .words import slices

        counter = Counter(tokenizer_path)
        for batch in batches:
            for part in slices(batch, "text"):
                text = part.column("text")
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pc.cast(pc.binary_length(text), pa.int64()), pa.array(counter.count(text.to_pylist()), pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
