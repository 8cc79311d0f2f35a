"""Language identification by cross-parsing entropy (operator 1).

Each language has a suffix automaton of a bounded sample of its labelled text.  A
text is parsed greedily into the longest phrases that occur in the sample; the
number of phrases, times the bits that address a place in the sample, over the
text's length is an upper bound of its entropy under that language.  The language
with the fewest normalised phrases wins.

Texts are lower-cased; every run of characters that are not letters is one space.
They are parsed whole, in runs of at most ``RUN`` characters (a phrase ends at a
run's end), all runs of a batch in step, one numpy operation a character.

Sample (documented bound): of the training rows, ``SAMPLE`` hash buckets a
language, of each bucket the row with the smallest hash, of each such row at most
``ROW_CHARS`` characters, and of a language at most ``LANGUAGE_CHARS`` in all.

Defined results: a text that is null, empty or without any letter gets ``und``
and score 0; ties go to the language whose name sorts first; without any labelled
row every text is ``und``.  A null id is hashed like an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landlens.session import ship_package

from .blocks import rest_of_row

SAMPLE, ROW_CHARS, LANGUAGE_CHARS = 64, 2_000, 30_000
RUN = 256
#: Characters that one step handles at once.
STEP_CHARS = 512 << 10
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def plain(text: str) -> str:
    """Lower-case letters, words apart by one space, a space at both ends."""
    return " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "


class Automaton:
    """Suffix automaton: accepts exactly the substrings of a text."""

    def __init__(self, text: str):
        self.edges: list[dict[str, int]] = [{}]
        link, size, last = [-1], [0], 0
        for c in text:
            new = len(self.edges)
            self.edges.append({})
            size.append(size[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and c not in self.edges[at]:
                self.edges[at][c] = new
                at = link[at]
            if at >= 0:
                to = self.edges[at][c]
                if size[to] == size[at] + 1:
                    link[new] = to
                else:
                    copy = len(self.edges)
                    self.edges.append(dict(self.edges[to]))
                    size.append(size[at] + 1)
                    link.append(link[to])
                    link[to] = link[new] = copy
                    while at >= 0 and self.edges[at].get(c) == to:
                        self.edges[at][c] = copy
                        at = link[at]
            last = new


class Parser:
    """Cross-parses texts against the automata of all languages at once.

    Columns of the step table: 0 a space, 1 and up the letters of the samples, then
    a letter that no sample has, then the filler behind a run's end.
    """

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        texts = [plain(samples[n]) for n in self.names]
        alphabet = sorted(set("".join(texts)) - {" "})
        self.width = w = len(alphabet) + 3
        column = {" ": 0, **{c: i + 1 for i, c in enumerate(alphabet)}}
        self.column = np.where(_letters(), w - 2, 0).astype(np.uint16)
        for c, i in column.items():
            self.column[ord(c)] = i
        tables, self.roots, at = [], [], 0
        for t in texts:
            edges = Automaton(t).edges
            table = np.full((len(edges), w), -1, np.int32)
            for s, e in enumerate(edges):
                for c, to in e.items():
                    table[s, column[c]] = (at + to) * w
            table[:, w - 1] = (at + np.arange(len(edges))) * w
            self.roots.append(at * w)
            tables.append(table)
            at += len(edges)
        self.table = np.concatenate(tables).ravel()
        self.first = np.stack([np.where(t[0] < 0, r, t[0]) for t, r in zip(tables, self.roots)])  # where a new phrase leads
        self.bits = np.array([np.log2(max(len(t), 2)) for t in texts])

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(phrases of each text by language, characters parsed of each text)."""
        # one line a text; lower-casing may change lengths, so texts are found again by their line ends
        points = code_points("\n".join([t.replace("\n", " ") for t in texts]).lower())
        codes, line = self.column[points], points == 10
        row = np.cumsum(line) - line
        space = codes == 0
        keep = ~space
        keep[1:] |= space[1:] & ~space[:-1]  # the first of a run of spaces
        keep &= ~line | ~space
        letters = np.bincount(row[~space], minlength=len(texts))
        codes, row = codes[keep], row[keep]
        length = np.bincount(row, minlength=len(texts))
        runs = -(-length // RUN)
        counts = np.zeros((len(self.names), len(texts)), np.int64)
        if len(codes):
            first = np.cumsum(runs) - runs
            at = np.arange(len(codes)) - np.repeat(np.cumsum(length) - length, length)
            lanes = np.full((RUN, int(runs.sum())), self.width - 1, np.uint16)
            lanes[at % RUN, np.repeat(first, length) + at // RUN] = codes
            owner = np.repeat(np.arange(len(texts)), runs)
            for k, root in enumerate(self.roots):
                state = np.full(lanes.shape[1], root, np.int32)
                found = np.ones(lanes.shape[1], np.int32)
                for step in lanes:
                    to = self.table[state + step]
                    ended = to < 0
                    found += ended
                    state = np.where(ended, self.first[k][step], to)
                counts[k] = np.bincount(owner, found, minlength=len(texts))
        return counts, np.where(letters > 0, length, 0)

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (1 - best / second-best entropy) and best entropy (bits a character) of each text."""
        counts, length = self.phrases(texts)
        rate = counts * self.bits[:, None] / np.maximum(length, 1)
        best = rate.argmin(0)
        low = rate.min(0)
        if len(self.names) > 1:
            second = np.partition(rate, 1, axis=0)[1]
            score = np.where(second > 0, 1 - low / np.maximum(second, 1e-300), 0.0)
        else:
            score = np.ones(len(texts))
        known = length > 0
        return [self.names[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, score, 0.0), np.where(known, low, np.nan)


@lru_cache(maxsize=2)
def _parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(dict(samples))


def held_out(id_col, folds: int):
    """Whether crc32 of the id as text leaves no remainder by ``folds``."""
    return F.pmod(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == 0


def learn_samples(docs: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int) -> dict[str, str]:
    """The bounded sample of each language: at most SAMPLE rows of ROW_CHARS characters reach the driver."""
    train = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col, folds))
    row = F.xxhash64(F.col(id_col).cast("string"))
    picked = (train.select(F.col(lang_col).alias("lang"), row.alias("h"))
              .groupBy("lang", F.pmod("h", F.lit(SAMPLE)).alias("bucket")).agg(F.min("h").alias("h")))
    texts = (train.select(F.col(lang_col).alias("lang"), row.alias("h"), F.substring(text_col, 1, ROW_CHARS).alias("text"))
             .join(picked.select("lang", "h"), ["lang", "h"], "left_semi")
             .groupBy("lang", "h").agg(F.min("text").alias("text")))
    out: dict[str, list[str]] = {}
    for r in sorted(texts.collect(), key=lambda r: (str(r.lang), r.h)):
        out.setdefault(str(r.lang), []).append(r.text)
    return {k: " ".join(v)[:LANGUAGE_CHARS] for k, v in out.items() if any(c.isalpha() for t in v for c in t)}


def entropy_bound(samples: dict[str, str], margin: float = 2.0) -> float | None:
    """Bits a character above which a text is in none of the languages; None if none was learned.

    Fitted on the bounded sample: the last quarter of each language's text, in pieces
    of 500 characters, is parsed with what comes before; ``margin`` times the worst piece.
    """
    cut = {k: 3 * len(v) // 4 for k, v in samples.items()}
    learned = {k: v[:cut[k]] for k, v in samples.items() if any(c.isalpha() for c in v[:cut[k]])}
    pieces = [samples[k][a:a + 500] for k in learned for a in range(cut[k], len(samples[k]), 500)]
    if not pieces:
        return None
    bits = Parser(learned).judge(pieces)[2]
    return None if np.isnan(bits).all() else margin * float(np.nanmax(bits))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5,
             samples: dict[str, str] | None = None, rest: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits (entropy a character, null for ``und``) of every row.

    ``samples`` (language -> text) is learned from ``docs`` if not given.  The
    prediction sees the text only.  With ``rest``, the text (null: empty) and a struct
    of all other columns come along.
    """
    ship_package(docs.sparkSession)
    if samples is None:
        samples = learn_samples(docs, id_col, text_col, lang_col, folds)
    model = docs.sparkSession.sparkContext.broadcast(tuple(sorted(samples.items())))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), held_out(id_col, folds).alias("held_out"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), *([rest_of_row(docs, id_col, text_col).alias("rest")] if rest else []))
    passed = ["doc_id", "held_out", *(["text", "rest"] if rest else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .words import slices

        parser = _parser(model.value) if model.value else None
        for batch in batches:
            for part in slices(batch, "text", STEP_CHARS):
                texts = part.column("text").to_pylist()
                if parser:
                    lang, score, bits = parser.judge(texts)
                else:
                    lang, score, bits = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.nan)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in passed] + [pa.array(lang, pa.string()), pa.array(score), pa.array(bits, from_pandas=True)],
                    names=[*passed, "lang_pred", "score", "bits"])

    kind = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join(f"{c} {kind[c]}" for c in passed) + ", lang_pred string, score double, bits double")
