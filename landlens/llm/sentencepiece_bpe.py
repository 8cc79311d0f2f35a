"""SentencePiece encoding and decoding of merge-type (BPE) models (operator 9).

Exact encoding by backtracking instead of a merge queue.  An Aho-Corasick
automaton over the vocabulary gives the pieces that match at each position.  The
encoder takes the longest piece that is compatible with the piece before it; a
pair is compatible if merging the pair's text anew gives the same two pieces.
If no piece fits, the last piece is undone and its end position is marked as
failed in a bitfield, so no position is tried twice.  A sequence of pieces whose
neighbours are all compatible is the sequence that the merges give.

White space is escaped to U+2581 and one is put in front; no piece has U+2581
after another character, so a text falls into independent segments (U+2581 and what
follows), whose encodings a worker remembers in a dictionary of bounded size.
Characters outside the vocabulary become their UTF-8 bytes; they merge with nothing.

Decoding joins the pieces of the ids, turns byte pieces back into text (invalid
bytes become U+FFFD), U+2581 into a space and drops the leading one.

Defined results: a null text counts as empty; an empty text has no pieces (only
the end id, if asked for) and decodes to an empty text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landlens.session import ship_package

#: Segments whose encoding a worker remembers at most.
REMEMBERED = 700_000
#: Compatible pairs that a worker remembers at most.
REMEMBERED_PAIRS = 400_000

SPACE = "▁"
_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class MergeModel:
    """Vocabulary, scores and options of a merge-type model file, and the exact encoder."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.end, self.unknown = sp.eos_id(), sp.unk_id()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i) for i in range(n)]
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.byte_id = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.id = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        if any(p.lstrip(SPACE).count(SPACE) for p in self.id):
            raise ValueError("pieces with inner white space: texts do not fall into segments")
        self.compatible: dict[tuple[str, str], bool] = {}
        # a piece that the merges never make is no candidate
        self.automaton = ahocorasick.Automaton()
        for p in self.id:
            if len(p) == 1 or self.merge(p) == [p]:
                self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()

    def merge(self, text: str) -> list[str]:
        """The pieces that the merges give: the pair with the best score first, the leftmost of equals."""
        part, score = list(text), self.score
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        queue = [(-score[p], i, p) for i, p in enumerate(map("".join, zip(part, part[1:]))) if p in score]
        heapify(queue)
        while queue:
            _, i, merged = heappop(queue)
            j = after[i]
            if part[i] is None or j >= len(part) or part[i] + part[j] != merged:
                continue
            part[i], part[j] = merged, None
            after[i] = k = after[j]
            if k < len(part):
                before[k] = i
                if (p := merged + part[k]) in score:
                    heappush(queue, (-score[p], i, p))
            if (k := before[i]) >= 0 and (p := part[k] + merged) in score:
                heappush(queue, (-score[p], k, p))
        return [p for p in part if p is not None]

    def fits(self, left: str, right: str) -> bool:
        """Whether the two pieces stay side by side when their text is merged anew."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) > REMEMBERED_PAIRS:
                self.compatible.clear()
            known = self.compatible[left, right] = self.merge(left + right) == [left, right]
        return known

    def split(self, text: str) -> list[str]:
        """Pieces of an escaped text by backtracking (a character outside the vocabulary is a piece of its own)."""
        n = len(text)
        ends: list[list[int] | None] = [None] * n  # ends of the pieces that start here, the longest last
        for last, length in self.automaton.iter(text):
            first = last - length + 1
            if ends[first] is None:
                ends[first] = [last + 1]
            else:
                ends[first].append(last + 1)
        failed = 0  # bitfield of the positions from which no way leads on
        starts: list[int] = []  # start of each piece
        left: list[int] = []  # of each piece: how many shorter choices are left
        out: list[str] = []
        compatible, fits = self.compatible, self.fits
        at, before = 0, None  # before: the piece to the left, if it can merge with anything
        choices = ends[0] if n else None
        k = len(choices) if choices else 0
        while at < n:
            found = at + 1 if choices is None else -1  # a character outside the vocabulary
            while k:
                k -= 1
                e = choices[k]
                if failed >> e & 1:
                    continue
                piece = text[at:e]
                if before is not None:
                    known = compatible.get((before, piece))
                    if known is None:
                        known = fits(before, piece)
                    if not known:
                        continue
                found = e
                break
            if found >= 0:
                starts.append(at)
                left.append(k)
                piece = text[at:found]
                out.append(piece)
                before = None if choices is None else piece
                at = found
                choices = ends[at] if at < n else None
                k = len(choices) if choices else 0
            else:
                failed |= 1 << at
                if not starts:
                    return self.merge(text)
                at, k = starts.pop(), left.pop()
                out.pop()
                choices = ends[at]
                before = out[-1] if out and ends[starts[-1]] is not None else None
        return out

    def ids(self, pieces: list[str]) -> list[int]:
        out = []
        for p in pieces:
            i = self.id.get(p)
            if i is not None:
                out.append(i)
            elif self.byte_id:
                out += [self.byte_id[b] for b in p.encode()]
            elif not (out and out[-1] == self.unknown):
                out.append(self.unknown)
        return out

    def encode(self, text: str) -> list[int]:
        return [i for s in segments(text) for i in self.ids(self.split(s))]

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; control ids have none."""
        return unescape(self.surface(ids))

    def surface(self, ids: list[int]) -> str:
        out, waiting = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                waiting.append(self.byte_of[i])
                continue
            if waiting:
                out.append(_bytes_text(bytes(waiting)))
                waiting.clear()
            if i not in self.control:
                out.append(self.pieces[i])
        if waiting:
            out.append(_bytes_text(bytes(waiting)))
        return "".join(out)


def _bytes_text(data: bytes) -> str:
    """UTF-8; each byte that is part of no character becomes one U+FFFD."""
    out = []
    while data:
        try:
            return "".join(out) + data.decode()
        except UnicodeDecodeError as e:
            out.append(data[:e.start].decode() + "�")
            data = data[e.start + 1:]
    return "".join(out)


def segments(text: str) -> list[str]:
    return _SEGMENT.findall(SPACE + text.replace(" ", SPACE)) if text else []


def unescape(surface: str) -> str:
    return (surface[1:] if surface[:1] == SPACE else surface).replace(SPACE, " ")


@lru_cache(maxsize=2)
def load(path: str) -> MergeModel:
    return MergeModel(path)


class Coder:
    """Encodes and decodes whole texts; remembers segments."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.model, self.remembered = load(path), remembered
        self.known: dict[str, str] = {}  # segment -> its ids as text
        self.other: dict[str, str] = {}  # segment -> what its ids decode to, where that is another text

    def learn(self, new) -> None:
        model = self.model
        for s in new:
            ids = model.ids(model.split(s))
            self.known[s] = " ".join(map(str, ids))
            if (back := model.surface(ids)) != s:
                self.other[s] = back

    def code(self, text: str) -> tuple[int, str, str]:
        """Number of ids, ids joined by a space, decoded text."""
        if not text:
            return 0, "", ""
        cut = segments(text)
        new = set(cut).difference(self.known)
        if new:
            if len(self.known) + len(new) > self.remembered:
                self.known.clear()
                self.other.clear()
                new = set(cut)
            self.learn(new)
        ids = " ".join(map(self.known.__getitem__, cut))
        if self.other:
            cut = [self.other.get(s, s) for s in cut]
        return ids.count(" ") + 1, ids, unescape("".join(cut))


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", add_end: bool = True,
                  digests: bool = False) -> DataFrame:
    """ids of every text (array<int>, or with ``digests`` their number and hash) and the text decoded from them.

    One pass without a shuffle.  ``digests``: doc_id, n_tokens, ids_sha256 (of the
    decimal ids joined by one space), decoded_sha256; else doc_id, n_tokens, ids, decoded.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .words import slices

        coder = Coder(model_path)
        end = str(coder.model.end)
        for batch in batches:
            for part in slices(batch, "text"):
                n, a, b = [], [], []
                for text in part.column("text").to_pylist():
                    k, ids, decoded = coder.code(text)
                    if add_end:
                        k, ids = k + 1, f"{ids} {end}" if ids else end
                    n.append(k)
                    if digests:
                        a.append(hashlib.sha256(ids.encode()).hexdigest())
                        b.append(hashlib.sha256(decoded.encode()).hexdigest())
                    else:
                        a.append([int(i) for i in ids.split()])
                        b.append(decoded)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n, pa.int64()), pa.array(a, pa.string() if digests else pa.list_(pa.int32())), pa.array(b, pa.string())],
                    names=["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))])

    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"))
