r"""Delimited files whose quoted fields hold newlines (S2), read by many tasks.

A reader that must know where a record starts can't begin in the middle of a file: a
newline may be inside quotes.  Here the file is read as lines, in pieces (splits of the
file, 128 MB by default), and whether a line starts inside quotes is found by a prefix scan:

1. A line is a map of two states, outside and inside quotes, at its start to the state
   at its end; two regular expressions give both ends (a quote opens a field only
   right after a separator, so counting quotes would not do).  Such a map keeps
   the state, turns it round, or sets it.
2. The task that reads a piece composes the maps in order, ``CHUNK_LINES`` lines at a
   time, for both states at the start of the piece: the state before a line is
   what the last line that sets it says, turned round by each line since that turns it.
   A row a piece is left: its map, the records that start in it, and for both states the
   places where its first lines stop belonging to an earlier record and where a record
   starts that goes on in the next piece.
3. The pieces' own maps are composed in the same way (a window over a row a piece), which gives
   the state at the start of each piece and the record that its first lines still belong to.
4. The lines between those two places of a piece are whole records: the task that reads
   them again puts them together in order.  Only the lines outside, of
   records that lie in several pieces, are gathered, by record.  ``from_csv`` parses the records.

The text goes through no shuffle, but for the records over several pieces; three passes read it, the
third without the maps.  What all tasks get is a row a piece.  A record is one row in any reader, so a
record has to fit in a task: a quote that is never closed makes the rest of its file one
field, as it does for ``multiLine``.  Line ends are \n or \r\n and become \n inside fields.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landlens.session import ship_package

#: Lines whose maps are composed at a time.
CHUNK_LINES = 4096
_PIECE = ["__file", "__piece"]
_CHUNK = [*_PIECE, "__chunk"]
#: What the lines of a piece say for both states at its start: state at the end, records that start in it, place of the
#: last of them; and place of the first line outside quotes, if the piece starts inside.
_ENDS = ("__file string, __piece bigint, __end0 boolean, __end1 boolean, __records0 bigint, __records1 bigint, "
         "__last0 bigint, __last1 bigint, __from1 bigint")
_NO_PLACE = (1 << 63) - 1


def line_maps(line: Column, sep: str, quote: str, escape: str) -> tuple[Column, Column]:
    """(inside, inside): whether the text after the line is in a quoted field, if the line starts outside or inside one."""
    s, q, e = (re.escape(c) for c in (sep, quote, escape))
    if escape == quote:
        body = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+"
        end = "$"
    else:
        body = f"[^{q}{e}]*+(?:{e}.[^{q}{e}]*+)*+"
        end = f"{e}?+$"  # an escape before the line's end takes the newline
    field = f"(?:{q}{body}{q}[^{s}]*+|(?!{q})[^{s}]*+){s}"
    opened = f"(?:{field})*+{q}{body}{end}"
    none = ~F.contains(line, F.lit(quote))
    return (F.when(none, F.lit(False)).otherwise(line.rlike(f"(?s)^{opened}")),
            F.when(none, F.lit(True)).otherwise(line.rlike(f"(?s)^(?:{body}{end}|{body}{q}[^{s}]*+{s}{opened})")))


def _states(df: DataFrame, outside: str, inside: str, order: WindowSpec, starts: dict[str, Column]) -> DataFrame:
    """Adds for each of ``starts`` the state (1: inside quotes) before each row, if it is that before the first."""
    here, earlier = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), order.rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col(outside) & ~F.col(inside)).cast("long")
    df = df.withColumns({"__turned": F.sum(turns).over(here), "__before": F.coalesce(F.sum(turns).over(earlier), F.lit(0))})
    sets = F.when(F.col(outside) == F.col(inside), F.struct(F.col(outside).cast("long").alias("to"), F.col("__turned").alias("turned")))
    df = df.withColumn("__last", F.last(sets, ignorenulls=True).over(earlier))
    since = F.col("__last.to") - F.col("__last.turned")
    out = {name: F.pmod(F.coalesce(since, start) + F.col("__before"), F.lit(2)) for name, start in starts.items()}
    return df.withColumns(out).drop("__turned", "__before", "__last")


def _lines(spark: SparkSession, paths: Sequence[str], sep: str, quote: str, escape: str) -> DataFrame:
    """Lines with their file, piece, chunk, place (that grows in a piece) and maps; ``__text`` says that a line is not empty."""
    text = spark.read.option("lineSep", "\n").text(list(paths))
    line = F.regexp_replace("value", "\r$", "")
    lines = text.select(F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__piece"),
                        F.monotonically_increasing_id().alias("__at"), line.alias("__line"))
    lines = lines.withColumn("__chunk", F.expr(f"__at div {CHUNK_LINES}"))
    outside, inside = line_maps(F.col("__line"), sep, quote, escape)
    return lines.withColumns({"__outside": outside, "__inside": inside, "__text": F.col("__line") != ""})


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """The batches cut at ends of chunks and pieces, and whether a cut begins another piece."""
    last = None
    for batch in batches:
        columns = [batch.column(c) for c in _CHUNK]
        other = np.zeros(max(batch.num_rows - 1, 0), dtype=bool)
        for c in columns:
            other |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
        for a, b in pairwise([0, *(np.flatnonzero(other) + 1).tolist(), batch.num_rows]):
            if a < b:
                here = [c[a].as_py() for c in columns[:2]]
                yield batch.slice(a, b - a), here != last
                last = here


def _flags(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in names]


def _before(outside: np.ndarray, inside: np.ndarray, start: int) -> tuple[np.ndarray, int]:
    """The state before each line, and after the last, if it is ``start`` before the first."""
    turned = np.cumsum(outside & ~inside)
    setting = np.maximum.accumulate(np.where(outside == inside, np.arange(len(outside)), -1))
    since = np.where(setting >= 0, outside[setting].astype(int) - turned[setting], start)
    after = (since + turned) & 1
    return np.concatenate([[start], after[:-1]]), int(after[-1])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a piece (``_ENDS``) from its lines in order."""
    rows: list[dict] = []
    for part, new in _runs(batches):
        if new:
            rows.append({"__file": part.column("__file")[0].as_py(), "__piece": part.column("__piece")[0].as_py(), "__end0": 0, "__end1": 1,
                         "__records0": 0, "__records1": 0, "__last0": None, "__last1": None, "__from1": None})
        row = rows[-1]
        outside, inside, text, at = _flags(part, "__outside", "__inside", "__text", "__at")
        for s in (0, 1):
            before, row[f"__end{s}"] = _before(outside, inside, row[f"__end{s}"])
            free = np.flatnonzero(before == 0)
            if s and row["__from1"] is None and len(free):
                row["__from1"] = int(at[free[0]])
            begun = np.flatnonzero((before == 0) & text)
            if len(begun):
                row[f"__records{s}"] += len(begun)
                row[f"__last{s}"] = int(at[begun[-1]])
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
    fields = [field.split() for field in _ENDS.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array([bool(r[n]) if k == "boolean" else r[n] for r in rows], kinds[k]) for n, k in fields], [n for n, _ in fields])


def _joined(lines: pa.Array, starts: Sequence[int]) -> pa.Array:
    """Texts of the lines from each start to the next."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), lines), pa.scalar("\n", lines.type))


def _put_together(header: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(file, record) from lines of pieces in order that begin outside quotes and end with a record."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, begun, skip = 0, [], False
        for part, new in _runs(batches):
            if new:
                state, begun, skip = 0, [], header and part.column("__first")[0].as_py()
            outside, inside, text = _flags(part, "__outside", "__inside", "__text")
            before, state = _before(outside, inside, state)
            kept = (before == 1) | text
            lines = part.column("__line").filter(pa.array(kept))
            starts = np.flatnonzero(before[kept] == 0).tolist()
            whole = []
            begun.append(lines[:starts[0] if starts else len(lines)])
            if starts or state == 0:  # the record of earlier chunks is complete
                some = pa.concat_arrays(begun)
                whole, begun = [_joined(some, [0, len(some)])] if len(some) else [], []
            if starts:
                if state == 0:
                    starts.append(len(lines))
                else:
                    begun = [lines[starts[-1]:]]
                whole.append(_joined(lines, starts))
            records = pa.concat_arrays(whole) if whole else lines[:0]
            if skip and len(records):
                records, skip = records[1:], False
            yield pa.RecordBatch.from_arrays([part.column("__file")[:len(records)], records], ["file", "record"])

    return task


def _pieces(lines: DataFrame) -> DataFrame:
    """For each piece the records before it, those that start in it, the piece that its first lines' record starts in, and
    the place of the first line of its own (``__from``) and of its last record, if that goes on in the next piece (``__to``)."""
    found = lines.select(*_CHUNK, "__at", "__outside", "__inside", "__text").mapInArrow(_ends, _ENDS)
    order = Window.partitionBy("__file").orderBy("__piece")
    found = _states(found, "__end0", "__end1", order, {"__start": F.lit(0)})
    free = F.col("__start") == 0
    records, last, inside = (F.when(free, F.col(f"{c}0")).otherwise(F.col(f"{c}1")) for c in ("__records", "__last", "__end"))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(_NO_PLACE)
    return found.select(*_PIECE, records.alias("__records"), F.coalesce(F.sum(records).over(earlier), F.lit(0)).alias("__before"),
                        F.last(F.when(records > 0, F.col("__piece")), ignorenulls=True).over(earlier).alias("__owner"),
                        F.when(free, F.lit(0)).otherwise(F.coalesce("__from1", none)).alias("__from"),
                        F.when(inside, F.coalesce(last, none)).otherwise(none).alias("__to"))


def read_records(spark: SparkSession, path: str | Sequence[str], sep: str = ";", quote: str = '"', escape: str = "\\", header: bool = True) -> DataFrame:
    """(file, record): the records of delimited files as text, those that span lines whole; empty lines between records are left out.

    With ``header`` the first record of each file is left out.
    """
    ship_package(spark)
    paths = [path] if isinstance(path, str) else list(path)
    lines = _lines(spark, paths, sep, quote, escape)
    placed = lines.join(F.broadcast(_pieces(lines)), _PIECE)  # a row a piece, which Spark would take for a row a line
    earlier, later = F.col("__at") < F.col("__from"), F.col("__at") >= F.col("__to")
    own = placed.where(~earlier & ~later).select(*_CHUNK, "__line", "__outside", "__inside", "__text", (F.col("__before") == 0).alias("__first"))
    whole = own.mapInArrow(_put_together(header), "file string, record string")
    over = placed.where(earlier | later).withColumn("__number", F.col("__before") + F.when(earlier, 0).otherwise(F.col("__records")))
    if header:
        over = over.where(F.col("__number") != 1)  # the file's first record
    key = F.when(earlier, F.col("__owner")).otherwise(F.col("__piece"))
    parts = over.groupBy("__file", key.alias("__key")).agg(F.sort_array(F.collect_list(F.struct("__piece", "__at", "__line"))).alias("__lines"))
    return whole.unionAll(parts.select(F.col("__file").alias("file"), F.array_join(F.col("__lines.__line"), "\n").alias("record")))


def parse_records(records: DataFrame, schema: T.StructType, sep: str = ";", quote: str = '"', escape: str = "\\",
                  empty_as_null: bool = True, malformed_col: str | None = None) -> DataFrame:
    """The columns of ``schema`` (and ``malformed_col``) of records from :func:`read_records`."""
    options = {"sep": sep, "quote": quote, "escape": escape, "mode": "PERMISSIVE"}
    if not empty_as_null:
        options |= {"emptyValue": "", "nullValue": "\u0000"}
    if malformed_col:
        schema = T.StructType([*schema.fields, T.StructField(malformed_col, T.StringType())])
        options["columnNameOfCorruptRecord"] = malformed_col
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return records.select(F.inline(F.array(F.from_csv("record", ddl, options))))  # a generator: conditions on the columns don't parse the record again
