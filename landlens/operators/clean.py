"""Cleaning operators.

All of them are narrow transformations except ``dedupe`` (one hash aggregate
on all columns, partially aggregated before its shuffle, so exact copies of a
hot row collapse map-side), ``audit`` (one aggregate on the key and a global one
over it) and ``outcomes``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landlens.contracts import POSTAL_CODE_PATTERN, TableContract
from landlens.functions.casts import conform_column
from landlens.functions.text import extract_pattern, truncate


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep only ``columns`` (Catalyst prunes the file scan to them)."""
    return df.select(*[F.col(c) for c in columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; keys that are not columns are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column of ``subset`` (all columns by default)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Full-row (or ``subset``) de-duplication."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def conform(df: DataFrame, contract: TableContract, rename: bool = True,
            truncate_strings: bool = True) -> DataFrame:
    """C2 + C6 + C7 in one ``select``: cast every field to its contract type.

    Columns are looked up by their source name (or target name when the frame
    is already renamed); failed casts give null; strings with a ``max_length``
    are cut to it.  Output columns follow the contract order.
    """
    return df.select(*conform_columns(df, contract, rename, truncate_strings))


def conform_columns(df: DataFrame, contract: TableContract, rename: bool = True, truncate_strings: bool = True) -> list[Column]:
    """The columns of :func:`conform`."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in contract.fields:
        name = f.src if f.src in schema else f.target
        c = conform_column(F.col(name), f.dtype, schema.get(name))
        if truncate_strings and f.max_length and isinstance(f.dtype, T.StringType):
            c = truncate(c, f.max_length)
        cols.append(c.alias(f.target if rename else name))
    return cols


def truncate_columns(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """Cut the listed string columns to ``n`` characters."""
    return df.withColumns({c: truncate(F.col(c), n) for c in columns})


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows whose required columns are all non-null."""
    if not columns:
        return df
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.where(cond)


def enforce_contract(df: DataFrame, contract: TableContract) -> DataFrame:
    """Cast + rename to the contract, then drop rows violating NOT NULL.

    The source job re-applied the schema through a Python round trip and
    failed on a null in a required column; here the rows are filtered after
    the cast (so a year that fails to parse is rejected too); :func:`reject_reason`
    and :func:`outcomes` name and count what goes.
    """
    return require(conform(df, contract), contract.required)


def reject_reason(df: DataFrame, contract: TableContract) -> Column:
    """Why a raw row (source or target names) breaks the contract's required columns, null if it does not.

    ``missing:COLUMN`` before ``unparsable:COLUMN`` (a text that its type refuses), columns in contract order.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    fields = [(f, f.src if f.src in kinds else f.target) for f in contract.fields if f.required]
    missing = [F.when(F.col(name).isNull(), F.lit(f"missing:{f.target}")) for f, name in fields]
    bad = [F.when(conform_column(F.col(name), f.dtype, kinds[name]).isNull(), F.lit(f"unparsable:{f.target}")) for f, name in fields]
    return F.coalesce(*missing, *bad, F.lit(None).cast("string"))


def outcomes(df: DataFrame, reason: Column) -> DataFrame:
    """``(outcome, n_rows)``: rows kept and rows rejected by reason; sums up to the rows read."""
    return df.groupBy(F.coalesce(reason, F.lit("kept")).alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows"))


def audit(df: DataFrame, required: Sequence[str] = (), key: Sequence[str] = ()) -> DataFrame:
    """Contract audit as a DataFrame ``(check, subject, violations)``, from one scan.

    Rows and nulls are counted for each key value (without a key: once), then
    summed up beside the key values that occur more than once and the rows they
    cover.  Both steps aggregate partially, so a hot key is combined map-side.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"__null_{i}") for i, c in enumerate(required)]
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), *nulls)
    many = F.col("__n") > 1
    total = per_key.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("__rows"),
        *[F.coalesce(F.sum(f"__null_{i}"), F.lit(0)).alias(f"__null_{i}") for i in range(len(required))],
        F.count_if(many).alias("__groups"), F.coalesce(F.sum(F.when(many, F.col("__n"))), F.lit(0)).alias("__dup"))
    checks = [("row_count", "*", "__rows"), *[("not_null", c, f"__null_{i}") for i, c in enumerate(required)]]
    if key:
        checks += [("duplicate_key_groups", ",".join(key), "__groups"), ("duplicate_key_rows", ",".join(key), "__dup")]
    rows = F.array(*[F.struct(F.lit(a).alias("check"), F.lit(b).alias("subject"), F.col(c).cast("bigint").alias("violations"))
                     for a, b, c in checks])
    return total.select(F.inline(rows))


def with_postal_code(df: DataFrame, source: str = "address", target: str = "postal_code",
                     pattern: str = POSTAL_CODE_PATTERN) -> DataFrame:
    """First postal-code match in a free-text column (``''`` if none)."""
    return df.withColumn(target, extract_pattern(F.col(source), pattern, 0))


def where_equal(df: DataFrame, **conditions) -> DataFrame:
    """Equality filter on one or more columns (pushed to the scan)."""
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in conditions.items()])
    return df.where(cond)


def segment_filter(df: DataFrame, segment: str, column: str = "property_use",
                   value: str = "residential") -> DataFrame:
    """``'residential'`` keeps ``value``; ``'non-residential'`` keeps everything
    else *including nulls* (as the pandas ``!=`` did); ``'both'`` keeps all rows."""
    c = F.col(column)
    if segment == "both":
        return df
    if segment == value:
        return df.where(c == F.lit(value))
    return df.where(~c.eqNullSafe(F.lit(value)))


def segment_tag(column: str = "property_use", value: str = "residential",
                other: str = "non-residential") -> Column:
    """Array of the segments a row belongs to: ``['both', value|other]``.

    Exploding it evaluates all three segment filters in one pass.
    """
    c = F.col(column)
    return F.array(F.lit("both"), F.when(c.eqNullSafe(F.lit(value)), F.lit(value))
                   .otherwise(F.lit(other)))


def preview(df: DataFrame, n: int = 10, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """The first ``n`` rows; ordered when ``order_by`` is given
    (Spark plans TakeOrderedAndProject: a per-partition top-n, no full sort)."""
    if order_by:
        return df.orderBy(*order_by).limit(n)
    return df.limit(n)
