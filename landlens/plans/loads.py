"""Loads: one pass from a raw table to its clean rows, its rejected rows, the counts of both and the contract audit.

The raw table is scanned once.  Every row gets the reason why it is rejected, or none;
copies become one row with their number (for the tables that are de-duplicated: C5 before
the casts, C6); kept rows hold the typed columns, rejected ones the raw row; one write
puts them into ``outcome=kept`` and ``outcome=rejected``.  What is counted is observed by
that write: rows read by outcome, rows written (A8), nulls in required columns, values
that their type refused, texts longer than declared.  All is observed behind the last
shuffle, in the writing stage, whose tasks count once however often they are tried.

Declared keys need a comparison of rows.  :func:`audit_keys` marks in a first pass which
rows can share a key at all: a sketch of 63-bit words in which each key's hash sets a bit; a
word with more rows than bits has seen a bit twice.  Only rows of such words are compared
by key.  Spark filters the rest before the shuffle (broadcast or Bloom filter by size).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landlens.contracts import (
    BUILDING_PERMITS, BUILDING_PERMITS_COLUMNAR, BUSINESS_LICENSES, PERMIT_LENGTHS, POSTAL_CODE_PATTERN, PROPERTY_TAX, TableContract,
)
from landlens.functions.text import extract_pattern
from landlens.operators import boundaries, clean
from landlens.session import conf_for

MALFORMED = "__malformed"
#: Rows for each 63-bit word of the key sketch: the fewer, the fewer rows are compared and the more words are shuffled.
ROWS_A_WORD = 4
_BITS = 63
#: Both outcomes are written side by side; without this Spark sorts all rows by outcome (and spills them) for one file at a time.
WRITE_CONF = {"spark.sql.maxConcurrentOutputFileWriters": "2"}
_COPIES, _REASON, _RAW, OUTCOME = "__copies", "__reason", "__raw", "outcome"


@dataclass(frozen=True)
class Load:
    """How a raw table becomes a clean one.

    ``reasons`` are all that ``reason`` can give; ``typed`` are the clean columns,
    ``refused`` the casts that can fail: clean column -> raw column.
    """

    name: str
    contract: TableContract
    reasons: tuple[str, ...]
    reason: Callable[[DataFrame], Column]
    typed: Callable[[DataFrame], list[Column]]
    dedupe: bool = True
    lengths: tuple[tuple[str, int], ...] = ()

    @property
    def refused(self) -> dict[str, str]:
        return {c: f.src for f, c in zip(self.contract.fields, self.targets) if not isinstance(f.dtype, T.StringType)}

    @property
    def targets(self) -> list[str]:
        """Names of the contract's fields in the clean table."""
        return [f.target.upper() if self.contract in (BUILDING_PERMITS, BUILDING_PERMITS_COLUMNAR) else f.target for f in self.contract.fields]


def _missing(columns: Sequence[str]) -> Column:
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in columns], F.lit(None).cast("string"))


def _permit_reason(df: DataFrame, contract: TableContract) -> Column:
    bad = F.when(F.col(MALFORMED).isNotNull(), F.lit("malformed")) if MALFORMED in df.columns else F.lit(None).cast("string")
    return F.coalesce(bad, _missing(contract.source_columns))


def _permit_columns(df: DataFrame, contract: TableContract, address: str) -> list[Column]:
    typed = clean.conform_columns(df, contract, truncate_strings=False)
    code = extract_pattern(F.col(address), POSTAL_CODE_PATTERN, 0)
    return [c.alias(f.target.upper()) for c, f in zip(typed, contract.fields)] + [code.alias("POSTAL_CODE")]


def _missing_names(contract: TableContract) -> tuple[str, ...]:
    return tuple(f"missing:{c}" for c in contract.source_columns)


LOADS = {
    "property_tax": Load("property_tax", PROPERTY_TAX, _missing_names(PROPERTY_TAX), lambda df: _missing(PROPERTY_TAX.source_columns),
                         lambda df: clean.conform_columns(df, PROPERTY_TAX)),
    "building_permits": Load("building_permits", BUILDING_PERMITS, ("malformed", *_missing_names(BUILDING_PERMITS)), lambda df: _permit_reason(df, BUILDING_PERMITS),
                             lambda df: _permit_columns(df, BUILDING_PERMITS, "Address"), lengths=tuple(PERMIT_LENGTHS.items())),
    "building_permits_columnar": Load("building_permits", BUILDING_PERMITS_COLUMNAR, _missing_names(BUILDING_PERMITS_COLUMNAR),
                                      lambda df: _permit_reason(df, BUILDING_PERMITS_COLUMNAR), lambda df: _permit_columns(df, BUILDING_PERMITS_COLUMNAR, "address"),
                                      lengths=tuple(PERMIT_LENGTHS.items())),
    "business_licenses": Load("business_licenses", BUSINESS_LICENSES, tuple(f"{k}:{c}" for k in ("missing", "unparsable") for c in BUSINESS_LICENSES.required),
                              lambda df: clean.reject_reason(df, BUSINESS_LICENSES), lambda df: clean.conform_columns(df, BUSINESS_LICENSES), dedupe=False),
}


def staged(raw: DataFrame, load: Load) -> DataFrame:
    """The rows to be written: typed columns, __raw (of rejected rows), __reason, __copies, outcome; a lazy plan with one scan."""
    names = [*load.contract.source_columns, *([MALFORMED] if MALFORMED in raw.columns else [])]
    rows = raw.select(*names)
    if load.dedupe:
        rows = rows.groupBy(*names).agg(F.count(F.lit(1)).alias(_COPIES))
    else:
        rows = rows.withColumn(_COPIES, F.lit(1).cast("bigint"))
    rows = rows.withColumn(_REASON, load.reason(rows))
    kept = F.col(_REASON).isNull()
    typed = load.typed(rows)
    # a kept row needs no raw values but for the casts that are audited
    failed = [f"cast_failed:{c}" for c in load.refused]
    raw_row = F.when(~kept, F.struct(*names)).alias(_RAW)
    return rows.select(*typed, raw_row, _REASON, _COPIES, F.when(kept, "kept").otherwise("rejected").alias(OUTCOME),
                      F.struct(*[F.col(src).isNotNull().alias(n) for n, src in zip(failed, load.refused.values())] or [F.lit(None).alias("none")]).alias("__had"))


def _metrics(load: Load) -> dict[str, Column]:
    kept, copies = F.col(_REASON).isNull(), F.col(_COPIES)
    out = {"kept": F.sum(F.when(kept, copies)), **{r: F.sum(F.when(F.col(_REASON) == r, copies)) for r in load.reasons}, "row_count": F.count_if(kept)}
    named = {f.target: c for f, c in zip(load.contract.fields, load.targets)}
    out |= {f"not_null:{named[c]}": F.count_if(kept & F.col(named[c]).isNull()) for c in load.contract.required}
    out |= {f"cast_failed:{c}": F.count_if(kept & F.col(c).isNull() & F.col("__had").getField(f"cast_failed:{c}")) for c in load.refused}
    out |= {f"too_long:{c}": F.count_if(kept & (F.length(c) > n)) for c, n in load.lengths if c in [*load.targets, "POSTAL_CODE"]}
    return out


@dataclass(frozen=True)
class Loaded:
    """What a load wrote: clean rows, rejected raw rows, (outcome, n_rows), and (check, subject, violations)."""

    clean: DataFrame
    rejected: DataFrame
    outcomes: DataFrame
    audit: DataFrame


def _observed_write(rows: DataFrame, name: str, metrics: dict[str, Column], path: str, mode: str, without: Sequence[str] = ()) -> tuple[dict[str, int], T.StructType]:
    """Writes ``rows`` by outcome; what the write counted, and the schema of what was written."""
    observation = Observation(f"load {name}")
    seen = rows.observe(observation, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(f"m{i}") for i, c in enumerate(metrics.values())]).drop(*without)
    with conf_for(rows.sparkSession, WRITE_CONF):
        seen.write.mode(mode).option("compression", "zstd").partitionBy(OUTCOME).parquet(path)
    counted = observation.get
    return {m: counted[f"m{i}"] for i, m in enumerate(metrics)}, seen.schema


def _counts(spark: SparkSession, counted: dict[str, int], reasons: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(k, counted[k]) for k in ("kept", *reasons) if counted[k]], "outcome string, n_rows bigint")


def run_load(raw: DataFrame, load: Load, path: str, mode: str = "overwrite") -> Loaded:
    """Writes the load below ``path`` in one pass and returns its parts, read from there and from what the write observed."""
    spark = raw.sparkSession
    counted, schema = _observed_write(staged(raw, load), load.name, _metrics(load), path, mode, ["__had"])
    kept = spark.read.schema(schema).parquet(path).where(F.col(OUTCOME) == "kept").drop(_RAW, _REASON, _COPIES, OUTCOME)
    checks = [("row_count", "*", counted["row_count"])] + [(*k.split(":", 1), n) for k, n in counted.items() if k.split(":")[0] in ("not_null", "cast_failed", "too_long")]
    audit = spark.createDataFrame(checks, "check string, subject string, violations bigint")
    if load.contract.key:
        audit = audit.unionByName(audit_keys(kept, load.contract.key, counted["row_count"]))
    return Loaded(kept, rejected_rows(spark, path, schema), _counts(spark, counted, load.reasons), audit)


def run_boundaries(raw: DataFrame, path: str, mode: str = "overwrite") -> Loaded:
    """Writes (name, polygons) of usable boundaries of (name, geojson), and the others with their reason, in one pass."""
    spark, reason = raw.sparkSession, F.col(_REASON)
    rows = boundaries.check_boundaries(raw).withColumnRenamed("reason", _REASON)
    rows = rows.withColumn(OUTCOME, F.when(reason.isNull(), "kept").otherwise("rejected"))
    metrics = {"kept": F.count_if(reason.isNull()), **{r: F.count_if(reason == r) for r in boundaries.REASONS},
               "row_count": F.count_if(reason.isNull()), "reversed_rings": F.sum(F.when(reason.isNull(), F.col("reversed_rings")))}
    counted, schema = _observed_write(rows, "boundaries", metrics, path, mode)
    written = spark.read.schema(schema).parquet(path)
    kept = written.where(F.col(OUTCOME) == "kept").select("name", "polygons")
    gone = written.where(F.col(OUTCOME) == "rejected").select("name", "polygons", reason.alias("reason"))
    checks = [("row_count", "*", counted["row_count"]), ("reversed_rings", "polygons", counted["reversed_rings"])]
    audit = spark.createDataFrame(checks, "check string, subject string, violations bigint").unionByName(audit_keys(kept, ["name"], counted["row_count"]))
    return Loaded(kept, gone, _counts(spark, counted, boundaries.REASONS), audit)


def rejected_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rejected raw rows below ``path``, as often as they were read, with their reason."""
    gone = spark.read.schema(schema).parquet(path).where(F.col(OUTCOME) == "rejected")
    return gone.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(_COPIES)))).select(f"{_RAW}.*", F.col(_REASON).alias("reason"))


def key_suspects(df: DataFrame, key: Sequence[str], n_rows: int) -> DataFrame:
    """The key columns of all rows whose key can occur more than once: those in words of the sketch that saw a bit twice."""
    words = max(1, n_rows // ROWS_A_WORD)
    at = F.pmod(F.xxhash64(*key), F.lit(words * _BITS))
    keys = df.select(*key, at.alias("__at")).select(*key, F.expr(f"__at div {_BITS}").alias("__word"), F.expr(f"shiftleft(1L, CAST(__at % {_BITS} AS INT))").alias("__bit"))
    sketch = keys.groupBy("__word").agg(F.count(F.lit(1)).alias("__n"), F.bit_or("__bit").alias("__seen")).where(F.col("__n") > F.bit_count("__seen"))
    return keys.drop("__bit").join(sketch.select("__word"), "__word", "left_semi").drop("__word")


def audit_keys(df: DataFrame, key: Sequence[str], n_rows: int) -> DataFrame:
    """(check, subject, violations): key values that occur more than once, and the rows they cover; exact."""
    many = key_suspects(df, key, n_rows).groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    total = many.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"))
    subject = F.lit(",".join(key))
    return total.select(F.inline(F.array(*[F.struct(F.lit(check).alias("check"), subject.alias("subject"), F.col(c).cast("bigint").alias("violations"))
                                           for check, c in (("duplicate_key_groups", "groups"), ("duplicate_key_rows", "rows"))])))
