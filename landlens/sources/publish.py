"""S5, repeatable loads: write, audit, publish.

A table is a folder.  Each load has a run id and writes its rows to a folder of its own
(``run_id=.../attempt=...``), which nobody reads yet.  The written rows are audited.  Only then a
new version of the list of runs is written (``_published/version=...``), in which the run
points to this attempt; readers take the newest complete version.  So

* the same run loaded twice is one run of the table, not two;
* a load that fails, or whose audit fails, changes nothing that a reader sees;
* a reader that began before a switch keeps reading the files of its version, also
  while the run is loaded again or the whole table is replaced.

Files that no recent version lists are removed by :func:`vacuum`.  The list has a row a
run.  Loads of one table are to be made one after the other.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landlens.session import discard

RUN = "run_id"
_LIST, _SCHEMA = "_published", "run string, attempt string, ddl string"


class AuditFailed(ValueError):
    """The audit of a load found violations; the load was not published."""

    def __init__(self, run: str, found: list[tuple[str, str, int]]):
        super().__init__(f"run {run!r}: " + ", ".join(f"{check} {subject}: {n}" for check, subject, n in found))
        self.found = found


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, through Spark's file system; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def versions(spark: SparkSession, location: str) -> list[int]:
    """The complete versions of the list, oldest first."""
    found = [int(m[1]) for n in _children(spark, f"{location}/{_LIST}") if (m := re.fullmatch(r"version=(\d+)", n))]
    return sorted(v for v in found if "_SUCCESS" in _children(spark, f"{location}/{_LIST}/version={v}"))


def runs(spark: SparkSession, location: str, version: int | None = None) -> dict[str, tuple[str, str]]:
    """run -> (attempt, columns) of a version of the table (default: the newest; before the first load: none)."""
    known = versions(spark, location)
    if version is None and not known:
        return {}
    rows = spark.read.schema(_SCHEMA).json(f"{location}/{_LIST}/version={known[-1] if version is None else version}").collect()  # a row a run
    return {r.run: (r.attempt, r.ddl) for r in rows}


def _folder(location: str, run: str, attempt: str) -> str:
    return f"{location}/{RUN}={run}/attempt={attempt}"


def _checked(run: str) -> str:
    if not re.fullmatch(r"[\w.\-]+", run):
        raise ValueError(f"a run id is made of letters, digits, '_', '.' and '-', not {run!r}")
    return run


def publish(df: DataFrame, location: str, run: str, audit: Callable[[DataFrame], DataFrame] | None = None,
            tolerated: Collection[str] = ("row_count",), mode: str = "append") -> int:
    """Loads ``df`` as ``run`` of the table at ``location``; returns the new version.

    ``audit`` takes the written rows and gives (check, subject, violations); a
    violation of a check that is not ``tolerated`` raises ``AuditFailed``.
    ``append`` adds the run or replaces the run of that id; ``overwrite`` makes it the
    only run.
    """
    spark, location = df.sparkSession, location.rstrip("/")
    if mode not in ("append", "overwrite"):
        raise ValueError(f"no load mode {mode!r}")
    attempt = uuid.uuid4().hex
    path = _folder(location, _checked(run), attempt)
    df.write.parquet(path)
    if audit is not None:
        found = audit(spark.read.schema(df.schema).parquet(path)).where((F.col("violations") > 0) & ~F.col("check").isin(*tolerated)).collect()  # a row a check
        if found:
            raise AuditFailed(run, [(r.check, r.subject, r.violations) for r in found])
    known = versions(spark, location)
    listed = runs(spark, location) if mode == "append" else {}
    listed[run] = attempt, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    version = known[-1] + 1 if known else 1
    rows = spark.createDataFrame([(r, *a) for r, a in listed.items()], _SCHEMA)
    rows.coalesce(1).write.mode("overwrite").json(f"{location}/{_LIST}/version={version}")  # complete once its success mark is there
    return version


def published(spark: SparkSession, location: str, version: int | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The rows of a version of the table with their ``run_id``; columns that a run doesn't have are null.

    ``schema`` is needed for a table without a load.
    """
    location = location.rstrip("/")
    frames = None
    for run, (attempt, ddl) in runs(spark, location, version).items():
        rows = spark.read.schema(ddl).parquet(_folder(location, run, attempt)).withColumn(RUN, F.lit(run))
        frames = rows if frames is None else frames.unionByName(rows, allowMissingColumns=True)
    if frames is None:
        if schema is None:
            raise FileNotFoundError(f"nothing is published at {location}")
        frames = spark.createDataFrame([], schema).withColumn(RUN, F.lit(None).cast("string"))
    return frames


def publish_view(spark: SparkSession, name: str, location: str) -> None:
    """Points the temporary view ``name`` to the newest version; queries that run keep the one they began with."""
    published(spark, location).createOrReplaceTempView(name)


def vacuum(spark: SparkSession, location: str, keep: int = 2) -> int:
    """Removes the lists older than the ``keep`` newest and every attempt that none of those lists; returns how many folders went."""
    location = location.rstrip("/")
    known = versions(spark, location)
    used = {(run, attempt) for v in known[-keep:] for run, (attempt, _) in runs(spark, location, v).items()}
    old = [f"{location}/{_LIST}/version={v}" for v in known[:-keep]]
    for folder in _children(spark, location):
        if folder.startswith(f"{RUN}="):
            run = folder.split("=", 1)[1]
            old += [f"{location}/{folder}/{a}" for a in _children(spark, f"{location}/{folder}") if a.startswith("attempt=") and (run, a.split("=", 1)[1]) not in used]
    return discard(spark, *old)
