"""Session helpers.

The library never assumes a local machine: intermediate tables that must survive
executor loss are written under ``spark.checkpoint.dir`` (a shared folder the
cluster names).  Only when that setting is absent *and* Spark runs in local
mode (tests, laptops) do we create a private folder for it.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


#: Shuffle partitions of a local session.
LOCAL_PARTITIONS = 8


def build_session(master: str | None = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "landlens", extra: dict | None = None) -> SparkSession:
    """Session with the settings the operators are designed for.

    The number of shuffle partitions is ``shuffle_partitions`` if given, 8 for a
    local master, and else the cluster's (``spark-defaults``, ``--conf`` or Spark's
    200, which AQE coalesces); ``extra`` from :func:`scale_conf` sizes it to the input.

    AQE on (coalesces small shuffles, splits skewed join partitions), UTC,
    ANSI on (Spark 4 default; operators use ``try_*`` forms where the
    reference tolerated bad values), no web UI.  ``master=None`` leaves the
    master to the environment (``spark-submit``).
    """
    b = SparkSession.builder if master is None else SparkSession.builder.master(master)
    if shuffle_partitions is None and (master or os.environ.get("MASTER", "")).startswith("local"):
        shuffle_partitions = LOCAL_PARTITIONS
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = (b.appName(app_name)
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.ansi.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised intermediates.

    Reads ``spark.checkpoint.dir`` from the session.  If it is unset, a folder
    is created only in local mode; on a cluster the caller must configure it.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder "
                           "(e.g. on the cluster file system) for this session")
    d = tempfile.mkdtemp(prefix="landlens-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    _SCRATCH.append(f"{base}/{name}-{uuid.uuid4().hex}")
    return _SCRATCH[-1]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives the session's Python workers this package (once a session), wherever the driver found it.

    The driver may know the package by its own ``sys.path`` only.  Spark's file
    server hands the archive out; a package that itself came as an archive is
    left to whoever shipped it.
    """
    sc = spark.sparkContext
    root = os.path.dirname(os.path.abspath(__file__))
    if sc.applicationId in _SHIPPED or not os.path.isdir(root):
        return
    folder = tempfile.mkdtemp(prefix="landlens-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "landlens_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for where, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(where, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def default_parallelism(spark: SparkSession) -> int:
    """Partition count used for operator-chosen repartitions."""
    try:
        return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    except Exception:  # pragma: no cover - conf always has a default
        return os.cpu_count() or 8


def discard(spark: SparkSession, *paths: str) -> int:
    """Removes scratch tables that nothing reads any more, through Spark's file system; returns how many there were."""
    jvm, conf, n = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def scratch_mark() -> int:
    """How many scratch paths were handed out; ``clear_scratch`` removes those after a mark."""
    return len(_SCRATCH)


def clear_scratch(spark: SparkSession, since: int = 0) -> int:
    """Removes what was written under scratch paths handed out after ``since``, through Spark's file system; returns the number of folders.

    For batch runs, after their last result is written; frames that still read
    scratch tables cannot be used afterwards.
    """
    paths = _SCRATCH[since:]
    del _SCRATCH[since:]
    return discard(spark, *paths)


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> list[str]:
    """Sets what of ``conf`` a running session can still change; returns the keys that it can't."""
    fixed = [k for k in conf if not spark.conf.isModifiable(k)]
    for k, v in conf.items():
        if k not in fixed:
            spark.conf.set(k, v)
    return fixed


@contextmanager
def conf_for(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The session with ``conf`` while the block runs; what was set before is set again."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def too_few_partitions(spark: SparkSession, input_bytes: int, partition_bytes: int = 4 << 30) -> str | None:
    """Why a job over ``input_bytes`` should not start with the session's settings, if it should not: more than
    ``partition_bytes`` a shuffle partition on a cluster."""
    n = default_parallelism(spark)
    conf = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    n = int(conf) if conf and spark.conf.get("spark.sql.adaptive.enabled") == "true" else n
    if spark.sparkContext.master.startswith("local") or input_bytes <= n * partition_bytes:
        return None
    return (f"{n} shuffle partitions for {input_bytes >> 30} GiB of input; set spark.sql.shuffle.partitions "
            "or give the input size and the number of cores")


def input_size(spark: SparkSession, *paths: str) -> int:
    """Bytes below the paths, from the file system's listing."""
    jvm, conf, total = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        total += sum(fs.getContentSummary(found.getPath()).getLength() for found in fs.globStatus(path) or [])
    return total


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 512 << 20,
               max_partitions: int | None = None) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of input.

    AQE starts from enough shuffle partitions that none exceeds
    ``target_partition_bytes`` even if a stage shuffles the whole input (at
    least 3 waves of the cluster's cores), then coalesces small ones down to the
    advisory size; skewed join partitions (5x the median and above the target
    size) are split.  File splits are capped at 256 MiB so a scan task's batch
    fits in executor memory.  The broadcast threshold stays at Spark's default.
    ``max_partitions`` limits the shuffle partitions where the map x reduce block
    count must stay small; reducers are then larger than the target and spill.
    """
    initial = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    if max_partitions is not None:
        initial = min(initial, max_partitions)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
