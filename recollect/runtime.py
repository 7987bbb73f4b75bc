"""Session helpers shared by operators: shared folders, staged tables, batch bounds and size-checked broadcasts."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FALLBACK: dict[str, str] = {}
_STAGED: list[tuple[weakref.ref, str]] = []


def session(app: str = "recollect", cpus: str = "8") -> SparkSession:
    """Local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.unionOutputPartitioning", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def plain_unions(spark: SparkSession) -> None:
    """Children of a union are read with partitions of their own.

    Taken as partitioned alike, as is the default, adaptive execution may give them different numbers of partitions, and the plan fails.
    """
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can read: ``spark.checkpoint.dir``, or else the warehouse; a temporary folder only where driver and executors are one process."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] != "local":
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_recollect"
    key = spark.sparkContext.applicationId
    if key not in _FALLBACK:
        _FALLBACK[key] = "file://" + tempfile.mkdtemp(prefix="recollect-")
    return _FALLBACK[key]


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder of its own in the shared one, deleted when the interpreter ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _STAGED.append((weakref.ref(spark), path))
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage and pins rows that are read more than once, so a lost executor never changes
    a value that two branches of a plan must agree on. Files go when the interpreter ends.
    """
    spark = df.sparkSession
    plain_unions(spark)
    path = scratch(spark, f"staged/{label}")
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete staged tables that nothing will read any more."""
    for df in frames:
        path = getattr(df, "_staged_at", None)
        if path:
            target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
            _STAGED[:] = [x for x in _STAGED if x[1] != path]


@atexit.register
def drop_staged() -> None:
    """Delete what ``stage`` wrote, as far as the session still lives."""
    while _STAGED:
        ref, path = _STAGED.pop()
        spark = ref()
        try:
            if spark is not None and spark.sparkContext._jsc is not None:
                target = spark._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the JVM may be gone already
            return


#: Bytes of an Arrow batch on its way to Python at most (a single larger row is a batch of its own).
BATCH_BYTES = 16 << 20


def bound_batches(spark: SparkSession, rows: int = 512) -> None:
    """Keep an Arrow batch of long texts small, in rows and in bytes; only ever lowers the settings."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    with contextlib.suppress(Exception):  # a setting of newer versions
        held = spark.conf.get(key).rstrip("b")
        if not held.isdigit() or not 0 < int(held) <= BATCH_BYTES:
            spark.conf.set(key, str(BATCH_BYTES))


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, after which the worker, which lives on for other tasks, gives free memory back to the system."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


@contextlib.contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so few rows for the plans that are run inside, for rows that are large themselves."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint for a staged table of fixed-width rows, given only if its counted size is within the bound.

    Beyond ``max_rows`` the frame comes back without a hint and the join shuffles.
    """
    return F.broadcast(df) if df.count() <= max_rows else df
