"""Session helpers: settings, the shared working folder, durable cuts of lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job here is written for.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the step after it then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Partitions for a shuffle of this size. Adaptive execution merges small partitions but never adds
    any, so the start value has to fit the largest shuffle: 100 TB needs about 400,000."""
    return max(cores, -(-shuffled_bytes // SHUFFLE_PARTITION_BYTES))


def get_session(app: str = "pipekit", master: str | None = None, shuffled_bytes: int | None = None,
                **conf: str) -> SparkSession:
    """A session with :data:`SETTINGS`; keyword names use ``__`` for dots.

    ``shuffled_bytes`` is the size of the largest shuffle to expect.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    if shuffled_bytes:
        count = shuffle_partitions(shuffled_bytes, spark.sparkContext.defaultParallelism)
        spark.conf.set("spark.sql.shuffle.partitions", str(count))
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A machine-local folder is used only by a ``local`` session that names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="pipekit-")
    spark.sparkContext.setCheckpointDir(f"{root}/checkpoints")
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for files of one run, below :func:`shared_root`."""
    return f"{shared_root(spark)}/pipekit-work/{name}-{uuid.uuid4().hex[:12]}"


_MADE: list[str] = []
# Tables of the block that is running here; a thread has its own, so no job deletes another one's tables.
_SCOPE: ContextVar[list[str] | None] = ContextVar("pipekit_scope", default=None)


@contextmanager
def working_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the :func:`durable` tables made inside the block; for jobs that save their result.

    Only tables of this thread's block count, and those of worker threads that run in a copy of its context.
    """
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        _drop(spark, made)


@contextmanager
def held_tables() -> Iterator[list[str]]:
    """Collect the :func:`durable` tables made inside the block without deleting them, for :func:`drop_tables` once
    what is built on them has been saved."""
    made: list[str] = []
    token = _SCOPE.set(made)
    try:
        yield made
    finally:
        _SCOPE.reset(token)


def drop_tables(spark: SparkSession, tables: list[str]) -> None:
    """Delete tables of :func:`held_tables` and empty the list."""
    _drop(spark, tables)
    tables.clear()


def clear_working_tables(spark: SparkSession) -> None:
    """Delete all :func:`durable` tables of this driver made outside a block. DataFrames built on them stop working."""
    _drop(spark, _MADE)
    _MADE.clear()


def _drop(spark: SparkSession, paths: list[str]) -> None:
    from pipekit.sinks.files import delete_path
    for path in paths:
        delete_path(spark, path)


def durable(df: DataFrame, name: str = "durable") -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so later uses see the very same rows and do
    not depend on executors that may be lost. Columns that a later step does not need are not read."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    scope = _SCOPE.get()
    (_MADE if scope is None else scope).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
