"""Intermediate tables written to the shared folder, and size-checked collection."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from classmap.functions.names import col

T = TypeVar("T")
# Bytes of class-side data one broadcast may hold; larger sides are cut into blocks.
BROADCAST_BYTES = 128 << 20


# Folders of local sessions without a setting.
_local: list[tempfile.TemporaryDirectory] = []
# Folders written inside the innermost scratch of a thread, to be dropped at its end.
_scope: ContextVar[set[str] | None] = ContextVar("scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. A local session without one, whose tasks all share
    this machine, gets a folder that is removed when the process ends."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        _local.append(tempfile.TemporaryDirectory(prefix="classmap-", ignore_cleanup_errors=True))
        folder = _local[-1].name
        sc.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    path, scope = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", _scope.get()
    if scope is not None:
        scope.add(path)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Drop at the end what was written inside, by this plan alone; its result must be
    written out or collected before that."""
    written: set[str] = set()
    token = _scope.set(written)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in written:
            drop_folder(spark, path)


@contextmanager
def lasting() -> Iterator[None]:
    """Tables written inside outlive the ``scratch`` around them."""
    token = _scope.set(None)
    try:
        yield
    finally:
        _scope.reset(token)


def settle(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table once and read it back: cut lineage that survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._settled_at = path
    return stored


def release(*tables: DataFrame) -> None:
    """Drop settled tables that nothing reads any more."""
    for table in tables:
        drop_folder(table.sparkSession, table._settled_at)


def together(*jobs: Callable[[], T]) -> list[T]:
    """Run independent Spark jobs at the same time; the first failure is raised."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(copy_context().run, job) for job in jobs]]


def task_count(spark: SparkSession, work: int, smallest: int, largest: int) -> int:
    """Tasks for a Python stage whose cost is not its bytes: each gets from ``smallest``
    to ``largest`` units of work, and all cores are used where there is enough."""
    cores = spark.sparkContext.defaultParallelism
    return max(1, -(-work // largest), min(4 * cores, -(-work // smallest)))


def row_blocks(
    df: DataFrame, position: str, *, vectors: tuple[str, ...] = (), texts: tuple[str, ...] = (),
    max_bytes: int | None = None,
) -> list[tuple[int, int]]:
    """Ranges of a dense 0-based position, each holding at most ``max_bytes``.

    The bound is proven from the largest row, so no range can exceed it.
    """
    widest = [F.coalesce(F.max(F.size(c)), F.lit(0)) * 8 for c in vectors]
    widest += [F.coalesce(F.max(F.octet_length(c)), F.lit(0)) for c in texts]
    total = widest[0]
    for w in widest[1:]:
        total = total + w
    rows, width = df.agg(F.coalesce(F.max(position) + 1, F.lit(0)), total + 64).first()
    step = max(1, (max_bytes or BROADCAST_BYTES) // int(width))
    return [(a, min(a + step, rows)) for a in range(0, rows, step)]


def fetch_block(df: DataFrame, position: str, block: tuple[int, int]) -> pa.Table:
    """One range of a size-checked table, in position order."""
    part = df.where((col(position) >= block[0]) & (col(position) < block[1]))
    return part.toArrow().sort_by(position)
