"""Helpers shared by the operators: the shared work folder and written intermediate tables."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship_package  # noqa: F401  used by the operators

_OWN: dict[str, str] = {}


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is absent (local tests) a temporary folder is made.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not base:
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="spark-work-")
        base = _OWN[app]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str, partition_by: str | None = None, **options) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    The files outlive lost executors, and later steps never recompute what led to them.
    Spark drops the shuffle files of the write as soon as it is done.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path, partitionBy=partition_by)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._work_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made and that nothing reads any more."""
    for t in tables:
        store, folder = fs.FileSystem.from_uri(t._work_path)
        store.delete_dir(folder)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` as a function for ``mapInArrow`` that gives freed memory back to the system when a task ends.

    Python workers live on between tasks, and what their allocators keep counts against
    the executor while other stages run.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
            if trim is not None:
                trim(0)

    return task


HEAVY_SHARE = 1000


def join_heavy(rows: DataFrame, lookup: DataFrame, key: str | list[str], count: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``lookup`` (one row per ``key``, ``count`` of its rows) when a key may hold very many rows.

    At most ``HEAVY_SHARE`` keys hold over a thousandth of the rows, so their part of the
    lookup is bounded and broadcast; the rows of all other keys meet theirs in a shuffle.
    """
    heavy = F.col(count) * HEAVY_SHARE > total
    hot, cold = lookup.where(heavy).drop(count), lookup.where(~heavy).drop(count)
    met = rows.join(F.broadcast(hot), key)
    names = [key] if isinstance(key, str) else key
    rest = rows.join(F.broadcast(hot.select(*names)), key, "left_anti").join(cold, key)
    return met.unionByName(rest)
